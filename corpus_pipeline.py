"""The corpus pipeline: toxic documents go, near copies and leaked benchmark text go, ids stay.

Each stage takes (spark, docs, sf_dir), works on all rows it is given, and returns all rows it
keeps, with the columns of `documents`; the last returns the token ids of the rest.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import bpe, decontaminate, jaccard, toxicity
from tallystar.llm.common import table, written

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic, whether they are labelled or not.

    Null and empty texts are scored too and stay. No rows, no rows.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group linked by 80 % of the word shingles.

    Texts without words stay. Rows equal in id and text leave one row.
    """
    return jaccard.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a passage of the benchmark occurs.

    Null and empty texts stay, rows with a null id are judged by their text.
    """
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, packed as little-endian unsigned 32-bit integers, decoded again.

    ``decoded_sha256`` is that of the bytes that the ids give: the text's own, or that of no
    bytes for a null text. Rows with a null id stay, repeated rows give repeated rows.
    """
    back = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies),
          ("decontamination", drop_benchmark), ("byte_bpe", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL expresses the learned lexicon or the merges; the tests compare with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
