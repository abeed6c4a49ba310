"""The registered queries of the package and, where SQL can express one, its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import (bpe, collocations, decontaminate, html_text, jaccard, licenses,
                           line_dedup, merkle, neighbours, sharding, token_files, toxicity, warc)
from tallystar.llm.common import table
from tallystar.sources.shared import fresh_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels = table(spark, sf_dir, "labels").where(~held_out)
    return toxicity.score(docs, toxicity.learn(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row and its text go through the shuffle; the digests are taken from its result."""
    rows = sharding.uniform_shards(table(spark, sf_dir, "documents"), 24)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return rows.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
                       "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per contaminated document: the items found in it, with the stretches of text."""
    found = decontaminate.occurrences(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").alias("start_char"),
                        F.col("end").alias("end_char"), "edits")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    files = token_files.write(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return token_files.read(files, folder).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.query(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_sharding": op3_sharding,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_licenses": op6_licenses,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_neighbours": op8_neighbours,
    "op9_main_text": op9_main_text,
    "op10_token_files": op10_token_files,
    "op11_collocations": op11_collocations,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op4_warc": warc.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
