import hashlib
import time

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from tallystar.llm import bpe, queries, toxicity
from tallystar.llm import decontaminate as dec
from tallystar.llm.common import in_batches
from edge import plain
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, written and read again as the driver does."""
    from tallystar.llm.common import table, written
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), name)
    return out


def test_registered():
    names = registered.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "byte_bpe"]


def test_each_stage_on_what_it_gets(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in stages.items()}
    for name in ("toxicity", "near_duplicates", "decontamination"):
        assert stages[name].columns == docs.columns
        assert stages[name].count() == len(ids[name])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(clean - ids["toxicity"]) <= 0.02 * len(clean)
    model = toxicity.learn(docs, labels)
    assert ids["toxicity"] == {i for i, t in text.items() if model.score(t) < corpus_pipeline.TOXIC_FROM}
    low = brute({i: text[i] for i in ids["toxicity"]})
    assert ids["near_duplicates"] == {i for i, (_, least) in low.items() if i == least}
    items = ["".join(map(chr, dec.normalised(r.text)[0]))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i in ids["near_duplicates"] if any(
        item in "".join(map(chr, dec.normalised(text[i])[0])) for item in items)}
    assert not leaked & ids["decontamination"]
    assert ids["near_duplicates"] - ids["decontamination"] == leaked or len(
        ids["near_duplicates"] - ids["decontamination"] - leaked) <= 1
    ranks = bpe.Vocabulary.load(queries.RANKS).ranks
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    for r in stages["byte_bpe"].collect():
        want = encoding.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest()
        assert r.n_tokens == len(want) and r.ids == b"".join(i.to_bytes(4, "little") for i in want)
    assert ids["byte_bpe"] == ids["decontamination"]


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.exceptAll(stages["byte_bpe"]).count() == 0
    assert got.agg(F.count("*")).first()[0] == stages["byte_bpe"].count()


def test_toxicity_stage_drops_toxic_documents(spark, stages):
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    kept = {r.doc_id for r in stages["toxicity"].select("doc_id").collect()}
    assert len(toxic & kept) <= 0.2 * len(toxic)


def test_workers_keep_no_tables_of_words_for_other_stages(spark):
    """Python workers stay after a task: what one stage knew would lie beside the next one's."""
    docs = plain(spark, [f"idiot w{i} x{i * 7} zq{i}zq" for i in range(400)]).repartition(4)
    labels = docs.select("doc_id", F.lit(0).alias("quality"),
                         (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.ToxicityModel({" idiot ": 3.0})
    toxicity.learn(docs, labels)
    toxicity.without_toxic(docs, model, threshold=2.0).write.format("noop").mode("overwrite").save()
    toxicity.score(docs, model).write.format("noop").mode("overwrite").save()
    bpe.round_trip(docs, queries.RANKS).write.format("noop").mode("overwrite").save()
    ranks = queries.RANKS

    def held(batches):
        for _ in batches:
            pass
        time.sleep(0.5)                                # so that every worker takes a task
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(toxicity._folded) + len(bpe._encoder(ranks)._known)])], ["n"])

    sizes = in_batches(spark.range(0, 8, 1, 8), held, "n long").collect()
    assert len(sizes) == 8 and {r.n for r in sizes} == {0}
