import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tallystar.functions import naming, probability, text
from tallystar.functions.registered import register_sql_functions

TEXTS = ["a\nb", "café", "Two  spaces ", "!?.", "", None, "tab\there", "A-b c9"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")


def test_clean_deletes_and_lowers(docs):
    got = [r.c for r in docs.orderBy("doc_id").select(text.clean("text").alias("c")).collect()]
    assert got == ["ab", "caf", "two  spaces ", "", "", None, "tabhere", "ab c9"]


def test_tokens_skip_empty_and_null(docs):
    got = rows(text.tokens(docs, keep=["doc_id"]))
    assert got == sorted([(0, "ab"), (1, "caf"), (2, "two"), (2, "spaces"), (6, "tabhere"),
                          (7, "ab"), (7, "c9")], key=repr)


def test_words_is_the_array_form(docs):
    got = {r.doc_id: r.w for r in docs.select("doc_id", text.words("text").alias("w")).collect()}
    assert got[2] == ["two", "spaces"] and got[3] == [] and got[5] is None


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=8))
def test_clean_agrees_with_plain_python(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r.w for r in df.orderBy("i").select(text.words("text").alias("w")).collect()]
    assert got == [re.sub(r"[^A-Za-z 0-9]", "", t).lower().split() for t in texts]


def test_calc_prop_and_its_floor(spark):
    df = spark.createDataFrame([(0, 14, 20), (1, 9, 20)], "n bigint, t bigint, v bigint")
    got = rows(df.select(probability.calc_prop(F.col("n"), F.col("t"), F.col("v"))))
    assert got == [(1 / 34,), (2 / 29,)]
    assert probability.PROBABILITY_FLOOR > 0


def test_rank_score_guard(spark):
    df = spark.createDataFrame([(0.5, 0.0, 0.0), (0.5, 0.1, -2.0)],
                               "p double, least double, logs double")
    low, normal = [r[0] for r in df.select(probability.rank_score(
        F.col("p"), F.col("least"), F.col("logs"))).collect()]
    assert low == float("-inf") and normal == pytest.approx(-2.693147, abs=1e-6)
    zero = df.select(probability.log_units(F.lit(3), F.lit(0.0)).alias("u")).first()
    assert zero.u is None


def test_sql_names(spark):
    register_sql_functions(spark)
    got = spark.sql("SELECT clean_string('It\\'s\nOK') AS c, clean_string(null) AS n, "
                    "calc_prop(0, 14, 20) AS p").first()
    assert (got.c, got.n, got.p) == ("itsok", None, 1 / 34)


def test_names(spark):
    df = spark.createDataFrame([("SSBQ1v1S100T1", "file:///d/orders_small.parquet", "orders-parquet-projection"),
                                ("SSBQ4v3S1T4", "/a.b/noext", "letters-csv")],
                               "b string, f string, n string")
    got = [tuple(r) for r in df.select(
        naming.query_name(F.col("b")), naming.file_stem(F.col("f")),
        naming.file_extension(F.col("f")), naming.has_projection(F.col("n"))).collect()]
    assert got == [("1.1", "orders_small", "parquet", True), ("4.3", "noext", "", False)]
    value = df.select(naming.log_normalised(F.lit(0.0)).alias("v")).first().v
    assert value == pytest.approx(-23.025850929940457)
