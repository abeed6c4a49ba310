import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallystar.functions.money import exact_sum, hundredths
from tallystar.functions.seconds import mean_seconds
from tallystar.operators.median import mean_and_median
from tallystar.operators.numbering import with_row_number
from tallystar.operators.salting import salted_join
from tallystar.sources import shared


def test_row_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"),
                                  F.concat(F.lit("t"), F.col("id") % 7).alias("t"))
    got = with_row_number(df.repartition(5), ["t", "k"], "n")
    expected = sorted((r.t, r.k) for r in df.collect())
    assert [(r.t, r.k) for r in got.orderBy("n").collect()] == expected
    assert rows(got.agg(F.min("n"), F.max("n"), F.countDistinct("n"))) == [(1, 1000, 1000)]
    assert got.columns == ["n", "k", "t"]


def test_row_numbers_by_a_key_write_the_key_only(spark, monkeypatch):
    from tallystar.operators import numbering
    written = []

    def seen(df, kept=numbering.checkpointed):
        written.append(df.columns)
        return kept(df)

    monkeypatch.setattr(numbering, "checkpointed", seen)
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"),
                                 F.concat(F.lit("t"), F.col("id") % 7).alias("t"))
    got = with_row_number(df.repartition(5), ["t", "k"], "n", key=["k"])
    assert written == [["k", "_at", "_range"]] and got.columns == ["n", "k", "t"]
    assert [(r.t, r.k) for r in got.orderBy("n").collect()] == sorted((r.t, r.k) for r in df.collect())
    keys = with_row_number(df.select("k"), ["k"], key=["k"])
    assert rows(keys) == [(i + 1, i) for i in range(500)] or rows(keys, "id")[0] == (1,)


def test_row_numbers_of_equal_keys_and_of_nothing(spark):
    same = spark.range(200).select(F.lit("x").alias("t"))
    got = with_row_number(same, ["t"])
    assert sorted(r.id for r in got.collect()) == list(range(1, 201))
    assert with_row_number(same.where("t = 'y'"), ["t"]).count() == 0


def test_checkpoints_go_to_the_shared_folder(spark):
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared.fresh_path(spark, "a") != shared.fresh_path(spark, "a")
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


@pytest.mark.parametrize("salts", [1, 8])
@pytest.mark.parametrize("hot", [[], ["a"], ["a", "b", "zzz"]])
def test_salted_join_is_a_plain_join(spark, hot, salts):
    left = spark.createDataFrame([("a", i) for i in range(60)] + [("b", 1), ("c", 2), (None, 3)],
                                 "k string, v int")
    right = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 0.3), ("d", 0.4)],
                                  "k string, p double")
    marks = spark.createDataFrame([(h,) for h in hot], "k string")
    got = salted_join(left, right, "k", marks, F.col("v"), salts)
    assert rows(got, "k", "v", "p") == rows(left.join(right, "k"), "k", "v", "p")


@pytest.mark.parametrize("kind", ["double", "decimal(15,2)"])
def test_money_sums_are_exact(spark, kind):
    values = ["0.10", "0.20", "-0.30", "104949.50", "0.01", "-7.29"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        F.col("v").cast(kind).alias("v"))
    units = df.select(hundredths(df, "v").alias("u"))
    assert str(units.agg(exact_sum("u", 2)).first()[0]) == "104942.22"
    assert str(units.agg(exact_sum("u", 0)).first()[0]) == "10494222"


def test_money_sums_do_not_overflow(spark):
    huge = spark.range(4).select(F.lit(2 ** 62).alias("u"))
    assert int(huge.agg(exact_sum("u", 0)).first()[0]) == 2 ** 64


def test_mean_seconds(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "s double")
    assert df.agg(mean_seconds("s")).first()[0] == pytest.approx(0.15)


def test_mean_and_median(spark):
    values = {"odd": [5, 1, 9], "even": [4, 4, 10, 1], "one": [7], "equal": [2] * 6, "pair": [1, 2],
              None: [3, 8], "many": [i * i % 4099 for i in range(6001)]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("odd", None)],
                               "k string, v bigint")
    got = {r.k: (r.runs, r["mean"], r["median"]) for r in mean_and_median(df, "k", "v").collect()}
    assert got == {k: (len(v), statistics.mean(v), statistics.median(v)) for k, v in values.items()}
