import datetime

import pytest
from pyspark.sql import functions as F

from checks.common import tpch_tables
from conftest import rows
from tallystar.plans import ssb, tpch
from tallystar.plans.star import STAR_TABLES, read_star, star_of, write_star

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return tpch_tables(spark, SF)


@pytest.fixture(scope="module")
def star(tables):
    return star_of(tables)


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    write_star(star, folder)
    return read_star(spark, folder)


def test_q1_pushes_its_filter_and_prunes(tables):
    plan = plan_of(tpch.q1(tables))
    assert "LessThanOrEqual(l_shipdate,1998-09-02T00:00)" in plan
    assert "l_orderkey" not in plan and "l_partkey" not in plan


def test_q1_cutoff_is_a_parameter(tables):
    day = "1997-06-30"
    total = tpch.q1(tables, day, 0).agg(F.sum("count_order")).first()[0]
    assert total == tables["lineitem"].where(F.col("l_shipdate") <= F.lit(day).cast("date")).count()


def test_q18_reads_the_fact_table_once(tables):
    plan = plan_of(tpch.q18(tables))
    assert plan.count("l_quantity#") and plan.count("lineitem.parquet") == 1
    assert "LeftSemi" in plan_of(tpch.q18_semi_join(tables))


def test_q18_forms_agree_even_with_repeated_orders(tables):
    repeated = dict(tables, orders=tables["orders"].unionAll(tables["orders"].where("o_orderkey < 300")))
    one = rows(tpch.q18(repeated, 200))
    assert one == rows(tpch.q18_semi_join(repeated, 200)) and len(one) > 10


def test_decimal_tables_give_the_same(tables):
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    exact = dict(tables, lineitem=tables["lineitem"].select(*(
        F.col(c).cast("decimal(15,2)").alias(c) if c in measures else F.col(c)
        for c in tables["lineitem"].columns)))
    assert rows(tpch.q1(exact)) == rows(tpch.q1(tables))
    assert rows(tpch.q5(exact)) == rows(tpch.q5(tables))


CALLS = [
    (ssb.q1_1, dict(year=1996)), (ssb.q1_2, dict(yearmonthnum=199601)),
    (ssb.q1_3, dict(year=1996)), (ssb.q2_1, dict(category="ECONOMY#2")),
    (ssb.q2_2, dict(brands=("Brand#21", "Brand#25"))), (ssb.q2_3, dict(brand="Brand#22")),
    (ssb.q3_1, dict(first=1995, last=2000)), (ssb.q3_2, dict(nation="NATION_7", last=2000)),
    (ssb.q3_3, dict(cities=["NATION_3", "NATION_8"], last=2001)),
    (ssb.q3_4, dict(cities=["NATION_3", "NATION_8"])),
    (ssb.q4_1, dict(mfgrs=["PROMO", "ECONOMY"])), (ssb.q4_2, dict(mfgrs=["PROMO", "ECONOMY"])),
    (ssb.q4_3, dict(nation="NATION_6", category="ECONOMY#2")),
]


@pytest.mark.parametrize("query,constants", CALLS, ids=[q.__name__ for q, _ in CALLS])
def test_stored_star_gives_the_same(star, stored, query, constants):
    assert rows(query(stored, **constants)) == rows(query(star, **constants))


def test_stored_star_prunes_months_and_keeps_the_fact_in_place(stored):
    df = ssb.q1_1(stored, year=1996)
    assert "dynamicpruning" in plan_of(df).lower()
    assert "lo_yearmonthnum" in plan_of(df).lower().split("dynamicpruning")[0]
    assert "lineitem" not in plan_of(df) and "orders" not in plan_of(df)
    plan = plan_of(ssb.q4_1(stored, mfgrs=["PROMO"]))
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan


def test_star_tables(star, tables):
    assert set(star) == set(STAR_TABLES)
    assert star["lineorder"].count() == tables["lineitem"].count()
    days = star["date"]
    assert days.count() == days.select("d_datekey").distinct().count()
    for r in days.collect():
        day = r.d_datekey
        assert (r.d_year, r.d_yearmonthnum, r.d_yearmonth, r.d_weeknuminyear) == (
            day.year, day.year * 100 + day.month, f"{day:%b%Y}", (day.timetuple().tm_yday - 1) // 7 + 1)


def test_golden_flight_one(spark):
    day = datetime.date(1994, 1, 3)
    fact = spark.createDataFrame(
        [(day, 24, 1, 100), (day, 25, 1, 1000), (day, 5, 4, 1000), (day, 1, 3, 10),
         (datetime.date(1995, 1, 3), 5, 2, 1000)],
        "lo_orderdate date, lo_quantity int, lo_discount int, lo_extendedprice bigint")
    dates = spark.createDataFrame([(day, 1994), (datetime.date(1995, 1, 3), 1995)],
                                  "d_datekey date, d_year int")
    assert int(ssb.q1_1({"lineorder": fact, "date": dates}).first().revenue) == 130


def test_results_come_in_their_order(tables, star):
    def in_order(df, *keys):
        got = [tuple(-r[k[1:]] if k[0] == "-" else r[k] for k in keys) for r in df.collect()]
        assert got and got == sorted(got)

    in_order(tpch.q1(tables), "l_returnflag", "l_linestatus")
    in_order(tpch.q5(tables), "-revenue")
    in_order(tpch.q18(tables, 200), "-o_totalprice", "o_orderdate")
    in_order(ssb.q2_1(star, category="ECONOMY#2"), "d_year", "p_brand1")
    in_order(ssb.q3_1(star, first=1995, last=2000), "d_year", "-revenue")
    in_order(ssb.q4_1(star, mfgrs=["PROMO", "ECONOMY"]), "d_year", "c_nation")


def test_views_cut_both_sides_before_they_meet(star):
    plan = plan_of(ssb.q4_1(star, mfgrs=["PROMO"]))
    assert plan.count("BroadcastHashJoin") >= 4 and plan.count("lineitem.parquet") == 1


def test_the_stored_fact_is_joined_without_sorting_lines(star, stored):
    plan = plan_of(star["lineorder"])
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
    assert rows(stored["lineorder"].drop("lo_yearmonthnum"), *star["lineorder"].columns) == rows(star["lineorder"])
