"""TPC-H and star-schema queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.common import Query, plain, tpch_tables
from tallystar.plans import ssb, tpch
from tallystar.plans.star import read_star, star_of, write_star
from tallystar.sources.lazy import LazyTables
from tallystar.sources.shared import fresh_path


def _tpch(build: Callable[..., DataFrame], **constants) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(tpch_tables(spark, sf_dir), **constants))
    return run


def _ssb_on_views(build: Callable[..., DataFrame], **constants) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(star_of(tpch_tables(spark, sf_dir)), **constants))
    return run


_stored: dict[tuple[str, str], str] = {}


def stored_star(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The star of the tables, stored once per application in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        folder = fresh_path(spark, "star")
        write_star(star_of(tpch_tables(spark, sf_dir)), folder)
        _stored[key] = folder
    return read_star(spark, _stored[key])


def _ssb(build: Callable[..., DataFrame], **constants) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(stored_star(spark, sf_dir), **constants))
    return run


# The tables begin in 1995 and know other names than the benchmark, so constants differ.
STAR_QUERIES: dict[str, tuple[Callable[..., DataFrame], dict]] = {
    "q1_1": (ssb.q1_1, dict(year=1996)),
    "q1_2": (ssb.q1_2, dict(yearmonthnum=199601)),
    "q1_3": (ssb.q1_3, dict(week=6, year=1996)),
    "q2_1": (ssb.q2_1, dict(category="ECONOMY#2")),
    "q2_2": (ssb.q2_2, dict(brands=("Brand#21", "Brand#25"))),
    "q2_3": (ssb.q2_3, dict(brand="Brand#22")),
    "q3_1": (ssb.q3_1, dict(first=1995, last=2000)),
    "q3_2": (ssb.q3_2, dict(nation="NATION_7", first=1995, last=2000)),
    "q3_3": (ssb.q3_3, dict(cities=("NATION_3", "NATION_8"), first=1995, last=2000)),
    "q3_4": (ssb.q3_4, dict(cities=("NATION_3", "NATION_8"), yearmonth="Dec1997")),
    "q4_1": (ssb.q4_1, dict(mfgrs=("PROMO", "ECONOMY"))),
    "q4_2": (ssb.q4_2, dict(mfgrs=("PROMO", "ECONOMY"))),
    "q4_3": (ssb.q4_3, dict(nation="NATION_6", category="ECONOMY#2")),
}

# Star queries run on the stored star, and on views over the given tables.
QUERIES: dict[str, Query] = {
    "tpch_q1": _tpch(tpch.q1),
    "tpch_q5": _tpch(tpch.q5),
    "tpch_q18": _tpch(tpch.q18),
    "tpch_q18_semi_join": _tpch(tpch.q18_semi_join),
    **{f"ssb_{name}": _ssb(build, **constants) for name, (build, constants) in STAR_QUERIES.items()},
    **{f"ssb_view_{name}": _ssb_on_views(build, **constants)
       for name, (build, constants) in STAR_QUERIES.items()},
}

PRICE = "CAST(l_extendedprice AS DECIMAL(15,2))"
DISC_PRICE = f"{PRICE} * (1 - CAST(l_discount AS DECIMAL(15,2)))"

Q18 = """
SELECT c_name, c_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
       CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS sum_qty
FROM customer, orders, lineitem
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
                     HAVING sum(CAST(l_quantity AS DECIMAL(15,2))) > 314)
  AND c_custkey = o_custkey AND o_orderkey = l_orderkey
GROUP BY c_name, c_custkey, o_orderkey, orders.o_orderdate, o_totalprice
"""

STAR = """
WITH lineorder AS (
  SELECT *, lo_extendedprice * (100 - lo_discount) // 100 AS lo_revenue,
         lo_extendedprice * 6 // (lo_quantity * 10) AS lo_supplycost
  FROM (SELECT o_custkey AS lo_custkey, l_partkey AS lo_partkey, l_suppkey AS lo_suppkey,
               CAST(o_orderdate AS DATE) AS lo_orderdate,
               CAST(l_quantity AS INTEGER) AS lo_quantity,
               CAST(round(l_discount * 100) AS INTEGER) AS lo_discount,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS lo_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
days AS (
  SELECT d AS d_datekey, CAST(year(d) AS INTEGER) AS d_year,
         CAST(year(d) * 100 + month(d) AS INTEGER) AS d_yearmonthnum,
         strftime(d, '%b%Y') AS d_yearmonth, (dayofyear(d) - 1) // 7 + 1 AS d_weeknuminyear
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)),
places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
buyers AS (SELECT c_custkey, n_name AS c_city, n_name AS c_nation, r_name AS c_region
           FROM customer JOIN places ON c_nationkey = n_nationkey),
sellers AS (SELECT s_suppkey, n_name AS s_city, n_name AS s_nation, r_name AS s_region
            FROM supplier JOIN places ON s_nationkey = n_nationkey),
parts AS (SELECT p_partkey, p_type AS p_mfgr, p_type || '#' || (p_size % 5 + 1) AS p_category,
                 p_brand AS p_brand1 FROM part)
"""

BY_DAY = "JOIN days ON lo_orderdate = d_datekey"
BY_SELLER = "JOIN sellers ON lo_suppkey = s_suppkey"
BY_BUYER = "JOIN buyers ON lo_custkey = c_custkey"
BY_PART = "JOIN parts ON lo_partkey = p_partkey"


def _flight1(where: str) -> str:
    return f"""{STAR} SELECT CAST(sum(lo_extendedprice * lo_discount) AS DOUBLE) AS revenue
               FROM lineorder {BY_DAY} WHERE {where}"""


def _flight2(where: str) -> str:
    return f"""{STAR} SELECT d_year, p_brand1, CAST(sum(lo_revenue) AS DOUBLE) AS revenue
               FROM lineorder {BY_DAY} {BY_SELLER} {BY_PART} WHERE {where}
               GROUP BY d_year, p_brand1"""


def _flight3(place: str, where: str) -> str:
    return f"""{STAR} SELECT c_{place}, s_{place}, d_year, CAST(sum(lo_revenue) AS DOUBLE) AS revenue
               FROM lineorder {BY_DAY} {BY_SELLER} {BY_BUYER} WHERE {where}
               GROUP BY c_{place}, s_{place}, d_year"""


def _flight4(group: str, where: str) -> str:
    return f"""{STAR} SELECT {group}, CAST(sum(lo_revenue - lo_supplycost) AS DOUBLE) AS profit
               FROM lineorder {BY_DAY} {BY_SELLER} {BY_BUYER} {BY_PART} WHERE {where}
               GROUP BY {group}"""


ORACLES: dict[str, str] = {
    "tpch_q1": f"""
        SELECT l_returnflag, l_linestatus,
               CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS sum_qty,
               CAST(sum({PRICE}) AS DOUBLE) AS sum_base_price,
               CAST(sum({DISC_PRICE}) AS DOUBLE) AS sum_disc_price,
               CAST(sum({DISC_PRICE} * (1 + CAST(l_tax AS DECIMAL(15,2)))) AS DOUBLE) AS sum_charge,
               CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_qty,
               CAST(sum({PRICE}) AS DOUBLE) / count(*) AS avg_price,
               CAST(sum(CAST(l_discount AS DECIMAL(15,2))) AS DOUBLE) / count(*) AS avg_disc,
               count(*) AS count_order
        FROM lineitem WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
        GROUP BY l_returnflag, l_linestatus""",
    "tpch_q5": f"""
        SELECT n_name, CAST(sum({DISC_PRICE}) AS DOUBLE) AS revenue
        FROM customer, orders, lineitem, supplier, nation, region
        WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
          AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey
          AND n_regionkey = r_regionkey AND r_name = 'ASIA'
          AND o_orderdate >= DATE '1997-01-01'
          AND o_orderdate < DATE '1997-01-01' + INTERVAL 1 YEAR
        GROUP BY n_name""",
    "tpch_q18": Q18,
    "tpch_q18_semi_join": Q18,
    "ssb_q1_1": _flight1("d_year = 1996 AND lo_discount BETWEEN 1 AND 3 AND lo_quantity < 25"),
    "ssb_q1_2": _flight1("d_yearmonthnum = 199601 AND lo_discount BETWEEN 4 AND 6 "
                         "AND lo_quantity BETWEEN 26 AND 35"),
    "ssb_q1_3": _flight1("d_weeknuminyear = 6 AND d_year = 1996 AND lo_discount BETWEEN 5 AND 7 "
                         "AND lo_quantity BETWEEN 26 AND 35"),
    "ssb_q2_1": _flight2("p_category = 'ECONOMY#2' AND s_region = 'AMERICA'"),
    "ssb_q2_2": _flight2("p_brand1 BETWEEN 'Brand#21' AND 'Brand#25' AND s_region = 'ASIA'"),
    "ssb_q2_3": _flight2("p_brand1 = 'Brand#22' AND s_region = 'EUROPE'"),
    "ssb_q3_1": _flight3("nation", "c_region = 'ASIA' AND s_region = 'ASIA' "
                                   "AND d_year BETWEEN 1995 AND 2000"),
    "ssb_q3_2": _flight3("city", "c_nation = 'NATION_7' AND s_nation = 'NATION_7' "
                                 "AND d_year BETWEEN 1995 AND 2000"),
    "ssb_q3_3": _flight3("city", "c_city IN ('NATION_3', 'NATION_8') "
                                 "AND s_city IN ('NATION_3', 'NATION_8') "
                                 "AND d_year BETWEEN 1995 AND 2000"),
    "ssb_q3_4": _flight3("city", "c_city IN ('NATION_3', 'NATION_8') "
                                 "AND s_city IN ('NATION_3', 'NATION_8') "
                                 "AND d_yearmonth = 'Dec1997'"),
    "ssb_q4_1": _flight4("d_year, c_nation",
                         "c_region = 'AMERICA' AND s_region = 'AMERICA' "
                         "AND p_mfgr IN ('PROMO', 'ECONOMY')"),
    "ssb_q4_2": _flight4("d_year, s_nation, p_category",
                         "c_region = 'AMERICA' AND s_region = 'AMERICA' "
                         "AND d_year IN (1997, 1998) AND p_mfgr IN ('PROMO', 'ECONOMY')"),
    "ssb_q4_3": _flight4("d_year, s_city, p_brand1",
                         "c_region = 'AMERICA' AND s_nation = 'NATION_6' "
                         "AND d_year IN (1997, 1998) AND p_category = 'ECONOMY#2'"),
}
ORACLES |= {f"ssb_view_{name}": ORACLES[f"ssb_{name}"] for name in STAR_QUERIES}
