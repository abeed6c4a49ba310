"""TPC-H queries 1, 5 and 18 with their constants as parameters (K6).

``t`` maps table names to DataFrames. Measures may be doubles or decimals in the files;
they are summed in hundredths, so that results are exact and do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.money import exact_sum, hundredths

Tables = Mapping[str, DataFrame]


def q1(t: Tables, day: str = "1998-12-01", days_before: int = 90) -> DataFrame:
    """Pricing summary of the lines shipped up to ``days_before`` days before ``day``."""
    lineitem = t["lineitem"]
    cutoff = F.date_add(F.lit(day).cast("date"), -days_before)
    lines = lineitem.where(F.col("l_shipdate") <= cutoff).select(
        "l_returnflag", "l_linestatus",
        hundredths(lineitem, "l_quantity").alias("qty"),
        hundredths(lineitem, "l_extendedprice").alias("price"),
        hundredths(lineitem, "l_discount").alias("disc"),
        hundredths(lineitem, "l_tax").alias("tax"))
    lines = lines.withColumn("disc_price", F.col("price") * (100 - F.col("disc")))
    lines = lines.withColumn("charge", F.col("disc_price") * (100 + F.col("tax")))
    sums = lines.groupBy("l_returnflag", "l_linestatus").agg(
        exact_sum("qty", 2).alias("sum_qty"),
        exact_sum("price", 2).alias("sum_base_price"),
        exact_sum("disc_price", 4).alias("sum_disc_price"),
        exact_sum("charge", 6).alias("sum_charge"),
        exact_sum("disc", 2).alias("sum_disc"),
        F.count("*").alias("count_order"))

    def mean(total: str) -> Column:
        return F.col(total).cast("double") / F.col("count_order")

    return sums.select(
        "l_returnflag", "l_linestatus", "sum_qty", "sum_base_price", "sum_disc_price",
        "sum_charge", mean("sum_qty").alias("avg_qty"),
        mean("sum_base_price").alias("avg_price"), mean("sum_disc").alias("avg_disc"),
        "count_order").orderBy("l_returnflag", "l_linestatus")


def q5(t: Tables, region: str = "ASIA", first_day: str = "1997-01-01",
       years: int = 1) -> DataFrame:
    """Revenue per nation of one region from local suppliers.

    Joins go from the most selective table outwards, so the fact table meets orders that
    are already cut to the region and the period. No side is broadcast by hint: Spark does
    so where the measured size allows it, and shuffles otherwise.
    """
    lineitem = t["lineitem"]
    start = F.lit(first_day).cast("date")
    nations = (t["nation"].join(t["region"].where(F.col("r_name") == region),
                                F.col("n_regionkey") == F.col("r_regionkey"))
                          .select("n_nationkey", "n_name"))
    buyers = (t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
                           .select("c_custkey", "c_nationkey", "n_name"))
    bought = (t["orders"].where((F.col("o_orderdate") >= start)
                                & (F.col("o_orderdate") < F.add_months(start, 12 * years)))
                         .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
                         .select("o_orderkey", "c_nationkey", "n_name"))
    disc_price = hundredths(lineitem, "l_extendedprice") * (100 - hundredths(lineitem, "l_discount"))
    return (lineitem.select("l_orderkey", "l_suppkey", disc_price.alias("disc_price"))
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t["supplier"], (F.col("l_suppkey") == F.col("s_suppkey"))
                  & (F.col("c_nationkey") == F.col("s_nationkey")))
            .groupBy("n_name").agg(exact_sum("disc_price", 4).alias("revenue"))
            .orderBy(F.desc("revenue")))


Q18_GROUP = ("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def _quantities(t: Tables) -> DataFrame:
    return t["lineitem"].select("l_orderkey", hundredths(t["lineitem"], "l_quantity").alias("qty"))


def _large_orders(t: Tables, min_qty: int) -> DataFrame:
    """Orders above the threshold; the BIGINT sum of one order's lines cannot overflow."""
    return (_quantities(t).groupBy("l_orderkey").agg(F.sum("qty").alias("qty"))
                          .where(F.col("qty") > min_qty * 100))


def _q18_report(joined: DataFrame) -> DataFrame:
    return (joined.groupBy(*Q18_GROUP).agg(exact_sum("qty", 2).alias("sum_qty"))
                  .orderBy(F.desc("o_totalprice"), "o_orderdate"))


def q18(t: Tables, min_qty: int = 314) -> DataFrame:
    """Customers with very large orders, reading the fact table once.

    The quantity per order is already known from the group filter, and a sum over a join
    equals the sum of the per-key sums, so the lines need not be joined a second time.
    """
    return _q18_report(
        _large_orders(t, min_qty)
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey")))


def q18_semi_join(t: Tables, min_qty: int = 314) -> DataFrame:
    """The same report as it is usually written: orders ``IN`` the large ones, then lines."""
    wanted = t["orders"].join(_large_orders(t, min_qty),
                              F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return _q18_report(
        wanted.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
              .join(_quantities(t), F.col("o_orderkey") == F.col("l_orderkey")))
