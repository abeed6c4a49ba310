"""The star schema as views over TPC-H-like tables, and as stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.money import hundredths
from tallystar.sources.lazy import LazyTables

# The partitions of a stored fact table, as in the date table's d_yearmonthnum.
MONTH = "lo_yearmonthnum"
# What follows from the other columns of a line.
DERIVED = ("lo_revenue", "lo_supplycost")
STAR_TABLES = ("lineorder", "date", "customer", "supplier", "part")


class StarViews(LazyTables):
    """The star as views; ``sides`` are the two tables of which the fact table is the join."""

    sides: LazyTables


def _lines(t: Mapping[str, DataFrame]) -> DataFrame:
    """The line side of the fact; money is a whole number of cents, as the benchmark has it."""
    lineitem = t["lineitem"]
    return lineitem.select(
        F.col("l_orderkey").alias("lo_orderkey"), F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        F.col("l_quantity").cast("int").alias("lo_quantity"),
        hundredths(lineitem, "l_extendedprice").alias("lo_extendedprice"),
        hundredths(lineitem, "l_discount").cast("int").alias("lo_discount"))


def _with_derived(lines: DataFrame) -> DataFrame:
    """Revenue and cost; a row that is stored travels without them."""
    return lines.select(
        "*", F.expr("lo_extendedprice * (100 - lo_discount) div 100").alias("lo_revenue"),
        # 60 % of the price of one piece.
        F.expr("lo_extendedprice * 6 div nullif(lo_quantity * 10, 0)").alias("lo_supplycost"))


def _orders(t: Mapping[str, DataFrame]) -> DataFrame:
    """The order side of the fact."""
    return t["orders"].select(
        F.col("o_orderkey").alias("lo_orderkey"), F.col("o_custkey").alias("lo_custkey"),
        F.to_date("o_orderdate").alias("lo_orderdate"))


def _calendar(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per day from the first order to the last; no row of the orders travels for it."""
    day = F.col("d_datekey")
    ends = t["orders"].agg(F.min(F.to_date("o_orderdate")).alias("first"),
                           F.max(F.to_date("o_orderdate")).alias("last"))
    return (ends.select(F.explode(F.sequence("first", "last")).alias("d_datekey"))
            .select("d_datekey", F.year(day).alias("d_year"),
                    (F.year(day) * 100 + F.month(day)).alias("d_yearmonthnum"),
                    F.date_format(day, "MMMyyyy").alias("d_yearmonth"),
                    F.expr("(dayofyear(d_datekey) - 1) div 7 + 1").cast("int").alias("d_weeknuminyear")))


def _with_place(table: DataFrame, prefix: str, t: Mapping[str, DataFrame]) -> DataFrame:
    """Key, city, nation and region; the tables know no city, so the nation stands for it.

    The benchmark's 25 nations are one map, not a join: so the size that Spark estimates for
    the table is its own, and decides whether it is broadcast.
    """
    places = (t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
              .agg(F.map_from_entries(F.collect_list(F.struct(
                  "n_nationkey", F.struct("n_name", "r_name"))))).scalar())
    placed = table.withColumn("_place", F.try_element_at(places, F.col(f"{prefix}_nationkey")))
    return (placed.where("_place IS NOT NULL")
            .select(F.col("_place.n_name").alias(f"{prefix}_city"),
                    F.col("_place.n_name").alias(f"{prefix}_nation"),
                    F.col("_place.r_name").alias(f"{prefix}_region"),
                    f"{prefix}_{'cust' if prefix == 'c' else 'supp'}key"))


def _parts(t: Mapping[str, DataFrame]) -> DataFrame:
    """The part type stands for the manufacturer, with a size class for the category."""
    return t["part"].select(
        "p_partkey", F.col("p_type").alias("p_mfgr"),
        F.concat("p_type", F.lit("#"), F.expr("p_size % 5 + 1")).alias("p_category"),
        F.col("p_brand").alias("p_brand1"))


def star_of(t: Mapping[str, DataFrame]) -> StarViews:
    """The five star tables as views."""
    sides = LazyTables({"lines": lambda: _with_derived(_lines(t)), "orders": lambda: _orders(t)})
    star = StarViews({
        "lineorder": lambda: sides["lines"].join(
            # A hash table of a partition's orders saves the sort of all lines.
            sides["orders"].hint("shuffle_hash"), "lo_orderkey"), "date": lambda: _calendar(t),
        "customer": lambda: _with_place(t["customer"], "c", t),
        "supplier": lambda: _with_place(t["supplier"], "s", t), "part": lambda: _parts(t)})
    star.sides = sides
    return star


def write_star(star: Mapping[str, DataFrame], folder: str) -> None:
    """Store the star so that the fact join is paid once.

    The fact table is partitioned by the month of the order and sorted by its day: a filter on
    the date table then prunes partitions of the fact at run time, and days within a month are
    skipped by the bounds of row groups. Rebalancing gives each month few files and splits a
    month that is too large for one task.
    """
    for name in STAR_TABLES:
        table = star[name]
        if name == "lineorder":
            day = F.col("lo_orderdate")
            held = table.drop(*DERIVED) if isinstance(star, StarViews) else table
            monthly = held.withColumn(MONTH, F.year(day) * 100 + F.month(day))
            placed = monthly.hint("rebalance", MONTH).sortWithinPartitions(MONTH, day)
            full = placed if held is table else _with_derived(placed).select(*table.columns, MONTH)
            writer = full.write.partitionBy(MONTH)
        else:
            writer = table.write
        writer.mode("overwrite").parquet(f"{folder}/{name}")


def read_star(spark: SparkSession, folder: str) -> LazyTables:
    """The tables as ``write_star`` stored them."""
    return LazyTables({name: lambda name=name: spark.read.parquet(f"{folder}/{name}")
                       for name in STAR_TABLES})
