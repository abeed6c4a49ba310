"""Exact mean and median per group from value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.sources.shared import checkpointed


def mean_and_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, runs, mean, median) of a column of whole numbers; nulls are left out.

    Equal values are counted first. The counts are range-partitioned by (key, value) and
    written once, so that a large group lies in many ranges: per range its rows are summed,
    ranges are numbered on by the sums before them, and only rows within a range are ordered.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    ranged = checkpointed(counts.repartitionByRange(key, value)
                          .withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(key, "_range").agg(F.sum("_n").alias("_sum")).select(
        key, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    totals = ranged.groupBy(key).agg(
        F.sum("_n").alias("_runs"),
        (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("_mean"))
    upto = Window.partitionBy(key, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (ranged.withColumn("_inside", F.sum("_n").over(upto))
              .join(sums.withColumnRenamed(key, "_k1"),
                    F.col(key).eqNullSafe(F.col("_k1")) & (ranged["_range"] == sums["_range"]))
              .join(totals.withColumnRenamed(key, "_k2"), F.col(key).eqNullSafe(F.col("_k2")))
              .withColumn("_upto", F.col("_inside") + F.col("_offset")))

    def at(position):
        here = (F.col("_upto") >= position) & (F.col("_upto") - F.col("_n") < position)
        return F.max(F.when(here, F.col(value)))

    middle = (at(F.expr("(_runs + 1) div 2")) + at(F.expr("_runs div 2 + 1"))) / 2
    return placed.groupBy(key).agg(F.max("_runs").alias("runs"), F.max("_mean").alias("mean"),
                                   middle.alias("median"))
