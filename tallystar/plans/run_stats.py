"""Aggregation of run statistics: TPC-H grid, classifier runs, source benchmark
(K13, K14, K15, J16, J17, P9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions.seconds import mean_seconds
from tallystar.operators.median import mean_and_median
from tallystar.plans.profiles import pivot_series

# The TPC-H number of each position in the list of benchmark queries.
QUERY_NUMBERS = {0: 1, 1: 5, 2: 18}
WAREHOUSES = ("X-Small", "Small", "Medium", "Large")


def finished_runs(history: DataFrame, user: str, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Successful runs of a user with the wanted ids, newest first.

    Ids come as a short list, which becomes a filter, or as a table with ``query_id``.
    """
    mine = history.where((F.col("user_name") == user) & (F.col("execution_status") == "SUCCESS"))
    if isinstance(ids, DataFrame):
        mine = mine.join(ids.select("query_id"), "query_id", "left_semi")
    else:
        mine = mine.where(F.col("query_id").isin(*ids))
    return mine.select(
        "query_id", "schema_name", "warehouse_size",
        (F.col("total_elapsed_time") / 1000).alias("elapsed_seconds"),
        F.col("total_elapsed_time").alias("elapsed_ms"), "start_time"
    ).orderBy(F.desc("start_time"))


def attach_timings(statements: DataFrame, timings: DataFrame) -> DataFrame:
    """Statements with the timings recorded under their ``query_id``."""
    return statements.join(timings, "query_id")


def by_repetition(statements: DataFrame) -> DataFrame:
    """Time of all statements of one repetition and type together."""
    return (statements.groupBy("repetition", "query_type")
            .agg(F.sum("elapsed_ms").alias("elapsed_ms"))
            .select("repetition", "query_type",
                    (F.col("elapsed_ms") / 1000).alias("elapsed_seconds"), "elapsed_ms"))


def by_query_type(stats: DataFrame) -> DataFrame:
    """Mean seconds per query type over its repetitions."""
    return stats.groupBy("query_type").agg(mean_seconds("elapsed_seconds").alias("elapsed_seconds"))


def with_query_number(stats: DataFrame) -> DataFrame:
    """The TPC-H number instead of the position; a position without one is an error."""
    numbers = F.create_map(*(F.lit(v) for pair in QUERY_NUMBERS.items() for v in pair))
    unknown = F.raise_error(F.concat(F.lit("no query at position "), F.coalesce(
        F.col("query_index").cast("string"), F.lit("null")))).cast("int")
    return stats.withColumn("query", F.coalesce(F.try_element_at(numbers, "query_index"), unknown))


def by_configuration(stats: DataFrame) -> DataFrame:
    """Mean seconds and milliseconds per query, schema and warehouse, and log of the latter."""
    means = with_query_number(stats).groupBy("query", "schema", "warehouse_size").agg(
        mean_seconds("elapsed_seconds").alias("elapsed_seconds"), F.avg("elapsed_ms").alias("elapsed_ms"))
    return means.withColumn("log_ms", F.log("elapsed_ms"))


def log_series(configurations: DataFrame, warehouses: Sequence[str] = WAREHOUSES) -> DataFrame:
    """Per query and schema, the logarithmic time on each warehouse."""
    return pivot_series(configurations, ["query", "schema"], "warehouse_size", warehouses, "log_ms")


def largest_log(configurations: DataFrame) -> DataFrame:
    """One row: the largest logarithmic time of all."""
    return configurations.agg(F.max("log_ms").alias("largest"))


def by_dataset(measured: DataFrame) -> DataFrame:
    """Mean and median seconds per data set, in order of name.

    The median shows a run far off the others, which moves the mean.
    """
    return mean_and_median(measured, "name", "Execution").select(
        "name", "runs", (F.col("mean") / 1000).alias("mean_seconds"),
        (F.col("median") / 1000).alias("median_seconds")).orderBy("name")


def mean_of_numbers(numbers: DataFrame) -> DataFrame:
    """One row: the mean of a column of numbers."""
    return numbers.agg(F.avg("value").alias("mean"))
