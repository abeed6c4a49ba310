"""Timed runs of workloads over configurations and repetitions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

STATEMENT_ROWS = ("query_id string, workload string, configuration string, repetition int, "
                  "user_name string, execution_status string, start_time double, "
                  "total_elapsed_time bigint, error string")


def run_whole(df: DataFrame) -> None:
    """Compute all rows and columns of a query and throw them away."""
    df.write.format("noop").mode("overwrite").save()


def run_grid(spark: SparkSession, workloads: Mapping[str, Callable[[SparkSession], DataFrame]],
             configurations: Mapping[str, Mapping[str, str]] | None = None,
             repetitions: int = 3, user: str = "bench") -> DataFrame:
    """Time every workload under every configuration; one row per run, failures included.

    A configuration is a set of session settings, put back afterwards. Nothing may be
    served from a cache, so cached tables are dropped before each run.
    """
    rows = []
    for configuration, settings in (configurations or {"default": {}}).items():
        before = {key: spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            for workload, build in workloads.items():
                for repetition in range(repetitions):
                    spark.catalog.clearCache()
                    started, clock = time.time(), time.perf_counter()
                    try:
                        run_whole(build(spark))
                        status, error = "SUCCESS", None
                    except Exception as failure:
                        status, error = "FAIL", str(failure)
                    elapsed = round((time.perf_counter() - clock) * 1000)
                    rows.append((uuid.uuid4().hex, workload, configuration, repetition, user,
                                 status, started, elapsed, error))
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.createDataFrame(rows, STATEMENT_ROWS)
