"""Query profiles from files: JSON arrays, JSON lines, and objects written back to back
(IO15, IO16, IO17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.sources.json_objects import read_objects
from tallystar.sources.schemas import PROFILE_DEPTH, profile_schema


def parse_profiles(lines: DataFrame, column: str = "value", depth: int = PROFILE_DEPTH) -> DataFrame:
    """One profile per row from JSON text; the other columns are kept.

    ``depth`` is the number of levels of operators that become columns; what lies below stays
    JSON text, which ``flatten`` reads when it is given the same depth.
    """
    kept = [c for c in lines.columns if c != column]
    parsed = F.from_json(column, profile_schema(depth), {"mode": "FAILFAST"}).alias("_p")
    return lines.select(*kept, parsed).select(*kept, "_p.*")


def read_profiles(spark: SparkSession, path: str, lines: bool = False,
                  depth: int = PROFILE_DEPTH) -> DataFrame:
    """Files that each hold one JSON array of profiles, or one profile per line."""
    if lines:
        return (spark.read.schema(profile_schema(depth)).option("mode", "FAILFAST").json(path))
    return parse_profiles(read_objects(spark, path), depth=depth)


def read_back_to_back(spark: SparkSession, path: str, depth: int = PROFILE_DEPTH) -> DataFrame:
    """Profiles from objects that follow each other, with any white space or none between."""
    return parse_profiles(read_objects(spark, path), depth=depth)


def split_by_benchmark(profiles: DataFrame, path: str, names: Sequence[str] | None = None) -> None:
    """One folder of JSON lines per benchmark name, of all names or the listed ones.

    Rebalancing gives a name few files and splits one that is too large for a task.
    """
    chosen = profiles if names is None else profiles.where(F.col("benchmark_name").isin(*names))
    (chosen.hint("rebalance", "benchmark_name")
           .write.mode("overwrite").partitionBy("benchmark_name").json(path))
