"""Names of benchmarks and data files taken apart (F9, F10), small scalings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_name(benchmark_name: Column) -> Column:
    """``SSBQ1v1S100T1`` -> ``1.1``."""
    dotted = F.replace(F.replace(benchmark_name, F.lit("Q"), F.lit("")), F.lit("v"), F.lit("."))
    return F.substring(dotted, 4, 3)


def file_stem(path: Column) -> Column:
    """Base name of a path without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    """Last extension of a path's base name, without the dot; empty if it has none."""
    return F.regexp_extract(path, r"[^/]\.([^./]*)$", 1)


def has_projection(name: Column) -> Column:
    """Whether one of the dash-separated parts of the name is ``projection``."""
    return F.array_contains(F.split(name, "-"), "projection")


def log_normalised(value: Column) -> Column:
    return F.log(value + F.lit(1e-10))
