"""Benchmark records: run statistics as CSV, source benchmarks as JSON, plain numbers
(IO13, IO14, IO18, IO19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.naming import file_extension, file_stem, has_projection
from tallystar.sources.json_objects import read_objects
from tallystar.sources.schemas import MEASUREMENT_FIELDS, SOURCE_RECORD


def read_stats(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Statistics rows, ``;``-separated and without a header."""
    return spark.read.schema(schema).option("sep", ";").option("mode", "FAILFAST").csv(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Statistics rows as a folder of ``;``-separated files without headers."""
    stats.write.mode("overwrite").option("sep", ";").csv(path)


def measurements(records: DataFrame) -> DataFrame:
    """One row per measurement of ``records(name, filepath, measurements)``.

    The data set is named after its file, its type and whether columns were projected; the
    workload is the part of the record's name before the first dash.
    """
    stem, kind = file_stem(F.col("filepath")), file_extension(F.col("filepath"))
    projected = has_projection(F.col("name"))
    tail = F.when(projected, F.lit("-projection")).otherwise(F.lit(""))
    fields = [F.col("m")[name].alias(alias) for name, (alias, _) in MEASUREMENT_FIELDS.items()]
    named = records.select(
        F.concat(stem, F.lit("-"), kind, tail).alias("name"),
        F.split_part("name", F.lit("-"), F.lit(1)).alias("workload"),
        projected.alias("projection"), "filepath", kind.alias("file_type"), "measurements")
    # The outer form keeps Spark from adding a filter that would parse the JSON a second time.
    each = named.select("name", "workload", "projection", "filepath", "file_type",
                        F.explode_outer("measurements").alias("m")).where("m is not null")
    return each.select("name", "workload", "projection", "filepath", "file_type", *fields)


def parse_source_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Source-benchmark records from JSON text, one per row."""
    return lines.select(F.from_json(column, SOURCE_RECORD, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_source_records(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of source-benchmark records."""
    return parse_source_records(read_objects(spark, path))


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """One number per line as the column ``value``."""
    return spark.read.text(path).select(F.trim("value").cast("double").alias("value"))
