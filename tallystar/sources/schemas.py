"""Declared schemas of the files that are read (no schema is ever inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

TRAIN_DOCS = "label int, text string, doc_id bigint"
TEST_DOCS = "label int, text string"
MODEL = "label int, word string, label_probability double, word_probability double"

TPCH_RUNS = ("query_id string, query_index int, schema string, warehouse_size string, "
             "elapsed_seconds double, elapsed_ms bigint")
SENTIMENT_RUNS = "repetition int, query_type string, elapsed_seconds double, elapsed_ms bigint"

# Levels of operators, below the root of a profile, that are read as columns.
PROFILE_DEPTH = 10


def _operator(levels_below: int) -> T.StructType:
    children = (T.ArrayType(_operator(levels_below - 1)) if levels_below
                else T.StringType())
    return T.StructType([
        T.StructField("operator_type", T.StringType()),
        T.StructField("operator_timing", T.DoubleType()),
        T.StructField("operator_rows_scanned", T.LongType()),
        T.StructField("operator_cardinality", T.LongType()),
        T.StructField("cumulative_rows_scanned", T.LongType()),
        T.StructField("cumulative_cardinality", T.LongType()),
        T.StructField("result_set_size", T.LongType()),
        T.StructField("cpu_time", T.DoubleType()),
        T.StructField("extra_info", T.MapType(T.StringType(), T.StringType())),
        T.StructField("children", children),
    ])


def profile_schema(depth: int = PROFILE_DEPTH) -> T.StructType:
    """A run with its operator tree unrolled to ``depth`` levels.

    ``extra_info`` is a map to text, because its members are strings or arrays by turns; an
    array is kept as its JSON text. So are the children below the last level.
    """
    return T.StructType([
        T.StructField("benchmark_name", T.StringType()),
        T.StructField("scale_factor", T.StringType()),
        T.StructField("thread_count", T.StringType()),
        T.StructField("operator_timing", T.DoubleType()),
        T.StructField("cpu_time", T.DoubleType()),
        T.StructField("blocked_thread_time", T.DoubleType()),
        T.StructField("cumulative_rows_scanned", T.LongType()),
        T.StructField("cumulative_cardinality", T.LongType()),
        T.StructField("result_set_size", T.LongType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("children", T.ArrayType(_operator(depth - 1))),
    ])


# The members of one measurement of the source benchmark, as the files name
# them, each with the column name it gets here.
MEASUREMENT_FIELDS = {
    "Optimization": ("Optimization", "bigint"),
    "Execution": ("Execution", "bigint"),
    "Post-processing": ("Post_processing", "bigint"),
    "par-ex-000": ("par_ex_000", "bigint"),
    "par-ex-000-upper-estimate": ("par_ex_000_upper_estimate", "bigint"),
    "par-ex-000-lower-estimate": ("par_ex_000_lower_estimate", "bigint"),
    "par-ex-001": ("par_ex_001", "bigint"),
    "par-ex-001-upper-estimate": ("par_ex_001_upper_estimate", "bigint"),
    "par-ex-001-lower-estimate": ("par_ex_001_lower_estimate", "bigint"),
    "Estimate 1 (lower)": ("Estimate_1_lower", "bigint"),
    "Estimate 1 (upper)": ("Estimate_1_upper", "bigint"),
    "Measured cost-upper": ("Measured_cost_upper", "double"),
    "Measured cost-lower": ("Measured_cost_lower", "double"),
    "Estimated costs (1)-upper": ("Estimated_costs_1_upper", "double"),
    "Estimated costs (1)-lower": ("Estimated_costs_1_lower", "double"),
}

SOURCE_RECORD = "name string, filepath string, measurements array<struct<%s>>" % ", ".join(
    f"`{name}`: {kind}" for name, (_, kind) in MEASUREMENT_FIELDS.items())
