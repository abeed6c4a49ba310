"""Aggregation of query profiles per run, operator position and operator type."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.naming import query_name
from tallystar.functions.seconds import mean_of_sums, mean_seconds, second_sums
from tallystar.sources.schemas import PROFILE_DEPTH

RUN_KEYS = ("benchmark_name", "query", "scale_factor", "threads")
METRICS = ("timing", "rows_scanned", "cardinality")


def runs(profiles: DataFrame) -> DataFrame:
    """One row per run: its name taken apart, elapsed time and cumulative counters."""
    return profiles.select(
        "benchmark_name", query_name(F.col("benchmark_name")).alias("query"),
        F.col("scale_factor").cast("int").alias("scale_factor"),
        F.col("thread_count").cast("int").alias("threads"),
        F.col("operator_timing").alias("elapsed"),
        "cumulative_rows_scanned", "cumulative_cardinality")


def select_runs(df: DataFrame, queries: Sequence[str] | None = None,
                threads: Sequence[int] | None = None,
                scale_factors: Sequence[int] | None = None) -> DataFrame:
    """Rows of the chosen queries, thread counts and scale factors; None means all."""
    for column, wanted in (("query", queries), ("threads", threads),
                           ("scale_factor", scale_factors)):
        if wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    return df


def by_run_group(run_rows: DataFrame) -> DataFrame:
    """Runs of one benchmark name together: fastest, slowest and mean, mean counters."""
    return run_rows.groupBy(*RUN_KEYS).agg(
        F.count("*").alias("runs"),
        F.min("elapsed").alias("min_elapsed"), F.max("elapsed").alias("max_elapsed"),
        mean_seconds("elapsed").alias("avg_elapsed"),
        F.avg("cumulative_rows_scanned").alias("avg_rows_scanned"),
        F.avg("cumulative_cardinality").alias("avg_cardinality")).orderBy("benchmark_name")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column in order."""
    return df.select(column).distinct().orderBy(column)


def listed(info: Column, member: str) -> Column:
    """A member of ``extra_info`` that is a string or an array, always as an array."""
    value = info[member]
    return F.when(F.startswith(value, F.lit("[")), F.from_json(value, "array<string>")).when(
        value.isNotNull(), F.array(value))


def _node(at: Column) -> Column:
    """The fields of one operator that are kept, with its place in the tree."""
    node = at["node"]
    info = F.coalesce(node["extra_info"], F.create_map().cast("map<string,string>"))
    return F.struct(
        at["path"].alias("path"), node["operator_type"].alias("operator_type"),
        F.try_element_at(info, F.lit("Text")).alias("table"),
        node["operator_timing"].alias("timing"),
        node["operator_rows_scanned"].alias("rows_scanned"),
        node["operator_cardinality"].alias("cardinality"),
        F.map_contains_key(info, "Filters").alias("has_filter"),
        F.map_contains_key(info, "Projections").alias("has_projection"))


def _children(at: Column) -> Column:
    return F.transform(F.coalesce(at["node"]["children"], F.array()), lambda child, i: F.struct(
        F.concat(at["path"], F.array(i)).alias("path"), child.alias("node")))


#: What ``_node`` makes of an operator.
_NODE = ("path array<int>, operator_type string, table string, timing double, "
         "rows_scanned bigint, cardinality bigint, has_filter boolean, has_projection boolean")


def _below(rests: str) -> Column:
    """The operators in texts of children with their paths, however deep."""
    node_type = pa.list_(pa.struct([
        ("path", pa.list_(pa.int32())), ("operator_type", pa.string()), ("table", pa.string()),
        ("timing", pa.float64()), ("rows_scanned", pa.int64()), ("cardinality", pa.int64()),
        ("has_filter", pa.bool_()), ("has_projection", pa.bool_())]))

    def walk(path: list[int], rest: str) -> Iterator[dict]:
        todo = [([*path, i], node) for i, node in enumerate(json.loads(rest) or [])]
        while todo:
            path, node = todo.pop()
            info = node.get("extra_info") or {}
            text = info.get("Text")
            if text is not None and not isinstance(text, str):
                text = json.dumps(text, separators=(",", ":"), ensure_ascii=False)
            yield {"path": path, "operator_type": node.get("operator_type"), "table": text,
                   "timing": node.get("operator_timing"),
                   "rows_scanned": node.get("operator_rows_scanned"),
                   "cardinality": node.get("operator_cardinality"),
                   "has_filter": "Filters" in info, "has_projection": "Projections" in info}
            todo += [([*path, i], child) for i, child in enumerate(node.get("children") or [])]

    def found(column: pa.Array) -> pa.Array:
        return pa.array([[node for at in row or () for node in walk(at["path"], at["rest"])]
                         for row in column.to_pylist()], node_type)

    found.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, f"array<struct<{_NODE}>>")(rests)


def flatten(profiles: DataFrame, depth: int = PROFILE_DEPTH) -> DataFrame:
    """One row per operator of every run.

    ``path`` holds the child positions, first that of the root among the profile's children. The
    tree is walked level by level inside the row, so no shuffle is needed: ``done`` collects
    operators and ``todo`` holds the subtrees still to visit. ``depth`` is the number of levels
    that the profiles were parsed to. Subtrees below them, of any depth that the JSON parser takes
    (1,000 nested brackets, so about 490 levels), go through an Arrow function as their text.
    """
    root = F.transform(F.coalesce("children", F.array()), lambda child, i: F.struct(
        F.array(i).alias("path"), child.alias("node")))
    walk = profiles.select(
        "benchmark_name", query_name(F.col("benchmark_name")).alias("query"),
        F.col("scale_factor").cast("int").alias("scale_factor"),
        F.col("thread_count").cast("int").alias("threads"), root.alias("todo"))
    for level in range(depth):
        nodes = F.transform("todo", _node)
        done = nodes if level == 0 else F.concat("done", nodes)
        if level < depth - 1:
            todo = F.flatten(F.transform("todo", _children))
        else:
            rests = F.transform("todo", lambda at: F.struct(
                at["path"].alias("path"), at["node"]["children"].alias("rest")))
            todo = F.filter(rests, lambda at: F.trim(F.coalesce(at["rest"], F.lit("[]"))) != "[]")
        walk = walk.select(*RUN_KEYS, done.alias("done"), todo.alias("todo"))
    return (walk.withColumn("deeper", _below("todo"))
            .select(*RUN_KEYS, F.inline(F.concat("done", "deeper"))))


def by_position(operators: DataFrame) -> DataFrame:
    """Means per place in the tree over the repetitions of one benchmark name.

    ``consistent`` says whether all repetitions agree in operator and table there. A scan
    counts as filtered or projected if it is so in every repetition.
    """
    # Operator and table are keys first: minima of texts would need all operators sorted.
    each = operators.groupBy(*RUN_KEYS, "path", "operator_type", "table").agg(
        F.count("*").alias("runs"), second_sums("timing").alias("timing"),
        *(F.struct(F.sum(F.col(m).cast("double")).alias("sum"), F.count(m).alias("n")).alias(m)
          for m in ("rows_scanned", "cardinality")),
        F.bool_and("has_filter").alias("has_filter"), F.bool_and("has_projection").alias("has_projection"))
    return each.groupBy(*RUN_KEYS, "path").agg(
        F.min("operator_type").alias("operator_type"), F.min("table").alias("table"),
        (F.min("operator_type").eqNullSafe(F.max("operator_type"))
         & F.min("table").eqNullSafe(F.max("table"))).alias("consistent"),
        F.sum("runs").alias("runs"), mean_of_sums("timing").alias("timing"),
        *(F.try_divide(F.sum(f"{m}.sum"), F.sum(f"{m}.n")).alias(m)
          for m in ("rows_scanned", "cardinality")),
        F.bool_and("has_filter").alias("has_filter"), F.bool_and("has_projection").alias("has_projection"))


def require_consistent(positions: DataFrame) -> DataFrame:
    """The same rows, or an error if repetitions disagree somewhere."""
    fine = F.assert_true("consistent", "repetitions differ in an operator")
    return positions.where(fine.isNull())


def operator_name(operator_type: Column, table: Column) -> Column:
    """``TABLE_SCAN (lineorder)`` for a scan, the plain type otherwise."""
    scan = F.concat(operator_type, F.lit(" ("), table, F.lit(")"))
    return F.when(operator_type == "TABLE_SCAN", scan).otherwise(operator_type)


def by_type(positions: DataFrame) -> DataFrame:
    """Sums of the mean metrics per operator type of each benchmark name."""
    return positions.groupBy(*RUN_KEYS, "operator_type").agg(
        *(F.sum(m).alias(m) for m in METRICS))


def largest_per_thread(types: DataFrame, metric: str = "timing") -> DataFrame:
    """The largest operator metric of each benchmark name, divided by its threads."""
    return types.groupBy(*RUN_KEYS).agg(F.max(metric).alias("largest")).withColumn(
        "largest", F.col("largest") / F.col("threads"))


def pivot_series(df: DataFrame, x: str | Sequence[str], series: str, values: Sequence,
                 value: str) -> DataFrame:
    """One row per ``x`` and one column per listed value of ``series``.

    The values are listed, so that no extra pass looks for them; a row of another value is
    an error, as are two rows for one cell. What a series lacks stays null.
    """
    keys = [x] if isinstance(x, str) else list(x)
    cells = df.groupBy(*keys, series).agg(F.max(value).alias(value), F.count("*").alias("_rows"))
    wrong = (F.when(F.col("_rows") > 1, F.raise_error(F.lit("two rows for one cell")))
             .when(~F.coalesce(F.col(series).isin(*values), F.lit(False)), F.raise_error(F.concat(
                 F.lit(f"{series} is not listed: "),
                 F.coalesce(F.col(series).cast("string"), F.lit("null"))))))
    checked = cells.withColumn(value, F.coalesce(wrong.cast(df.schema[value].dataType), value))
    return checked.groupBy(*keys).pivot(series, list(values)).agg(F.max(value))


def timing_series(types: DataFrame, series: str, values: Sequence) -> DataFrame:
    """Time per thread of each operator type, a column per scale factor or thread count.

    An operator that a run does without took no time; a run that does not exist is null.
    """
    per_thread = types.withColumn("value", F.col("timing") / F.col("threads"))
    wide = pivot_series(per_thread, ["query", "operator_type"], series, values, "value")
    there = [F.bool_or(F.col(series) == v).alias(f"_{v}") for v in values]
    known = types.groupBy("query").agg(*there)
    filled = [F.when(F.col(f"_{v}"), F.coalesce(f"`{v}`", F.lit(0.0))).alias(str(v)) for v in values]
    return wide.join(known, "query").select("query", "operator_type", *filled)
