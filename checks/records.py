"""Analytics of benchmark records, over records that Spark derives from the given tables.

Every order stands for one profiled run with a tree of five operators, and for one row of
the run statistics; every line stands for one statement or one source measurement. Names
and numbers come from the row, so the work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import Query, load
from tallystar.plans import profiles, run_stats
from tallystar.sources.profiles import (parse_profiles, read_back_to_back, read_profiles,
                                        split_by_benchmark)
from tallystar.sources.records import (measurements, parse_source_records, read_numbers,
                                       read_source_records, read_stats, write_stats)
from tallystar.sources.schemas import TPCH_RUNS, profile_schema
from tallystar.sources.shared import fresh_path

THREADS = (1, 4, 8)
SCALES = (1, 10, 100)
SCALE = "CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END"
THREAD = "CASE o_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 8 END"
BENCHMARK = (f"concat('SSBQ', 1 + o_custkey % 4, 'v', 1 + o_custkey % 3, 'S', {SCALE}, "
             f"'T', {THREAD})")

# The tree of one run; %s stands for the numbers of the order.
OPERATOR = ('{"operator_type": "%s", "operator_timing": %%s, "operator_rows_scanned": %%s, '
            '"operator_cardinality": %%s, "extra_info": %s, "children": [%s]}')
FACT_SCAN = OPERATOR % ("TABLE_SCAN", '{"Text": "lineorder", "Projections": ["lo_orderdate", '
                        '"lo_discount"], "Filters": ["lo_discount>=1", "lo_quantity<25"]}', "")
DATE_SCAN = OPERATOR % ("TABLE_SCAN", '{"Text": "date", "Projections": "d_datekey"%s}', "")
JOIN = OPERATOR % ("HASH_JOIN", '{"Join Type": "INNER"}', f"{FACT_SCAN}, {DATE_SCAN}")
PROJECTION = OPERATOR % ("PROJECTION", '{"Projections": "price * discount"}', JOIN)
TREE = OPERATOR % ("UNGROUPED_AGGREGATE", '{"Aggregates": "sum(#0)"}', PROJECTION)
RUN = ('{"benchmark_name": "%s", "scale_factor": "%s", "thread_count": "%s", '
       '"operator_timing": %s, "cumulative_rows_scanned": %s, "cumulative_cardinality": %s, '
       '"extra_info": {}, "children": [' + TREE + "]}")
NUMBERS = (BENCHMARK, SCALE, THREAD, "o_totalprice", "q * 100 + 2556", "n + q",  # run
           "n / 1000D", "0", "1",                  # aggregate
           "q / 1000D", "0", "n",                  # projection
           "(n + q) / 1000D", "0", "n",            # join
           "q / 10D", "q * 100", "q",              # scan of the fact table
           "n / 10000D", "2556", "365",            # scan of the date table
           "if(o_custkey % 4 = 0, ', \"Filters\": \"d_year=1994\"', '')")


def filled(template: str, values: Sequence[Column]) -> Column:
    """``format_string`` of a template with ``%s`` only, put together without a formatter for each row."""
    pieces = template.split("%s")
    texts = [F.coalesce(value.cast("string"), F.lit("null")) for value in values]
    return F.concat(F.lit(pieces[0]), *(c for text, piece in zip(texts, pieces[1:], strict=True)
                                        for c in (text, F.lit(piece))))


def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per order as JSON text."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    run = load(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return run.select(filled(RUN, [F.expr(n) for n in NUMBERS]).alias("value"))


def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.runs(parse_profiles(profile_lines(spark, sf_dir)))


def operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.flatten(parse_profiles(profile_lines(spark, sf_dir)))


LINK = ('{"operator_type": "STEP", "operator_timing": %s, "operator_rows_scanned": %s, '
        '"operator_cardinality": %s, "extra_info": {"Text": "%s", "Filters": []}, "children": [')


def deep_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees that are as deep as a part has lines, each line being the only child of the last."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_partkey", F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").alias("line"))
    link = lambda at: F.format_string(LINK, *(at[c].cast("string") for c in (
        "l_quantity", "l_orderkey", "l_linenumber", "l_returnflag")))
    trees = lines.groupBy("l_partkey").agg(F.array_sort(F.collect_list("line")).alias("lines")).select(
        F.concat(F.lit('{"benchmark_name": "SSBQ1v1S1T1", "scale_factor": "'),
                 F.col("l_partkey").cast("string"), F.lit('", "thread_count": "1", "children": ['),
                 F.array_join(F.transform("lines", link), ""),
                 F.repeat(F.lit("]}"), F.size("lines") + 1)).alias("value"))
    found = profiles.flatten(parse_profiles(trees))
    return found.select(F.col("scale_factor").alias("part"), F.size("path").alias("level"),
                        F.array_max("path").alias("last_child"), "table", "timing", "rows_scanned",
                        F.col("cardinality").cast("int").alias("cardinality"), "has_filter")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.require_consistent(profiles.by_position(operators(spark, sf_dir)))


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.by_type(positions(spark, sf_dir))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Logarithms and means to the digits in which all engines agree."""
    return df.select(*(F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns))


def with_text_path(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "."))


def named_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = positions(spark, sf_dir).withColumn(
        "name", profiles.operator_name(F.col("operator_type"), F.col("table")))
    return with_text_path(named).drop("operator_type", "table")


def thread_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time per thread of each operator type at the largest scale, a column per thread count."""
    chosen = profiles.select_runs(types(spark, sf_dir), scale_factors=[100])
    return profiles.timing_series(chosen, "threads", THREADS)


def scale_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time per thread of each operator type with four threads, a column per scale."""
    chosen = profiles.select_runs(types(spark, sf_dir), threads=[4])
    return profiles.timing_series(chosen, "scale_factor", SCALES)


# Compressed files are read by one task each, so they are kept short.
OBJECTS_PER_FILE = 50_000


def write_texts(lines: DataFrame, path: str, lines_per_file: int) -> None:
    """Compressed text files, a row per line, none longer than so many lines."""
    lines.write.option("compression", "lz4").option("maxRecordsPerFile", lines_per_file).text(path)


def back_to_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles written one after the other without commas, read and grouped by run."""
    path = fresh_path(spark, "profiles")
    write_texts(profile_lines(spark, sf_dir), path, OBJECTS_PER_FILE)
    return profiles.by_run_group(profiles.runs(read_back_to_back(spark, path)))


def written_arrays(lines: DataFrame, name: str) -> str:
    """The objects as JSON arrays of a hundred at most, several arrays per file, as they lie."""
    path = fresh_path(lines.sparkSession, name)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0)
            ends = pa.array([*range(0, len(values), 100), len(values)], pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(ends, values), ",\n")
            yield pa.RecordBatch.from_arrays(
                [pc.binary_join_element_wise("[\n", joined, "]", "")], ["value"])

    write_texts(lines.mapInArrow(arrays, "value string"), path, OBJECTS_PER_FILE // 100)
    return path


def profile_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles written as JSON arrays, read and grouped by run."""
    path = written_arrays(profile_lines(spark, sf_dir), "arrays")
    return profiles.by_run_group(profiles.runs(read_profiles(spark, path)))


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs per benchmark after writing a folder for each name."""
    path = fresh_path(spark, "split")
    split_by_benchmark(parse_profiles(profile_lines(spark, sf_dir)), path)
    return (spark.read.schema(profile_schema()).json(path)
            .groupBy("benchmark_name").agg(F.count("*").alias("runs")))


def tpch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run statistics written as CSV and read back."""
    orders = load(spark, sf_dir, "orders")
    derived = orders.select(
        F.col("o_orderkey").cast("string").alias("query_id"),
        F.expr("int(o_orderkey % 3)").alias("query_index"),
        F.expr("concat('TPCH_SF', int(pow(10, o_custkey % 4)))").alias("schema"),
        F.expr("element_at(array('X-Small', 'Small', 'Medium', 'Large'), "
               "int(o_orderkey % 4) + 1)").alias("warehouse_size"),
        F.expr("floor(o_totalprice) / 1000").alias("elapsed_seconds"),
        F.expr("floor(o_totalprice)").alias("elapsed_ms"))
    path = fresh_path(spark, "runs")
    write_stats(derived, path)
    return read_stats(spark, path, TPCH_RUNS)


def configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stats.by_configuration(tpch_runs(spark, sf_dir))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as statements, with the timing of their order."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").alias("repetition"),
        F.concat("l_returnflag", F.lit("_"), "l_linestatus").alias("query_type"))
    timings = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.expr("floor(o_totalprice)").alias("elapsed_ms"))
    return run_stats.attach_timings(lines, timings)


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished runs among those of the large lines, from orders as a history."""
    history = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"), F.lit("S").alias("schema_name"),
        F.col("o_orderpriority").alias("warehouse_size"),
        F.expr("if(o_custkey % 2 = 0, 'BENCH', 'OTHER')").alias("user_name"),
        F.expr("if(o_orderstatus = 'F', 'SUCCESS', 'FAIL')").alias("execution_status"),
        F.expr("floor(o_totalprice)").alias("total_elapsed_time"),
        F.col("o_orderdate").cast("date").alias("start_time"))
    wanted = load(spark, sf_dir, "lineitem").where("l_quantity > 45").select(
        F.col("l_orderkey").alias("query_id"))
    return run_stats.finished_runs(history, "BENCH", wanted)


SOURCE = ('{"name": "%s", "filepath": "file:///data/ssb/%s", "measurements": '
          '[{"Optimization": 1, "Execution": %s, "Measured cost-upper": 1.5}, '
          '{"Optimization": 2, "Execution": %s}]}')


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line as a source benchmark with two measurements."""
    name = ("element_at(array('ssb-parquet', 'ssb-parquet-projection', 'ssb-csv'), "
            "int(l_orderkey % 3) + 1)")
    file = ("concat('ssb_sf', l_linenumber, "
            "if(l_orderkey % 3 = 2, '.csv', '.parquet'))")
    return load(spark, sf_dir, "lineitem").select(F.format_string(
        SOURCE, *(F.expr(e).cast("string") for e in (
            name, file, "bigint(floor(l_extendedprice))", "bigint(l_quantity)"))).alias("value"))


def source_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stats.by_dataset(measurements(parse_source_records(source_lines(spark, sf_dir))))


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files that hold JSON arrays of records."""
    path = written_arrays(source_lines(spark, sf_dir), "records")
    return run_stats.by_dataset(measurements(read_source_records(spark, path)))


def number_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One number per line written as text, read and averaged."""
    path = fresh_path(spark, "numbers")
    load(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("string")).write.text(path)
    return run_stats.mean_of_numbers(read_numbers(spark, path))


QUERIES: dict[str, Query] = {
    "profile_runs": run_rows,
    "profile_by_run": lambda s, d: rounded(profiles.by_run_group(run_rows(s, d)), "avg_elapsed", digits=7),
    "profile_operators": lambda s, d: with_text_path(operators(s, d)),
    "profile_deep_operators": deep_operators,
    "profile_by_position": lambda s, d: rounded(named_positions(s, d), "timing", digits=12),
    "profile_by_type": lambda s, d: rounded(types(s, d), "timing", digits=12),
    "profile_largest": lambda s, d: rounded(
        profiles.largest_per_thread(types(s, d)), "largest", digits=12),
    "profile_thread_series": lambda s, d: rounded(
        thread_series(s, d), *map(str, THREADS), digits=12),
    "profile_scale_series": lambda s, d: rounded(scale_series(s, d), *map(str, SCALES), digits=12),
    "profile_distinct_queries": lambda s, d: profiles.distinct_values(run_rows(s, d), "query"),
    "profile_distinct_threads": lambda s, d: profiles.distinct_values(run_rows(s, d), "threads"),
    "profile_distinct_scales": lambda s, d: profiles.distinct_values(run_rows(s, d), "scale_factor"),
    "io_profiles_array": lambda s, d: rounded(profile_arrays(s, d), "avg_elapsed", digits=7),
    "io_source_records": source_files,
    "io_profiles_back_to_back": lambda s, d: rounded(back_to_back(s, d), "avg_elapsed", digits=7),
    "io_profiles_split": split_files,
    "runs_tpch_configurations": lambda s, d: rounded(
        rounded(configurations(s, d), "log_ms"), "elapsed_seconds", digits=7),
    "runs_tpch_log_series": lambda s, d: rounded(
        run_stats.log_series(configurations(s, d)), *run_stats.WAREHOUSES),
    "runs_tpch_largest_log": lambda s, d: rounded(
        run_stats.largest_log(configurations(s, d)), "largest"),
    "runs_by_repetition": lambda s, d: run_stats.by_repetition(statements(s, d)),
    "runs_by_query_type": lambda s, d: rounded(run_stats.by_query_type(
        run_stats.by_repetition(statements(s, d))), "elapsed_seconds", digits=7),
    "runs_finished": finished,
    "source_by_dataset": source_means,
    "io_numbers_mean": number_mean,
}

PER_ORDER = f"""
WITH per_order AS (
  SELECT o.*, n, q, CAST({SCALE} AS INTEGER) AS scale_factor, CAST({THREAD} AS INTEGER) AS threads,
         {BENCHMARK} AS benchmark_name,
         concat(1 + o_custkey % 4, '.', 1 + o_custkey % 3) AS query
  FROM orders o JOIN (SELECT l_orderkey, count(*) AS n,
                             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q
                      FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey),
operators AS (
  SELECT benchmark_name, query, scale_factor, threads, t.*
  FROM per_order, LATERAL (VALUES
    ('0', 'UNGROUPED_AGGREGATE', NULL, n / 1000, 0::BIGINT, 1::BIGINT, false, false),
    ('0.0', 'PROJECTION', NULL, q / 1000, 0, n, false, true),
    ('0.0.0', 'HASH_JOIN', NULL, (n + q) / 1000, 0, n, false, false),
    ('0.0.0.0', 'TABLE_SCAN', 'lineorder', q / 10, q * 100, q, true, true),
    ('0.0.0.1', 'TABLE_SCAN', 'date', n / 10000, 2556, 365, o_custkey % 4 = 0, true))
    t(path, operator_type, "table", timing, rows_scanned, cardinality, has_filter,
      has_projection)),
positions AS (
  SELECT benchmark_name, query, scale_factor, threads, path, min(operator_type) AS operator_type,
         min("table") AS "table", count(DISTINCT operator_type) = 1 AS consistent,
         count(*) AS runs, avg(timing) AS timing, avg(rows_scanned) AS rows_scanned,
         avg(cardinality) AS cardinality, bool_and(has_filter) AS has_filter,
         bool_and(has_projection) AS has_projection
  FROM operators GROUP BY ALL),
types AS (
  SELECT benchmark_name, query, scale_factor, threads, operator_type, sum(timing) AS timing,
         sum(rows_scanned) AS rows_scanned, sum(cardinality) AS cardinality
  FROM positions GROUP BY ALL),
run_rows AS (
  SELECT benchmark_name, query, scale_factor, threads, o_totalprice AS elapsed,
         q * 100 + 2556 AS cumulative_rows_scanned, n + q AS cumulative_cardinality
  FROM per_order)
"""

BY_RUN = f"""{PER_ORDER}
SELECT benchmark_name, query, scale_factor, threads, count(*) AS runs,
       min(elapsed) AS min_elapsed, max(elapsed) AS max_elapsed,
       round(avg(elapsed), 7) AS avg_elapsed, avg(cumulative_rows_scanned) AS avg_rows_scanned,
       avg(cumulative_cardinality) AS avg_cardinality
FROM run_rows GROUP BY ALL"""


def _series(series: str, values: tuple[int, ...], where: str) -> str:
    """An operator that a run does without took no time; a run that is not there is null."""
    cells = ", ".join(f"max(CASE WHEN {series} = {v} THEN timing / threads END) AS v{v}" for v in values)
    there = ", ".join(f"bool_or({series} = {v}) AS r{v}" for v in values)
    columns = ", ".join(f"round(CASE WHEN r{v} THEN coalesce(v{v}, 0) END, 12) AS \"{v}\"" for v in values)
    return f"""{PER_ORDER},
        chosen AS (SELECT * FROM types WHERE {where}),
        cells AS (SELECT query, operator_type, {cells} FROM chosen GROUP BY query, operator_type),
        there AS (SELECT query, {there} FROM chosen GROUP BY query)
        SELECT query, operator_type, {columns} FROM cells JOIN there USING (query)"""


CONFIGURATIONS = f"""
WITH tpch_runs AS (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 18 END AS query,
         concat('TPCH_SF', CAST(pow(10, o_custkey % 4) AS INTEGER)) AS schema,
         (['X-Small', 'Small', 'Medium', 'Large'])[o_orderkey % 4 + 1] AS warehouse_size,
         CAST(floor(o_totalprice) AS BIGINT) AS elapsed_ms
  FROM orders),
configurations AS (
  SELECT query, schema, warehouse_size, avg(elapsed_ms / 1000) AS elapsed_seconds,
         avg(elapsed_ms) AS elapsed_ms, ln(avg(elapsed_ms)) AS log_ms
  FROM tpch_runs GROUP BY ALL)
"""

STATEMENTS = """
WITH by_repetition AS (
  SELECT l_linenumber AS repetition, l_returnflag || '_' || l_linestatus AS query_type,
         CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS elapsed_ms
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
"""

BY_DATASET = """
        SELECT name, count(*) AS runs, avg(ms) / 1000 AS mean_seconds,
               median(ms) / 1000 AS median_seconds
        FROM (SELECT concat('ssb_sf', l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN '-parquet'
                            WHEN 1 THEN '-parquet-projection' ELSE '-csv' END) AS name,
                     unnest([CAST(floor(l_extendedprice) AS BIGINT),
                             CAST(l_quantity AS BIGINT)]) AS ms
              FROM lineitem) GROUP BY name"""

ORACLES: dict[str, str] = {
    "profile_runs": f"{PER_ORDER} SELECT * FROM run_rows",
    "profile_by_run": BY_RUN,
    "profile_operators": f"{PER_ORDER} SELECT * FROM operators",
    "profile_deep_operators": """
        SELECT CAST(l_partkey AS INTEGER) AS part, CAST(row_number() OVER (
                   PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_returnflag
               ) AS INTEGER) AS level, 0 AS last_child, l_returnflag AS "table",
               CAST(l_quantity AS DOUBLE) AS timing, CAST(l_orderkey AS BIGINT) AS rows_scanned,
               CAST(l_linenumber AS INTEGER) AS cardinality, true AS has_filter
        FROM lineitem""",
    "profile_by_position": f"""{PER_ORDER}
        SELECT benchmark_name, query, scale_factor, threads, path, consistent, runs,
               round(timing, 12) AS timing, rows_scanned, cardinality, has_filter, has_projection,
               operator_type || coalesce(' (' || "table" || ')', '') AS name
        FROM positions""",
    "profile_by_type": f"{PER_ORDER} SELECT * REPLACE (round(timing, 12) AS timing) FROM types",
    "profile_largest": f"""{PER_ORDER}
        SELECT benchmark_name, query, scale_factor, threads,
               round(max(timing / threads), 12) AS largest
        FROM types GROUP BY benchmark_name, query, scale_factor, threads""",
    "profile_thread_series": _series("threads", THREADS, "scale_factor = 100"),
    "profile_scale_series": _series("scale_factor", SCALES, "threads = 4"),
    "profile_distinct_queries": f"{PER_ORDER} SELECT DISTINCT query FROM per_order",
    "profile_distinct_threads": f"{PER_ORDER} SELECT DISTINCT threads FROM per_order",
    "profile_distinct_scales": f"{PER_ORDER} SELECT DISTINCT scale_factor FROM per_order",
    "io_profiles_array": BY_RUN,
    "io_profiles_back_to_back": BY_RUN,
    "io_profiles_split": f"""{PER_ORDER}
        SELECT benchmark_name, count(*) AS runs FROM per_order GROUP BY benchmark_name""",
    "runs_tpch_configurations": f"""{CONFIGURATIONS}
        SELECT query, schema, warehouse_size, round(elapsed_seconds, 7) AS elapsed_seconds, elapsed_ms,
               round(log_ms, 6) AS log_ms
        FROM configurations""",
    "runs_tpch_log_series": f"""{CONFIGURATIONS}
        SELECT query, schema,
               round(max(CASE warehouse_size WHEN 'X-Small' THEN log_ms END), 6) AS "X-Small",
               round(max(CASE warehouse_size WHEN 'Small' THEN log_ms END), 6) AS "Small",
               round(max(CASE warehouse_size WHEN 'Medium' THEN log_ms END), 6) AS "Medium",
               round(max(CASE warehouse_size WHEN 'Large' THEN log_ms END), 6) AS "Large"
        FROM configurations GROUP BY query, schema""",
    "runs_tpch_largest_log":
        f"{CONFIGURATIONS} SELECT round(max(log_ms), 6) AS largest FROM configurations",
    "runs_by_repetition": f"""{STATEMENTS}
        SELECT repetition, query_type, elapsed_ms / 1000 AS elapsed_seconds, elapsed_ms
        FROM by_repetition""",
    "runs_by_query_type": f"""{STATEMENTS}
        SELECT query_type, round(avg(elapsed_ms / 1000), 7) AS elapsed_seconds
        FROM by_repetition GROUP BY query_type""",
    "runs_finished": """
        SELECT o_orderkey AS query_id, 'S' AS schema_name, o_orderpriority AS warehouse_size,
               CAST(floor(o_totalprice) AS BIGINT) / 1000 AS elapsed_seconds,
               CAST(floor(o_totalprice) AS BIGINT) AS elapsed_ms,
               CAST(o_orderdate AS DATE) AS start_time
        FROM orders WHERE o_custkey % 2 = 0 AND o_orderstatus = 'F'
          AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""",
    "source_by_dataset": BY_DATASET,
    "io_source_records": BY_DATASET,
    "io_numbers_mean": "SELECT avg(l_quantity) AS mean FROM lineitem",
}
