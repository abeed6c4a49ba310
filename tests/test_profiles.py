import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import records
from conftest import rows
from tallystar.functions.seconds import mean_seconds
from tallystar.plans import profiles as pf
from tallystar.plans import run_stats
from tallystar.plans.grid import run_grid
from tallystar.sources import profiles as files
from tallystar.sources.records import measurements, parse_source_records, read_source_records
from tallystar.sources.schemas import SENTIMENT_RUNS, TPCH_RUNS


def node(kind, timing, scanned, rows_out, info=None, children=()):
    return {"operator_type": kind, "operator_timing": timing, "operator_rows_scanned": scanned,
            "operator_cardinality": rows_out, "cpu_time": timing, "extra_info": info or {},
            "children": list(children)}


def run(name, threads, elapsed, factor=1.0, with_filter=False):
    days = node("TABLE_SCAN", 0.001 * factor, 2556, 365,
                {"Text": "date", "Projections": "d_datekey", "Filters": "d_year=1994"})
    if with_filter:
        days = node("FILTER", 0.002, 0, 300, {"Expression": "x"}, [days])
    fact = node("TABLE_SCAN", 2.0 * factor, 6000, 1200,
                {"Text": "lineorder", "Projections": ["lo_orderdate", "lo_discount"],
                 "Filters": ["lo_discount>=1 AND lo_discount<=3", "lo_quantity<25"]})
    join = node("HASH_JOIN", 0.25 * factor, 0, 110, {"Join Type": "INNER"}, [fact, days])
    tree = node("UNGROUPED_AGGREGATE", 0.5 * factor, 0, 1, {"Aggregates": "sum(#0)"},
                [node("PROJECTION", 0.125 * factor, 0, 110, {"Projections": "a * b"}, [join])])
    return {"benchmark_name": name, "scale_factor": name.split("S")[-1].split("T")[0],
            "thread_count": str(threads), "operator_timing": elapsed, "cpu_time": elapsed * 2,
            "blocked_thread_time": 0.0, "cumulative_rows_scanned": 8556,
            "cumulative_cardinality": 1786, "result_set_size": 16, "query_name": "SELECT 1",
            "planner": 0.0001, "extra_info": {}, "children": [tree]}


RUNS = [run("SSBQ1v1S100T1", 1, 3.0), run("SSBQ1v1S100T1", 1, 3.5, 2.0),
        run("SSBQ1v1S100T4", 4, 1.0, 4.0), run("SSBQ2v2S10T4", 4, 0.5, with_filter=True)]


@pytest.fixture(scope="module")
def array_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("profiles") / "log.json"
    path.write_text(json.dumps(RUNS))
    return str(path)


@pytest.fixture(scope="module")
def profiles(spark, array_file):
    return files.read_profiles(spark, array_file)


@pytest.fixture(scope="module")
def positions(profiles):
    return pf.by_position(pf.flatten(profiles))


def test_runs(profiles):
    got = rows(pf.runs(profiles), "benchmark_name", "query", "scale_factor", "threads", "elapsed")
    assert got[0] == ("SSBQ1v1S100T1", "1.1", 100, 1, 3.0) and len(got) == 4
    group = pf.by_run_group(pf.runs(profiles)).first()
    assert (group.runs, group.min_elapsed, group.max_elapsed, group.avg_elapsed) == (2, 3.0, 3.5, 3.25)
    assert (group.avg_rows_scanned, group.avg_cardinality) == (8556.0, 1786.0)


def test_selection_and_distinct_values(profiles):
    run_rows = pf.runs(profiles)
    assert pf.select_runs(run_rows, threads=[4]).count() == 2
    assert pf.select_runs(run_rows, ["1.1"], [4], [100]).count() == 1
    assert [r.query for r in pf.distinct_values(run_rows, "query").collect()] == ["1.1", "2.2"]
    assert [r.threads for r in pf.distinct_values(run_rows, "threads").collect()] == [1, 4]


def test_flatten(profiles):
    got = pf.flatten(profiles)
    assert got.count() == 5 * 3 + 6
    first = {tuple(r.path): r for r in got.where("benchmark_name = 'SSBQ1v1S100T4'").collect()}
    assert {p: r.operator_type for p, r in first.items()} == {
        (0,): "UNGROUPED_AGGREGATE", (0, 0): "PROJECTION", (0, 0, 0): "HASH_JOIN",
        (0, 0, 0, 0): "TABLE_SCAN", (0, 0, 0, 1): "TABLE_SCAN"}
    scan = first[0, 0, 0, 0]
    assert (scan.table, scan.timing, scan.rows_scanned, scan.cardinality) == ("lineorder", 8.0, 6000, 1200)
    assert scan.has_filter and scan.has_projection
    assert not first[0, 0, 0].has_filter and first[0, 0, 0].table is None


def test_members_that_are_text_or_array(profiles):
    scans = profiles.select(F.explode("children").alias("a")).select(
        F.col("a.children")[0]["children"][0]["children"].alias("s"))
    got = scans.select(pf.listed(F.col("s")[0]["extra_info"], "Projections").alias("many"),
                       pf.listed(F.col("s")[0]["extra_info"], "Missing").alias("none"),
                       pf.listed(F.lit(None).cast("map<string,string>"), "x").alias("null")).first()
    assert got.many == ["lo_orderdate", "lo_discount"] and got.none is None and got.null is None


def test_by_position_averages_repetitions(positions):
    both = {tuple(r.path): r for r in positions.where("benchmark_name = 'SSBQ1v1S100T1'").collect()}
    assert both[0,].timing == 0.75 and both[0,].runs == 2 and both[0,].consistent
    assert both[0, 0, 0, 1].table == "date" and both[0, 0, 0, 0].timing == 3.0
    assert pf.require_consistent(positions).count() == positions.count()
    name = pf.operator_name(F.col("operator_type"), F.col("table"))
    assert "TABLE_SCAN (lineorder)" in {r[0] for r in positions.select(name).collect()}


def test_disagreeing_repetitions_are_an_error(spark):
    mixed = [run("SSBQ1v1S1T4", 4, 1.0), run("SSBQ1v1S1T4", 4, 1.0, with_filter=True)]
    lines = spark.createDataFrame([(json.dumps(r),) for r in mixed], "value string")
    places = pf.by_position(pf.flatten(files.parse_profiles(lines)))
    assert places.where("not consistent").count() == 1
    with pytest.raises(Exception, match="repetitions differ"):
        pf.require_consistent(places).collect()


def test_by_type_and_largest(positions):
    types = pf.by_type(positions)
    scan = types.where("benchmark_name = 'SSBQ1v1S100T4' and operator_type = 'TABLE_SCAN'").first()
    assert scan.timing == pytest.approx(8.004) and scan.rows_scanned == 8556
    largest = {r.benchmark_name: r.largest for r in pf.largest_per_thread(types).collect()}
    assert largest["SSBQ1v1S100T4"] == pytest.approx(8.004 / 4)


def test_series_fill_a_missing_operator(positions):
    wide = pf.timing_series(pf.by_type(positions), "scale_factor", [10, 100])
    got = {(r["query"], r.operator_type): (r["10"], r["100"]) for r in
           wide.where("operator_type = 'FILTER'").collect()}
    assert got == {("2.2", "FILTER"): (0.002 / 4, None)}      # 2.2 has no run at scale 100


def test_series_fill_an_operator_that_a_run_does_without(spark):
    both = [run("SSBQ2v2S10T4", 4, 0.5, with_filter=True), run("SSBQ2v2S100T4", 4, 0.5)]
    lines = spark.createDataFrame([(json.dumps(r),) for r in both], "value string")
    wide = pf.timing_series(pf.by_type(pf.by_position(pf.flatten(files.parse_profiles(lines)))),
                            "scale_factor", [10, 100])
    assert rows(wide.where("operator_type = 'FILTER'"), "10", "100") == [(0.002 / 4, 0.0)]


def test_trees_of_any_depth(spark):
    tree, want = node("LEAF", 0.1, 1, 1), 1
    for i in range(400):
        tree = node("INNER", 0.25, i, 1, children=[node("SIDE", 0.5, 7, 2), tree])
        want += 2
    deep = dict(run("SSBQ1v1S1T1", 1, 1.0), children=[tree])
    lines = spark.createDataFrame([(json.dumps(deep),), (json.dumps(run("SSBQ1v2S1T1", 1, 1.0)),)],
                                  "value string")
    flat = pf.flatten(files.parse_profiles(lines))
    got = {tuple(r.path): r for r in flat.where("query = '1.1'").collect()}
    assert len(got) == want and got[(0,) + (1,) * 400].operator_type == "LEAF"
    for level in (1, 15, 16, 17, 250):
        inner, side = got[(0,) + (1,) * level], got[(0,) + (1,) * level + (0,)]
        assert (inner.operator_type, inner.timing, inner.rows_scanned) == ("INNER", 0.25, 399 - level)
        assert (side.operator_type, side.timing, side.cardinality) == ("SIDE", 0.5, 2)
    for depth in (1, 3):
        shallow = pf.flatten(files.parse_profiles(lines, depth=depth), depth=depth)
        assert rows(shallow) == rows(flat)


@pytest.mark.parametrize("indent", [None, 2])
def test_back_to_back_objects(spark, profiles, tmp_path, indent):
    (tmp_path / "log.json").write_text("\n".join(json.dumps(r, indent=indent) for r in RUNS) + "\n")
    got = files.read_back_to_back(spark, str(tmp_path))
    assert rows(pf.runs(got)) == rows(pf.runs(profiles))
    assert rows(pf.flatten(got)) == rows(pf.flatten(profiles))


@pytest.mark.parametrize("gap", [" ", "", "\r\n", "\n\n", "\t"])
def test_back_to_back_with_any_gap(spark, profiles, tmp_path, gap):
    (tmp_path / "log.json").write_text(gap.join(json.dumps(r) for r in RUNS))
    got = files.read_back_to_back(spark, str(tmp_path))
    assert rows(pf.runs(got)) == rows(pf.runs(profiles))


def test_braces_and_quotes_in_texts_do_not_cut(spark, tmp_path):
    odd = [dict(RUNS[0], benchmark_name=name) for name in ("a } {", 'q " } \\ {"', "{{{", "}")]
    (tmp_path / "log.json").write_text("\n".join(json.dumps(r, indent=1) for r in odd))
    got = files.read_back_to_back(spark, str(tmp_path))
    assert sorted(r.benchmark_name for r in got.collect()) == sorted(r["benchmark_name"] for r in odd)


def test_a_file_of_many_blocks(spark, tmp_path):
    names = [f"run {i} }} {{" for i in range(3000)]
    (tmp_path / "log.json").write_text(" ".join(json.dumps({"benchmark_name": n}) for n in names))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        read = files.read_back_to_back(spark, str(tmp_path))
        assert read.select("benchmark_name").distinct().count() == 3000 and read.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ['{"benchmark_name": "a"} x', 'x {"benchmark_name": "a"}',
                                  '{"benchmark_name": "a"} x {"benchmark_name": "b"}',
                                  '{"benchmark_name": "a"'])
def test_leftover_text_is_an_error(spark, tmp_path, text):
    (tmp_path / "log.json").write_text(text)
    with pytest.raises(Exception, match="text|MALFORMED"):
        files.read_back_to_back(spark, str(tmp_path)).collect()


def test_every_root_is_kept(spark):
    two = dict(RUNS[0], children=[node("A", 1.0, 1, 1), node("B", 2.0, 1, 1)])
    lines = spark.createDataFrame([(json.dumps(two),)], "value string")
    got = pf.flatten(files.parse_profiles(lines))
    assert rows(got, "path", "operator_type") == [([0], "A"), ([1], "B")]


def test_means_of_large_sums(spark):
    many = spark.range(100_000).select(F.lit(150_000.0).alias("seconds"))
    assert many.agg(mean_seconds("seconds")).first()[0] == 150_000.0


def test_series_cells_must_be_unique_and_listed(spark):
    cells = spark.createDataFrame([("a", 1, 2.0), ("a", 4, 3.0), ("b", 4, 5.0)],
                                  "x string, threads int, v double")
    got = pf.pivot_series(cells, "x", "threads", [1, 4], "v")
    assert rows(got) == [("a", 2.0, 3.0), ("b", None, 5.0)]
    with pytest.raises(Exception, match="not listed"):
        pf.pivot_series(cells, "x", "threads", [4], "v").collect()
    with pytest.raises(Exception, match="two rows"):
        pf.pivot_series(cells.unionAll(cells), "x", "threads", [1, 4], "v").collect()


def test_split_by_benchmark(spark, profiles, tmp_path):
    target = str(tmp_path / "split")
    files.split_by_benchmark(profiles, target, ["SSBQ1v1S100T1", "SSBQ2v2S10T4"])
    assert sorted(p.name for p in (tmp_path / "split").iterdir() if p.is_dir()) == [
        "benchmark_name=SSBQ1v1S100T1", "benchmark_name=SSBQ2v2S10T4"]
    one = files.read_profiles(spark, f"{target}/benchmark_name=SSBQ1v1S100T1", lines=True)
    kept = profiles.where("benchmark_name = 'SSBQ1v1S100T1'")
    assert rows(pf.flatten(one).drop("benchmark_name", "query")) == rows(
        pf.flatten(kept).drop("benchmark_name", "query"))


SOURCE = [{"name": "orders-parquet-projection", "filepath": "file:///d/orders_small.parquet",
           "measurements": [{"Optimization": 1, "Execution": ms, "Post-processing": 3,
                             "par-ex-000": 4, "Estimate 1 (lower)": 9,
                             "Measured cost-upper": 1.5} for ms in (2000, 5000, 2600)]},
          {"name": "letters-csv", "filepath": "file:///d/letters.csv",
           "measurements": [{"Execution": 1000}]}]


def test_source_records(spark, tmp_path):
    (tmp_path / "results.json").write_text(json.dumps(SOURCE))
    got = measurements(read_source_records(spark, str(tmp_path)))
    first = got.where("workload = 'orders'").first()
    assert (first.name, first.projection, first.file_type) == (
        "orders_small-parquet-projection", True, "parquet")
    assert (first.Post_processing, first.par_ex_000, first.Estimate_1_lower, first.Measured_cost_upper) == (3, 4, 9, 1.5)
    means = [tuple(r) for r in run_stats.by_dataset(got).collect()]
    assert means == [("letters-csv", 1, 1.0, 1.0),
                     ("orders_small-parquet-projection", 3, pytest.approx(3.2), 2.6)]
    lines = spark.createDataFrame([(json.dumps(r),) for r in SOURCE], "value string")
    assert rows(measurements(parse_source_records(lines))) == rows(got)


def test_tpch_statistics(spark):
    stats = spark.createDataFrame(
        [("a", 0, "TPCH_SF1", "Small", 1.0, 1000), ("b", 0, "TPCH_SF1", "Small", 3.0, 3000),
         ("c", 2, "TPCH_SF1", "Large", 0.5, 500)], TPCH_RUNS)
    other = spark.createDataFrame([("d", 7, "TPCH_SF1", "Large", 9.0, 9000)], TPCH_RUNS)
    with pytest.raises(Exception, match="no query at position 7"):
        run_stats.by_configuration(stats.unionAll(other)).collect()
    means = run_stats.by_configuration(stats)
    assert rows(means, "query", "warehouse_size", "elapsed_seconds", "elapsed_ms") == [
        (1, "Small", 2.0, 2000.0), (18, "Large", 0.5, 500.0)]
    wide = {r["query"]: r for r in run_stats.log_series(means).collect()}
    assert wide[1]["Small"] == pytest.approx(7.600902) and wide[1]["Large"] is None
    assert run_stats.largest_log(means).first().largest == pytest.approx(7.600902)


def test_sentiment_statistics(spark):
    statements = spark.createDataFrame(
        [(0, "SQL_TRAIN", "a"), (0, "SQL_TRAIN", "b"), (1, "SQL_TRAIN", "c"), (0, "SQL_PREDICT", "d")],
        "repetition int, query_type string, query_id string")
    timings = spark.createDataFrame([("a", 100), ("b", 200), ("c", 500), ("d", 50), ("x", 1)],
                                    "query_id string, elapsed_ms bigint")
    stats = run_stats.by_repetition(run_stats.attach_timings(statements, timings))
    assert rows(stats) == [(0, "SQL_PREDICT", 0.05, 50), (0, "SQL_TRAIN", 0.3, 300),
                           (1, "SQL_TRAIN", 0.5, 500)]
    assert stats.columns == SENTIMENT_RUNS.replace(",", "").split(" ")[::2]
    assert rows(run_stats.by_query_type(stats)) == [("SQL_PREDICT", 0.05), ("SQL_TRAIN", 0.4)]


def test_grid_records_every_run(spark):
    def fails(session):
        return session.range(1).select(F.raise_error(F.lit("no")))

    history = run_grid(spark, {"count": lambda s: s.range(100), "bad": fails},
                       {"few": {"spark.sql.shuffle.partitions": "2"}, "same": {}}, repetitions=2)
    assert history.count() == 8 and spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert rows(history.groupBy("workload", "execution_status").count()) == [
        ("bad", "FAIL", 4), ("count", "SUCCESS", 4)]
    ids = [r.query_id for r in history.where("workload = 'count'").collect()]
    table = history.select("query_id")
    renamed = history.withColumnsRenamed({"workload": "schema_name", "configuration": "warehouse_size"})
    got = run_stats.finished_runs(renamed, "bench", ids)
    assert got.count() == 4 and run_stats.finished_runs(renamed, "bench", table).count() == 4
    starts = [r.start_time for r in got.collect()]
    assert starts == sorted(starts, reverse=True)
    assert run_stats.finished_runs(renamed, "someone", ids).count() == 0


def test_objects_are_cut_where_they_lie(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps(RUNS))
    plan = files.read_back_to_back(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # Only block sums and the ends of blocks are shuffled, each by file.
    assert all("hashpartitioning(file" in line for line in plan.split("\n") if " Exchange " in line)


def test_positions_are_averaged_without_sorting_operators(spark, array_file):
    flat = pf.flatten(files.read_profiles(spark, array_file))
    plan = pf.by_position(flat)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.split("\n") if "Aggregate(keys=[benchmark_name" in line][-1]
    assert "HashAggregate" in first and "partial_" in first


def bytes_read(spark):
    """Bytes that this process has read from files through Hadoop."""
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return statistics.getLong("bytesRead")


@pytest.mark.parametrize("read", [files.read_profiles, files.read_back_to_back])
def test_compressed_files_are_read_once(spark, tmp_path, read):
    random = np.random.default_rng(1)
    made = [dict(RUNS[0], benchmark_name=f"run }} {i} [", query_name=random.bytes(400).hex())
            for i in range(4000)]
    for i in range(4):
        some = made[i::4]
        text = json.dumps(some) if read is files.read_profiles else " \n".join(map(json.dumps, some))
        (tmp_path / f"log{i}.json.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "plain.json").write_text(json.dumps(dict(RUNS[0], benchmark_name="plain")))
    size = sum(file.stat().st_size for file in tmp_path.iterdir())
    before = bytes_read(spark)
    got = read(spark, str(tmp_path)).select("benchmark_name", "query_name").collect()
    assert size <= bytes_read(spark) - before < 1.5 * size
    assert sorted(got) == sorted([(r["benchmark_name"], r["query_name"]) for r in made]
                                 + [("plain", RUNS[0].get("query_name"))])


@pytest.mark.parametrize("text", ['[{"benchmark_name": "a"}] x', 'x {"benchmark_name": "a"}',
                                  '{"benchmark_name": "a"} x {"benchmark_name": "b"}',
                                  '{"benchmark_name": "a"'])
def test_leftover_text_in_a_compressed_file_is_an_error(spark, tmp_path, text):
    (tmp_path / "good.json.gz").write_bytes(gzip.compress(b'[{"benchmark_name": "b"}]\n'))
    (tmp_path / "log.json.gz").write_bytes(gzip.compress(text.encode()))
    with pytest.raises(Exception, match="text before|text after"):
        files.read_back_to_back(spark, str(tmp_path)).collect()


def test_profile_texts_are_what_a_formatter_makes(spark):
    values = spark.createDataFrame([(1, 0.1, 'a"b%s'), (None, 1e-7, None), (-5, 123456789.0, "")],
                                   "a bigint, b double, c string")
    template = '{"a": %s, "b": [%s, 1], "c": "%s"}'
    made = values.select(records.filled(template, [F.col(c) for c in "abc"]).alias("made"),
                         F.format_string(template, *(F.col(c).cast("string") for c in "abc")).alias("want"))
    assert all(r.made == r.want for r in made.collect())


def test_written_arrays_hold_a_hundred_objects_each(spark):
    lines = spark.range(0, 250, 1, 1).selectExpr("""concat('{"n": ', id, '}') AS value""")
    path = records.written_arrays(lines, "arrays")
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    got, at = [], 0
    while at < len(text):
        array, at = json.JSONDecoder().raw_decode(text, at)
        got.append([o["n"] for o in array])
        at += 1
    assert got == [list(range(100)), list(range(100, 200)), list(range(200, 250))]
