import pytest

from conftest import rows
from tallystar.plans import bayes_fit
from tallystar.sources import tables
from tallystar.sources.records import read_numbers, read_stats, write_stats
from tallystar.sources.schemas import SENTIMENT_RUNS, TEST_DOCS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("p") / "people")
    df = spark.createDataFrame(
        [(1, 'say "hi"', 1.5), (2, "two\nlines", None), (3, " outer ", 0.0), (4, None, 2.0),
         (5, "a,b;c", -1.0), (6, "back\\slash", 3.0), (7, "", 4.0)], "id int, t string, x double")
    tables.replace_table(df, path)
    return path


def test_read_prunes_and_pushes(spark, people):
    df = tables.read_parquet(spark, people, {"id": "bigint"}, "x > 1")
    plan = plan_of(df)
    assert "ReadSchema: struct<id:int,x:double>" in plan and "GreaterThan(x,1.0)" in plan
    assert rows(df) == [(1,), (4,), (6,), (7,)]
    assert dict(df.dtypes) == {"id": "bigint"}


def test_csv_round_trip(spark, people, tmp_path):
    target = str(tmp_path / "csv")
    tables.convert_to_csv(spark, people, target)
    df = spark.read.parquet(people)
    assert rows(tables.read_csv(spark, target, df.schema, newlines_in_cells=True)) == rows(df)


def test_csv_files_are_cut_by_bytes(spark, tmp_path):
    target = tmp_path / "csv"
    texts = [(i, (' "q",\n' + "word " * (i * 37 % 400)) * (50 if i == 77 else 1), i / 3, None) for i in range(200)]
    df = spark.createDataFrame(texts, "id long, text string, x double, none string").coalesce(2)
    tables.write_csv(df, str(target), bytes_per_file=6000)
    sizes = sorted(f.stat().st_size for f in target.rglob("*.csv"))
    assert sizes[-2] <= 6000 < sizes[-1] and len(sizes) > 20      # one text alone is larger
    assert sum(sizes[:-1]) / len(sizes[:-1]) > 3000
    assert rows(tables.read_csv(spark, str(target), df.schema, newlines_in_cells=True)) == rows(df)
    tables.write_csv(df.limit(0), str(target), bytes_per_file=6000)
    assert rows(tables.read_csv(spark, str(target), df.schema, newlines_in_cells=True)) == []


def test_csv_of_some_columns_reads_only_these(spark, people, tmp_path):
    target = str(tmp_path / "csv")
    tables.convert_to_csv(spark, people, target, ["id", "x"])
    assert rows(tables.read_csv(spark, target, "id int, x double")) == rows(
        spark.read.parquet(people), "id", "x")


def test_malformed_csv_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("label,text\nnot-a-number,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(tmp_path), TEST_DOCS).collect()


def test_tables_by_name_and_path(spark, people):
    spark.read.parquet(people).createOrReplaceTempView("people_view")
    assert tables.table(spark, "people_view").count() == tables.table(spark, people).count() == 7


def test_replace_table_replaces(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.replace_table(spark.range(5), target)
    tables.replace_table(spark.range(3), target)
    assert tables.table(spark, target).count() == 3
    tables.replace_table(spark.range(4), "replaced")
    tables.replace_table(spark.range(2), "replaced")
    assert tables.table(spark, "replaced").count() == 2


def test_model_files_keep_words_as_words(spark, tmp_path):
    docs = spark.createDataFrame([(0, "null NaN 007 1e5 true"), (4, "plain")], "label int, text string")
    model = bayes_fit.fit_rows(docs)
    target = str(tmp_path / "model")
    tables.export_model(model, target)
    tables.export_model(model, target)  # replaces
    back = tables.import_model(spark, target)
    assert rows(back) == rows(model) and back.count() == 12
    assert {r.word for r in back.collect()} == {"null", "nan", "007", "1e5", "true", "plain"}
    text = spark.read.text(target).first()[0]
    assert text.count(";") == 3 and '"' not in text


def test_stats_round_trip(spark, tmp_path):
    stats = spark.createDataFrame([(0, "SQL_TRAIN", 1.5, 1500), (1, "UDTF_TRAIN", 0.25, 250)],
                                  SENTIMENT_RUNS)
    target = str(tmp_path / "stats")
    write_stats(stats, target)
    assert rows(read_stats(spark, target, SENTIMENT_RUNS)) == rows(stats)
    assert sorted(r[0] for r in spark.read.text(target).collect()) == [
        "0;SQL_TRAIN;1.5;1500", "1;UDTF_TRAIN;0.25;250"]


def test_numbers(spark, tmp_path):
    (tmp_path / "timings.txt").write_text("0.5\n1.5\n 4.0\n")
    assert rows(read_numbers(spark, str(tmp_path))) == [(0.5,), (1.5,), (4.0,)]
