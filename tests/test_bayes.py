import math
import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tallystar.operators.labels import FEW_LABELS, in_label_set, inline_labels, with_label_in
from tallystar.operators.topk import best_label, number_by_rank
from tallystar.functions import arrow_text
from tallystar.functions.text import clean
from tallystar.plans import bayes_batch, bayes_fit, bayes_rank, bayes_sql
from tallystar.sources.tables import replace_table


@pytest.fixture(scope="module")
def model(spark, toy_train, toy_labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "model")
    replace_table(bayes_fit.fit(toy_train, toy_labels), path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def row_model(spark, toy_train, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "rows")
    replace_table(bayes_fit.fit_rows(toy_train, (0, 4)), path)
    return spark.read.parquet(path)


def test_golden_model(model):
    assert model.columns == list(bayes_fit.MODEL_COLUMNS)
    assert model.count() == 40
    totals = rows(model.select("label", "total_count_words_in_label", "total_words",
                               "label_prop").distinct())
    assert totals == [(0, 14, 20, 0.6), (4, 9, 20, 0.4)]
    words = {(r.label, r.value): r.word_prop for r in model.collect()}
    assert [words[0, w] for w in ("predictable", "no", "fun")] == [2 / 34, 2 / 34, 1 / 34]
    assert [words[4, w] for w in ("predictable", "no", "fun")] == [1 / 29, 1 / 29, 2 / 29]


def test_probabilities_sum_to_one(model):
    for r in model.groupBy("label").agg(F.sum("word_prop").alias("s")).collect():
        assert r.s == pytest.approx(1.0)
    priors = model.select("label", "label_prop").distinct().agg(F.sum("label_prop")).first()[0]
    assert priors == pytest.approx(1.0)


def test_golden_ranking(toy_test, model):
    ranks = {r.label: (r.rank, r.id) for r in bayes_rank.ranking(toy_test, model).collect()}
    assert ranks[0] == (pytest.approx(-9.703613, abs=1e-6), 1)
    assert ranks[4] == (pytest.approx(-10.325031, abs=1e-6), 2)
    got = bayes_rank.predict(toy_test, model).first()
    assert (got.status, got.predicted, got.target) == ("Correct", 0, 0)


def test_variant_counts_absent_words_once(toy_train, toy_labels, toy_test):
    variant = bayes_fit.fit(toy_train, toy_labels, absent_count=1)
    totals = rows(variant.select("label", "total_count_words_in_label").distinct())
    assert totals == [(0, 21), (4, 21)]
    assert rows(bayes_fit.label_totals(toy_train, toy_labels, 1)) == totals
    ranks = {r.label: r.rank for r in bayes_rank.scores(toy_test, variant).collect()}
    assert ranks == {0: pytest.approx(-9.572100, abs=1e-6), 4: pytest.approx(-9.977565, abs=1e-6)}


def test_stages(toy_train, toy_labels):
    assert bayes_fit.vocabulary_size(toy_train).first().total_words == 20
    assert bayes_fit.vocabulary(toy_train).count() == 20
    assert bayes_fit.cross_label_words(toy_train, toy_labels).count() == 40
    assert rows(bayes_fit.label_priors(toy_train)) == [(0, 3, 0.6), (4, 2, 0.4)]
    assert rows(bayes_fit.label_totals(toy_train, toy_labels)) == [(0, 14), (4, 9)]
    words = {(r.label, r.value): r.word_count
             for r in bayes_fit.label_words(toy_train, toy_labels).collect()}
    assert len(words) == 40 and words[0, "and"] == 2 and words[4, "and"] == 0


def test_both_ways_to_count_words(toy_train, toy_labels):
    def counts(df):
        return sorted((r.value, sorted((k, v) for k, v in r.counts.items() if v))
                      for r in df.collect())
    assert (counts(bayes_fit.count_by_word(toy_train))
            == counts(bayes_fit.count_by_word(toy_train, [0, 4])))


def test_a_long_label_table_gives_the_same_model(spark, toy_train, model):
    many = inline_labels(spark, [0, 4, *range(1000, 1000 + FEW_LABELS + 5)])
    assert rows(bayes_fit.fit(toy_train, many)) == rows(model)


def test_other_labels_and_repeated_labels(spark, toy_train, model):
    extra = toy_train.unionAll(spark.createDataFrame(
        [(2, "very strange words", 6), (None, "no label", 7)], toy_train.schema))
    repeated = inline_labels(spark, [0, 4, 4, 0])
    assert rows(bayes_fit.fit(extra, repeated)) == rows(model)
    assert in_label_set(extra, repeated).count() == with_label_in(extra, [0, 4]).count() == 5


def test_a_label_without_documents_is_not_in_the_model(spark, toy_train, model):
    labels = inline_labels(spark, [0, 4, 9])
    assert rows(bayes_fit.fit(toy_train, labels)) == rows(model)
    grid = bayes_fit.label_words(toy_train, labels)
    assert grid.where("label = 9 and word_count = 0").count() == 20


def test_row_order_and_partitions_do_not_matter(toy_train, toy_labels, toy_test, model):
    other = bayes_fit.fit(toy_train.repartition(7).orderBy(F.desc("text")), toy_labels)
    assert rows(other) == rows(model)
    assert (rows(bayes_rank.scores(toy_test.repartition(3), other))
            == rows(bayes_rank.scores(toy_test, model)))


def test_null_and_wordless_texts_count_as_documents(spark, toy_train, toy_labels):
    more = toy_train.unionAll(spark.createDataFrame(
        [(0, None, 6), (4, "!!! ...", 7)], toy_train.schema))
    got = bayes_fit.fit(more, toy_labels)
    assert got.count() == 40
    assert rows(got.select("label", "label_prop").distinct()) == [(0, 4 / 7), (4, 3 / 7)]


def test_duplicate_doc_ids_are_one_document(spark, toy_labels):
    docs = spark.createDataFrame([(0, "a b", 1), (0, "c", 1), (4, "d", 2)],
                                 "label int, text string, doc_id bigint")
    assert rows(bayes_fit.label_priors(docs)) == [(0, 1, 0.5), (4, 1, 0.5)]
    by_rows = rows(bayes_fit.fit_rows(docs).select("label", "label_probability").distinct())
    assert by_rows == [(0, 2 / 3), (4, 1 / 3)]


def test_unknown_documents(spark, model):
    docs = spark.createDataFrame(
        [(4, "zzz qqq", 1), (4, None, 2), (4, "the summer", 3)],
        "label int, text string, doc_id bigint")
    assert rows(bayes_rank.predict(docs, model), "doc_id", "predicted") == [(3, 4)]
    assert rows(bayes_rank.predict(docs, model, "prior"), "doc_id", "predicted") == [
        (1, 0), (2, 0), (3, 4)]
    with pytest.raises(ValueError):
        bayes_rank.predict(docs, model, "guess")


def test_ties_go_to_the_lowest_label(spark):
    scores = spark.createDataFrame([(1, 7, -1.0), (1, 3, -1.0), (1, 5, -2.0)],
                                   "doc_id bigint, label int, rank double")
    assert rows(best_label(scores)) == [(1, 3, -1.0)]
    assert rows(number_by_rank(scores).where("id = 1"), "label") == [(3,)]


def test_top1_equals_rank_filter(toy_train, model):
    scores = bayes_rank.scores(toy_train, model)
    assert rows(best_label(scores), "doc_id", "label", "rank") == rows(
        number_by_rank(scores).where("id = 1"), "doc_id", "label", "rank")


@pytest.mark.parametrize("salts", [1, 5])
def test_salting_does_not_change_scores(toy_train, model, salts, monkeypatch):
    expected = rows(bayes_rank.scores(toy_train, model))
    monkeypatch.setattr(bayes_rank, "HOT_WORDS", 40)  # words of 2.5 % or more are hot
    assert rows(bayes_rank.scores(toy_train, model, salts)) == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_known_words_travel_once(spark):
    """Occurrences go to the place of their word, without a shuffle that counts per document."""
    docs = spark.createDataFrame([(1, "a b a"), (1, "a"), (None, "a c"), (2, None)], "doc_id long, text string")
    vocabulary = spark.createDataFrame([("a",), ("b",), ("b",)], "value string")
    found = bayes_rank.known_words(docs, vocabulary)
    assert rows(found) == [(1, "a")] * 3 + [(1, "b"), (None, "a")]
    assert "hashpartitioning(doc_id" not in _plan(found)


def test_known_words_keep_every_occurrence(spark):
    docs = spark.createDataFrame([(1, "a b a z"), (2, "z")], "doc_id bigint, text string")
    vocabulary = spark.createDataFrame([("a",), ("b",)], "value string")
    assert rows(bayes_rank.known_words(docs, vocabulary)) == [(1, "a"), (1, "a"), (1, "b")]


def test_accuracy(spark):
    results = spark.createDataFrame([(0, 0), (0, 4), (4, 4), (None, 4)],
                                    "predicted int, target int")
    assert bayes_rank.accuracy(results).first().success == pytest.approx(2 / 3)


def test_both_training_forms_agree(model, row_model):
    assert rows(model, "label", "value", "label_prop", "word_prop") == rows(
        row_model, "label", "word", "label_probability", "word_probability")


CORPUS = [(0, "very boring film"), (4, "the fun summer film of the summer"), (4, None),
          (0, "nothing known here"), (0, "very boring film"), (4, "Laughs!\nno energy")]


@pytest.mark.parametrize("unknown", ["prior", "drop"])
def test_three_ways_to_predict_agree(spark, model, row_model, unknown):
    docs = spark.createDataFrame([(label, t, i) for i, (label, t) in enumerate(CORPUS)],
                                 "label int, text string, doc_id bigint")
    in_tasks = bayes_batch.predict_rows(docs, row_model, unknown, in_tasks=True)
    joined = bayes_batch.predict_rows(docs, row_model, unknown, in_tasks=False)
    by_id = bayes_rank.predict(docs, model, unknown)
    expected = rows(by_id, "target", "predicted", "text")
    assert rows(in_tasks, "expected_label", "predicted_label", "text") == expected
    assert rows(joined, "expected_label", "predicted_label", "text") == expected
    ranks = [rows(df.select("text", F.round("ranking", 9))) for df in (in_tasks, joined)]
    assert ranks[0] == ranks[1]


def test_batch_scores_match_plain_python(spark, toy_train, row_model):
    model = {(r.label, r.word): r.word_probability for r in row_model.collect()}
    priors = {r.label: r.label_probability for r in row_model.collect()}
    got = bayes_batch.predict_rows(toy_train, row_model).collect()
    assert len(got) == 5
    for r in got:
        words = [w for w in r.text.split() if (0, w) in model]
        best = max((math.log(p) + sum(math.log(model[label, w]) for w in words), -label)
                   for label, p in priors.items())
        assert r.predicted_label == -best[1]
        assert r.ranking == pytest.approx(best[0], abs=1e-6)


def test_model_size_decides(row_model):
    assert bayes_batch.fits_in_task(row_model)
    assert bayes_batch.model_bytes(row_model) >= 20 * 2 * 8
    assert not bayes_batch.fits_in_task(row_model, max_bytes=20 * 2 * 8)


@pytest.mark.parametrize("in_tasks", [True, False, None])
def test_an_incomplete_model_is_an_error_in_both_forms(spark, toy_train, row_model, in_tasks, monkeypatch):
    for broken in (row_model.where("not (label = 0 and word = 'fun')"),
                   row_model.unionAll(row_model.where("label = 4 and word = 'fun'")), row_model.limit(0)):
        with pytest.raises(Exception, match="the model"):
            bayes_batch.predict_rows(toy_train, broken, in_tasks=in_tasks).collect()
    monkeypatch.setattr(bayes_batch.held_model, "__defaults__", (10,))
    if in_tasks:
        with pytest.raises(ValueError, match="larger"):
            bayes_batch.predict_rows(toy_train, row_model, in_tasks=True)


def test_a_stored_model_is_read_once_and_joined_without_a_job(spark, toy_train, row_model, tmp_path):
    row_model.write.parquet(str(tmp_path / "model"))
    stored = spark.read.parquet(str(tmp_path / "model"))
    assert bayes_batch.planned_bytes(stored) < bayes_batch.FILE_BYTES
    tracker = spark.sparkContext.statusTracker()

    def jobs(in_tasks):
        spark.sparkContext.setJobGroup(f"build-{in_tasks}", "")
        bayes_batch.predict_rows(toy_train, stored, in_tasks=in_tasks)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"build-{in_tasks}"))

    assert jobs(True) == 1 and jobs(None) == 1 and jobs(False) == 0


def test_training_by_a_table_function(spark, toy_train, row_model):
    toy_train.repartition(3).createOrReplaceTempView("toy_train")
    assert rows(bayes_sql.train(spark, "toy_train")) == rows(row_model.select(
        "label", "word", "label_probability", "word_probability"))
    plan = spark.sql("SELECT * FROM count_words(TABLE(SELECT label, text FROM toy_train))")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPythonUDTF" in plan
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_counting_words_by_partitions_and_in_little_memory(spark):
    docs = spark.createDataFrame([(i % 3, t) for i, (_, t) in enumerate(CORPUS * 40)] + [
        (1, ""), (1, None), (None, "no label")], "label int, text string").repartition(4)
    docs.createOrReplaceTempView("docs_to_count")
    expected = rows(docs.select("label", F.explode(F.split(clean("text"), " ")).alias("word"))
                    .where("word <> ''").groupBy("label", "word").count())
    for held in (5, 10**6):
        bayes_sql.register_count_words(spark, "counting", held_counts=held)
        for table in ("TABLE(docs_to_count)", "TABLE(docs_to_count) PARTITION BY label"):
            got = spark.sql(f"SELECT * FROM counting({table})")
            sums = got.groupBy("label", "word").agg(F.sum("word_count"), F.sum("doc_count"))
            assert rows(sums.where("word IS NOT NULL").drop("sum(doc_count)")) == expected
            assert rows(sums.where("word IS NULL").select("label", "sum(doc_count)")) == rows(
                docs.groupBy("label").count())


def test_scoring_by_a_table_function(spark, row_model):
    docs = spark.createDataFrame(CORPUS, "label int, text string").repartition(3)
    docs.createOrReplaceTempView("docs_to_score")
    bayes_sql.register_classifier(spark, row_model, "classify_docs")
    got = spark.sql("SELECT * FROM classify_docs(TABLE(SELECT label, text FROM docs_to_score))")
    assert rows(got) == rows(bayes_batch.predict_rows(docs, row_model, in_tasks=True))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_a_table_function_scores_with_a_model_too_large_for_a_task(spark, row_model, monkeypatch):
    docs = spark.createDataFrame(CORPUS + CORPUS[:3], "label int, text string").repartition(3)
    docs.createOrReplaceTempView("docs_to_score")
    small = bayes_sql.classify(spark, "docs_to_score", row_model)
    assert rows(small) == rows(bayes_batch.predict_rows(docs, row_model, in_tasks=True))
    monkeypatch.setattr(bayes_batch.held_model, "__defaults__", (10,))
    large = bayes_sql.classify(spark, "docs_to_score", row_model)
    assert rows(large.withColumn("ranking", F.round("ranking", 9))) == rows(
        small.withColumn("ranking", F.round("ranking", 9)))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPythonUDTF" in plan


def test_texts_are_taken_apart_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(arrow_text, "SLICE_BYTES", 10)
    texts = ["abc", None, "x" * 30, "", "defgh", "ijklmn", "o"]
    batch = arrow_text.pa.RecordBatch.from_pydict({"text": texts})
    parts = [part.column("text").to_pylist() for part in arrow_text.slices(batch)]
    assert [t for part in parts for t in part] == texts
    assert all(len(part) == 1 or sum(len(t or "") for t in part) <= 10 for part in parts)
    assert len(parts) == 4


def test_no_text_is_grouped_in_the_joined_form(spark, toy_train, row_model):
    plan = bayes_batch.predict_rows(toy_train, row_model, in_tasks=False)._jdf.queryExecution()
    assert "any_value(text" not in plan.optimizedPlan().toString()
    assert "first(text" not in plan.executedPlan().toString()


def test_a_thousand_labels(spark, toy_train, model):
    many = inline_labels(spark, [0, 4, 4, *range(1000, 2000)])
    kept = in_label_set(toy_train, many)
    assert rows(kept) == rows(toy_train)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(bayes_fit.fit(toy_train, many)) == rows(model)


def test_hot_text_in_the_joined_form(spark, row_model, monkeypatch):
    monkeypatch.setattr(bayes_batch, "HOT_SHARE", 3)
    docs = spark.createDataFrame([(0, "very boring film")] * 50 + [(4, f"fun {i}") for i in range(30)],
                                 "label int, text string")
    joined = bayes_batch.predict_rows(docs, row_model, in_tasks=False)
    assert rows(joined, "expected_label", "predicted_label", "text") == rows(
        bayes_batch.predict_rows(docs, row_model, in_tasks=True),
        "expected_label", "predicted_label", "text")



def test_training_tokenises_once_and_never_crosses(spark, toy_train, toy_labels):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse shows before the run
    try:
        plan = bayes_fit.fit(toy_train, toy_labels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning(value#" in line]
    own = {re.search(r"plan_id=(\d+)", line).group(1) for line in shuffles
           if "ReusedExchange" not in line}
    assert len(own) == 1 and any("ReusedExchange" in line for line in shuffles)
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in plan


def test_scoring_plan_has_no_cross_join_and_no_single_partition(toy_test, model):
    plan = bayes_rank.predict(toy_test, model)._jdf.queryExecution().executedPlan().toString()
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition"):
        assert operator not in plan


def test_a_word_hot_only_in_the_scored_texts_is_split(spark, toy_train, model):
    """A word that every text repeats but the model does not call hot: AQE splits its partition."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("zzz fun w"), F.col("id") % 997).alias("text")).repartition(8)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = bayes_rank.scores(docs, model)
        found = df.groupBy("label").count()
        assert rows(found) == [(0, 20_000), (4, 20_000)]
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


WORDS = ["good", "bad", "film", "Plot!", "café", "a\nb", "--", "x1"]
TEXT = st.none() | st.lists(st.sampled_from(WORDS), max_size=6).map(" ".join)


@settings(max_examples=4, deadline=None, derandomize=True, phases=[Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([0, 4, 7]), TEXT), min_size=2, max_size=12))
def test_any_corpus_matches_brute_force(spark, toy_labels, corpus):
    docs = spark.createDataFrame([(label, text, i) for i, (label, text) in enumerate(corpus)],
                                 "label int, text string, doc_id bigint")
    words = [(label, re.sub(r"[^A-Za-z 0-9]", "", text or "").lower().split())
             for label, text in corpus if label in (0, 4)]
    vocabulary = {w for _, ws in words for w in ws}
    present = {label for label, _ in words}
    totals = {l: sum(len(ws) for label, ws in words if label == l) for l in present}
    expected = {(l, w): (sum(ws.count(w) for label, ws in words if label == l) + 1)
                / (totals[l] + len(vocabulary)) for l in present for w in vocabulary}
    got = bayes_fit.fit(docs, toy_labels)
    assert {(r.label, r.value): r.word_prop for r in got.collect()} == expected
    assert rows(got, "label", "value", "label_prop", "word_prop") == rows(
        bayes_fit.fit_rows(docs, (0, 4)))


def test_known_labels_give_the_same_scores_and_no_count_per_document(spark, toy_train, model):
    """With the labels named, a word of a document travels once for all of them."""
    docs = spark.createDataFrame(
        [(1, "fun no fun  Fun!"), (1, "fun plot"), (None, "very fun"), (None, "no"), (2, None),
         (3, ""), (4, "zzz"), (5, "  "), (6, "no\tno no")], "doc_id bigint, text string")
    for texts in (toy_train, docs):
        want = {(r.doc_id, r.label): r.rank for r in bayes_rank.scores(texts, model).collect()}
        got = bayes_rank.scores(texts, model, labels=(4, 0, 9)).collect()
        assert len(got) == len(want)
        assert {(r.doc_id, r.label): r.rank for r in got} == {k: pytest.approx(v, abs=1e-11)
                                                              for k, v in want.items()}
    ranked = _plan(bayes_rank.ranking(docs, model, labels=(0, 4)))
    assert "hashpartitioning(doc_id" in ranked
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, (value|label)", ranked)
