"""Training and scoring as table functions that SQL calls.

    SELECT * FROM count_words(TABLE(SELECT label, text FROM bayes_train));
    SELECT * FROM bayes_classify(TABLE(SELECT label, text FROM bayes_test));

Both take a table as it lies in its partitions, a batch of rows at a time, so no text is
shuffled and no task sees the whole input. The first accumulates and emits partial counts
when its rows end; ``TRAIN`` adds them up to the model. With ``PARTITION BY`` the first also
counts groups apart. Null texts are documents without words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udtf

from tallystar.functions.arrow_text import cleaned, row_words, slices
from tallystar.plans.bayes_batch import MAX_MODEL_BYTES, HeldModel, held_model, predict_by_join

# Counts that a task holds before it adds equal ones up, and emits them if they stay many.
HELD_COUNTS = 300_000


def partial_counts(rows: pa.RecordBatch, label: str = "label", text: str = "text") -> pa.Table:
    """(label, word, word_count, doc_count) of a batch; documents are rows without a word."""
    labels = rows.column(label).cast(pa.int32())
    split = pc.split_pattern(pc.fill_null(cleaned(rows.column(text)), ""), " ")
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.not_equal(words, "")
    words, owner = words.filter(real), owner.filter(real)
    ones, none = pa.repeat(pa.scalar(1, pa.int64()), len(words)), pa.scalar(0, pa.int64())
    docs = pa.repeat(pa.scalar(1, pa.int64()), len(labels))
    return added_up([pa.table({
        "label": pa.concat_arrays([labels.take(owner), labels]),
        "word": pa.concat_arrays([words, pa.nulls(len(labels), pa.string())]),
        "word_count": pa.concat_arrays([ones, pa.repeat(none, len(labels))]),
        "doc_count": pa.concat_arrays([pa.repeat(none, len(words)), docs])})])


def added_up(counts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(counts).group_by(["label", "word"]).aggregate(
        [("word_count", "sum"), ("doc_count", "sum")])
    return sums.rename_columns({"word_count_sum": "word_count", "doc_count_sum": "doc_count"}).select(
        ["label", "word", "word_count", "doc_count"])


def register_count_words(spark: SparkSession, name: str = "count_words",
                         held_counts: int = HELD_COUNTS) -> None:
    """Make ``name(TABLE(label, text))`` callable: partial counts per task or partition."""
    @arrow_udtf(returnType="label int, word string, word_count bigint, doc_count bigint")
    class CountWords:
        def __init__(self):
            self.held, self.rows = [], 0

        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            for part in slices(rows):
                self.held.append(partial_counts(part))
                self.rows += self.held[-1].num_rows
                if self.rows >= held_counts:
                    self.held = [added_up(self.held)]
                    self.rows = self.held[0].num_rows
                    if 2 * self.rows >= held_counts:          # most of them are different
                        yield self.held.pop()
                        self.rows = 0

        def terminate(self) -> Iterator[pa.Table]:
            if self.held:
                yield added_up(self.held)

    spark.udtf.register(name, CountWords)


TRAIN = """
WITH counted AS (
    SELECT label, word, sum(word_count) AS n, sum(doc_count) AS docs
    FROM count_words(TABLE(SELECT label, text FROM IDENTIFIER(:docs))) GROUP BY label, word),
by_word AS (
    SELECT word, map_from_entries(collect_list(struct(label, n))) AS counts
    FROM counted WHERE word IS NOT NULL GROUP BY word),
per_label AS (
    SELECT label, sum(n) AS words, sum(docs) AS docs, sum(sum(docs)) OVER () AS all_docs,
           (SELECT count(*) FROM by_word) AS vocabulary
    FROM counted GROUP BY label),
grid AS (
    SELECT word, counts, explode((SELECT collect_list(struct(*)) FROM per_label)) AS l FROM by_word)
SELECT l.label, word, l.docs / l.all_docs AS label_probability,
       greatest(CAST(coalesce(try_element_at(counts, l.label), 0) + 1 AS DOUBLE)
                / CAST(l.words + l.vocabulary AS DOUBLE), CAST('1e-322' AS DOUBLE))
           AS word_probability
FROM grid
"""


def train(spark: SparkSession, docs: str) -> DataFrame:
    """The model (label, word, label_probability, word_probability) of a table named ``docs``."""
    register_count_words(spark)
    return spark.sql(TRAIN, args={"docs": docs})


def register_classifier(spark: SparkSession, model: DataFrame, name: str = "bayes_classify") -> None:
    """Make ``name(TABLE(label, text))`` callable with a model of up to MAX_MODEL_BYTES.

    The model is read once, sent to every executor once, and loaded once per worker. A text
    without a known word gets the label with the highest prior.
    """
    held = held_model(model)
    if held is None:
        raise ValueError(f"the model is larger than {MAX_MODEL_BYTES} bytes")
    register_held(spark, held, name)


def register_held(spark: SparkSession, held: HeldModel, name: str = "bayes_classify") -> None:
    sent = spark.sparkContext.broadcast(held)

    @arrow_udtf(returnType="expected_label int, predicted_label int, ranking double, text string")
    class Classify:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            for part in slices(rows):
                texts = part.column("text")
                scored = sent.value.score(cleaned(texts))
                yield pa.table({"expected_label": part.column("label").cast(pa.int32()),
                                "predicted_label": scored.field("predicted_label"),
                                "ranking": scored.field("ranking"), "text": texts})

    spark.udtf.register(name, Classify)


def register_text_words(spark: SparkSession, name: str = "text_words") -> None:
    """Make ``name(TABLE(doc_id, text))`` callable: how often each word occurs in each row."""
    @arrow_udtf(returnType="doc_id binary, value string, tf bigint")
    class TextWords:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            for part in slices(rows):
                yield row_words(part)

    spark.udtf.register(name, TextWords)


def classify(spark: SparkSession, docs: str, model: DataFrame) -> DataFrame:
    """(expected_label, predicted_label, ranking, text) of a table named ``docs(label, text)``.

    With a model of up to MAX_MODEL_BYTES the table function scores the texts as they lie. With
    a larger one it counts the words of each text, which then meet the model in a join.
    """
    held = held_model(model)
    if held is not None:
        register_held(spark, held)
        return spark.sql("SELECT * FROM bayes_classify(TABLE(SELECT label, text FROM IDENTIFIER(:docs)))",
                         args={"docs": docs})
    register_text_words(spark)
    counted = spark.sql("""
        SELECT doc_id, value, max(tf) AS tf FROM text_words(TABLE(
            SELECT unhex(sha2(coalesce(text, ''), 256)) AS doc_id, text FROM IDENTIFIER(:docs)))
        GROUP BY doc_id, value""", args={"docs": docs})
    rows = predict_by_join(spark.table(docs).select("label", "text"), model, counted)
    return rows.select(F.col("label").alias("expected_label"), "predicted_label", "ranking", "text")
