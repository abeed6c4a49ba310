"""Scoring documents row by row with a model that every task holds (K4, U4).

The text column never shuffles: cleaned texts go to Python as Arrow batches and one small
struct per row comes back. A model too large for that is joined instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.arrow_text import row_words, slices
from tallystar.functions.probability import LOG_PART, LOG_UNIT
from tallystar.functions.text import clean
from tallystar.operators.salting import salted_join
from tallystar.operators.topk import best_label
from tallystar.plans.bayes_rank import SALTS, best_prior, scores

# A model up to this size, its words and its matrix of words and labels, is sent to the tasks.
MAX_MODEL_BYTES = 64 * 1024 * 1024
# A stored model with files up to this size is read without being measured first.
FILE_BYTES = 16 * 1024 * 1024
# A text that makes up this share of all rows or more has its copies spread.
HOT_SHARE = 1_000

INCOMPLETE = "the model lacks a probability for some word and label, or repeats one"
PREDICTION = "predicted_label int, ranking double, known boolean"


def model_bytes(model: DataFrame) -> int:
    """The bytes of a complete model's words and matrix.

    A model without words, or one in which a word and a label have no probability or two, is
    an error: scores would depend on what is missing.
    """
    size = (model.groupBy("word").agg(F.count("*").alias("n"), F.count_distinct("label").alias("l"))
            .agg(F.count("*").alias("words"), F.max("n").alias("most"), F.min("l").alias("least"),
                 F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first())
    if not size.words:
        raise ValueError("the model has no words")
    labels = model.agg(F.count_distinct("label")).first()[0]
    if size.least != labels or size.most != labels:
        raise ValueError(INCOMPLETE)
    return size.bytes + 8 * size.words * labels


def fits_in_task(model: DataFrame, max_bytes: int = MAX_MODEL_BYTES) -> bool:
    """Whether the model is small enough to be held by every task."""
    return model_bytes(model) <= max_bytes


def planned_bytes(df: DataFrame) -> int:
    """The size that Spark's planner expects; of a table that is read, the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


class HeldModel:
    """A complete model in memory: its words, the logs per word and label, labels and priors."""

    def __init__(self, rows: pa.Table):
        encoded = rows["word"].combine_chunks().dictionary_encode()
        self.labels, column, at = np.unique(rows["label"].to_numpy(), return_index=True,
                                            return_inverse=True)
        self.words = encoded.dictionary
        self.logs = np.full((len(self.words), len(self.labels)), np.nan)
        if not len(self.words):
            raise ValueError("the model has no words")
        probabilities = rows["word_probability"].to_numpy()
        if len(rows) != self.logs.size or len(np.unique(
                encoded.indices.to_numpy().astype(np.int64) * len(self.labels) + at)) != len(rows):
            raise ValueError(INCOMPLETE)
        with np.errstate(divide="ignore"):
            self.logs[encoded.indices.to_numpy(), at] = np.log(probabilities)
            self.base = np.log(rows["label_probability"].to_numpy()[column])

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.logs.nbytes

    def score(self, texts: pa.Array) -> pa.StructArray:
        """A PREDICTION per cleaned text."""
        n, logs, part, unit = len(texts), self.logs, LOG_PART, LOG_UNIT
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")
        at = pc.fill_null(pc.index_in(pc.list_flatten(split), self.words), -1).to_numpy()
        doc = pc.list_parent_indices(split).to_numpy()
        hit = at >= 0
        cells, tf = np.unique(doc[hit].astype(np.int64) * len(self.words) + at[hit],
                              return_counts=True)
        doc, word = np.divmod(cells, len(self.words))
        units = np.floor(tf[:, None] * logs[word] * unit + 0.5)
        whole = np.floor(units / part)
        rest = units - whole * part
        ranks = np.column_stack([
            self.base[k] + (np.bincount(doc, whole[:, k], n) * (part / unit)
                            + np.bincount(doc, rest[:, k], n) / unit)
            for k in range(len(self.labels))])
        zero = np.isneginf(logs).any() and [  # a factor of 0 makes the rank minus infinity
            np.bincount(doc, np.isneginf(logs[word][:, k]), n) > 0 for k in range(len(self.labels))]
        if zero:
            ranks[np.column_stack(zero)] = -np.inf
        best = ranks.argmax(axis=1)  # the first of equal ranks, so the lowest label
        return pa.StructArray.from_arrays(
            [pa.array(self.labels[best].astype(np.int32)), pa.array(ranks[np.arange(n), best]),
             pa.array(np.bincount(doc, minlength=n) > 0)],
            names=["predicted_label", "ranking", "known"])


def held_model(model: DataFrame, max_bytes: int = MAX_MODEL_BYTES) -> HeldModel | None:
    """The model if a task may hold it, else None.

    The files of a stored model say how large it can be, so it is read once. A model that is
    computed, or has large files, is measured before it is collected.
    """
    if planned_bytes(model) > FILE_BYTES and not fits_in_task(model, max_bytes):
        return None
    held = HeldModel(model.select("label", "word", "label_probability", "word_probability").toArrow())
    return held if held.nbytes <= max_bytes else None


def _scorer(spark: SparkSession, model: HeldModel):
    """An Arrow UDF from cleaned text to PREDICTION, its model broadcast once."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield held.value.score(texts)

    return score


def _checked(docs: DataFrame, model: DataFrame) -> DataFrame:
    """The same rows; reading them is an error if the model is empty or not complete."""
    labels = model.agg(F.count_distinct("label")).scalar()
    per_word = model.groupBy("word").agg(F.count("*").alias("n"), F.count_distinct("label").alias("l"))
    bad = per_word.where((F.col("n") != labels) | (F.col("l") != labels)).agg(F.count("*")).scalar()
    words = model.agg(F.count("*")).scalar()
    return docs.where(F.assert_true(words > 0, "the model has no words").isNull()
                      & F.assert_true(bad == 0, INCOMPLETE).isNull())


def _as_joined_model(model: DataFrame) -> DataFrame:
    return model.select("label", F.col("word").alias("value"),
                        F.col("label_probability").alias("label_prop"),
                        F.col("word_probability").alias("word_prop"))


def _predict_in_tasks(docs: DataFrame, model: HeldModel) -> DataFrame:
    scored = docs.withColumn("_p", _scorer(docs.sparkSession, model)(clean("text")))
    return scored.select("label", "_p.predicted_label", "_p.ranking", "text", "_p.known")


def predict_by_join(docs: DataFrame, model: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Score each distinct text once and bring the result back to all of its copies.

    No text is grouped: copies are known by their hash, and their words are counted in each, then
    taken once. ``counted`` is (doc_id, value, tf) of the distinct texts,
    named by ``unhex(sha2(text, 256))``, if that is known already.
    """
    joined_model = _as_joined_model(model)
    keyed = _checked(docs, model).withColumn(
        "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    copies = keyed.groupBy("doc_id").agg(F.count("*").alias("copies"))
    if counted is None:
        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    yield from row_words(part).to_batches()

        found = keyed.select("doc_id", "text").mapInArrow(
            words, "doc_id binary, value string, tf bigint")
        counted = found.groupBy("doc_id", "value").agg(F.max("tf").alias("tf"))
    best = best_label(scores(keyed, joined_model, counted=counted))
    prior = best_prior(joined_model)
    scored = (copies.select("doc_id").join(best, "doc_id", "left")
              .select("doc_id", F.coalesce("label", prior["label"]).alias("predicted_label"),
                      F.coalesce("rank", prior["rank"]).alias("ranking"),
                      F.col("rank").isNotNull().alias("known")))
    hot = copies.where(F.col("copies") * HOT_SHARE >= docs.agg(F.count("*")).scalar())
    return (salted_join(keyed, scored, "doc_id", hot, F.monotonically_increasing_id(), SALTS)
            .select("label", "predicted_label", "ranking", "text", "known"))


def predict_rows(docs: DataFrame, model: DataFrame, unknown_docs: str = "prior",
                 in_tasks: bool | None = None) -> DataFrame:
    """(expected_label, predicted_label, ranking, text) for every row of ``docs(label, text)``.

    ``model`` has the columns of ``fit_rows``. A text without a known word gets the label
    with the highest prior, or with ``unknown_docs="drop"`` is left out. ``in_tasks`` says
    which way to score; by default the size of the model decides. Both give the same result,
    and an incomplete model is an error in both.
    """
    if unknown_docs not in ("drop", "prior"):
        raise ValueError(f"unknown_docs must be 'drop' or 'prior', not {unknown_docs!r}")
    held = held_model(model) if in_tasks in (None, True) else None
    if in_tasks and held is None:
        raise ValueError(f"the model is larger than {MAX_MODEL_BYTES} bytes")
    rows = docs.select("label", "text")
    rows = predict_by_join(rows, model) if held is None else _predict_in_tasks(rows, held)
    if unknown_docs == "drop":
        rows = rows.where("known")
    return rows.select(F.col("label").alias("expected_label"), "predicted_label", "ranking", "text")
