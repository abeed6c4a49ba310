"""Scoring documents with a trained model by joins (K2, K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.probability import log_sum, rank_score
from tallystar.functions.text import tokens
from tallystar.operators.salting import salted_join
from tallystar.operators.topk import best_label, number_by_rank

# The word probabilities of a label sum to 1 over the vocabulary, so at most HOT_WORDS
# words per label can have a probability of 1 / HOT_WORDS or more.
HOT_WORDS = 1_000
SALTS = 64


def word_frequencies(docs: DataFrame) -> DataFrame:
    """(doc_id, value, tf): how often each word occurs in each document."""
    return (tokens(docs, keep=["doc_id"]).groupBy("doc_id", "value")
            .agg(F.count("*").alias("tf")))


def known_words(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, value): the word occurrences whose word is in the vocabulary.

    Every occurrence is kept and travels once, to the place of its word. The words that occur
    most are counted first, in partial sums, and spread.
    """
    words = tokens(docs, keep=["doc_id"])
    hot = (words.groupBy("value").agg(F.count("*").alias("times"))
           .orderBy(F.desc("times"), "value").limit(HOT_WORDS))
    kept = salted_join(words, vocabulary.select("value").distinct(), "value", hot,
                       F.col("doc_id"), SALTS)
    return kept.select("doc_id", "value")


def scores(docs: DataFrame, model: DataFrame, salts: int = SALTS,
           counted: DataFrame | None = None, labels: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, label, rank) of every document that has a known word, for every label.

    Words are counted per document before they travel. The join with the model drops
    unknown words; words that are frequent in some label are spread over ``salts`` places.
    ``counted`` is ``word_frequencies(docs)`` if that is known already. ``labels`` are all the
    labels that the model can have, if they are few and known: then texts go to their document's
    place, where words are counted, and words travel once for all labels.
    """
    hot = model.where(F.col("word_prop") >= 1.0 / HOT_WORDS).select("value")
    if labels is not None:
        if counted is None:
            counted = word_frequencies(docs.select("doc_id", "text").repartition("doc_id"))
        return _scores_of(counted, model, sorted(set(labels)), hot, salts)
    if counted is None:
        counted = word_frequencies(docs)
    probabilities = model.select("value", "label", "word_prop", "label_prop")
    matched = salted_join(counted, probabilities, "value", hot, F.col("doc_id"), salts)
    sums = matched.groupBy("doc_id", "label").agg(
        F.max("label_prop").alias("prior"), F.min("word_prop").alias("least"),
        log_sum(F.col("tf"), F.col("word_prop")).alias("logs"))
    rank = rank_score(F.col("prior"), F.col("least"), F.col("logs"))
    return sums.select("doc_id", "label", rank.alias("rank"))


def _scores_of(counted: DataFrame, model: DataFrame, labels: Sequence[int], hot: DataFrame,
               salts: int) -> DataFrame:
    """The scores with a row per word and document, and columns for each of a few labels."""
    places = range(len(labels))
    by_word = model.groupBy("value").agg(*(
        F.max(F.when(F.col("label") == labels[k], F.col(c))).alias(f"{c}_{k}")
        for k in places for c in ("word_prop", "label_prop")))
    matched = salted_join(counted, by_word, "value", hot, F.col("doc_id"), salts)
    sums = matched.groupBy("doc_id").agg(*(c for k in places for c in (
        F.max(f"label_prop_{k}").alias(f"prior_{k}"), F.min(f"word_prop_{k}").alias(f"least_{k}"),
        log_sum(F.col("tf"), F.col(f"word_prop_{k}")).alias(f"logs_{k}"))))
    kind = model.schema["label"].dataType
    entries = F.array(*(F.struct(
        F.lit(labels[k]).cast(kind).alias("label"), F.col(f"prior_{k}").alias("prior"),
        rank_score(F.col(f"prior_{k}"), F.col(f"least_{k}"), F.col(f"logs_{k}")).alias("rank"))
        for k in places))
    return (sums.select("doc_id", F.explode(entries).alias("s")).where("s.prior IS NOT NULL")
            .select("doc_id", "s.label", "s.rank"))


def ranking(docs: DataFrame, model: DataFrame, labels: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, label, rank, id) with ``id`` = 1 for the best label of a document.

    ``labels`` as in ``scores``.
    """
    return number_by_rank(scores(docs, model, labels=labels))


def best_prior(model: DataFrame, label: str = "label", prior: str = "label_prop") -> Column:
    """The label with the highest prior (lowest label on a tie) and its rank ``ln(prior)``."""
    best = F.max(F.struct(F.col(prior).alias("prior"), (-F.col(label)).alias("neg"))).alias("b")
    return model.agg(best).select(F.struct(
        (-F.col("b.neg")).cast("int").alias("label"),
        F.log("b.prior").alias("rank"))).scalar()


def predict(docs: DataFrame, model: DataFrame, unknown_docs: str = "drop",
            labels: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, status, predicted, target, text) for ``docs(doc_id, label, text)``.

    A document without a known word is left out, or with ``unknown_docs="prior"`` gets the
    label with the highest prior. ``labels`` as in ``scores``.
    """
    if unknown_docs not in ("drop", "prior"):
        raise ValueError(f"unknown_docs must be 'drop' or 'prior', not {unknown_docs!r}")
    found = scores(docs, model, labels=labels)
    best = best_label(found).select("doc_id", F.col("label").alias("predicted"))
    target = docs.select("doc_id", F.col("label").alias("target"), "text")
    if unknown_docs == "drop":
        found = target.join(best, "doc_id")
    else:
        found = target.join(best, "doc_id", "left").withColumn(
            "predicted", F.coalesce("predicted", best_prior(model)["label"]))
    status = F.when(F.col("predicted") == F.col("target"), "Correct").otherwise("Not Correct")
    return found.select("doc_id", status.alias("status"), "predicted", "target", "text")


def accuracy(predictions: DataFrame, predicted: str = "predicted",
             target: str = "target") -> DataFrame:
    """One row: the share of predictions that hit the target, in one pass."""
    hit = F.when(F.col(predicted) == F.col(target), 1).when(
        F.col(predicted) != F.col(target), 0)
    return predictions.agg(F.avg(hit).alias("success"))
