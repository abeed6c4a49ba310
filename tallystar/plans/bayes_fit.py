"""Training a multinomial Naive-Bayes model (K1, K3).

The corpus is tokenised once: everything that needs word counts reads the shuffle output
of ``count_by_word``, which Spark reuses between the branches of one plan. Label totals,
priors and the vocabulary size are scalar subqueries, so the words themselves are never
joined or crossed with anything. Only per-label rows travel to every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.probability import calc_prop
from tallystar.functions.text import tokens
from tallystar.operators.labels import few_labels, in_label_set, with_label_in

MODEL_COLUMNS = ("label", "value", "word_count", "total_count_words_in_label",
                 "word_prop", "label_prop", "total_words")


def count_words(docs: DataFrame) -> DataFrame:
    """(label, value, word_count) of the pairs that occur."""
    return (tokens(docs, keep=["label"]).groupBy("label", "value")
            .agg(F.count("*").alias("word_count")))


def count_by_word(docs: DataFrame, labels: Sequence[int] | None = None) -> DataFrame:
    """(value, counts): one row per word with a map from label to its count there.

    A map has at most one entry per label, so a frequent word is still one small row. With
    the labels of the documents given, one shuffle is enough; without, the (label, word)
    counts are gathered per word in a second one.
    """
    if labels is not None:
        labels = sorted(set(labels))
        per_label = [F.count_if(F.col("label") == v) for v in labels]
        counts = F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*per_label))
        return tokens(docs, keep=["label"]).groupBy("value").agg(counts.alias("counts"))
    entry = F.struct("label", "word_count")
    return (count_words(docs).groupBy("value")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("counts")))


def vocabulary(docs: DataFrame) -> DataFrame:
    """The distinct words of the documents."""
    return tokens(docs, keep=[]).distinct()


def vocabulary_size(docs: DataFrame) -> DataFrame:
    """One row: the number of distinct words."""
    return vocabulary(docs).agg(F.count("*").alias("total_words"))


def _label_array(labels: DataFrame) -> Column:
    return labels.agg(F.sort_array(F.collect_set("label"))).scalar()


def cross_label_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every label beside every distinct word, whether it occurs there or not."""
    return vocabulary(docs).select(F.explode(_label_array(labels)).alias("label"), "value")


def _count_in(label: Column, absent_count: int) -> Column:
    found = F.coalesce(F.try_element_at("counts", label), F.lit(0))
    return F.greatest(found, F.lit(absent_count)).cast("bigint")


def label_words(docs: DataFrame, labels: DataFrame, absent_count: int = 0) -> DataFrame:
    """(label, value, word_count) for every label and distinct word.

    ``absent_count`` is what a word counts in a label where it never occurs: 0, or 1 for
    the variant that counts the grid row itself.
    """
    grid = count_by_word(docs, few_labels(labels)).select(
        F.explode(_label_array(labels)).alias("label"), "value", "counts")
    return grid.select("label", "value",
                       _count_in(F.col("label"), absent_count).alias("word_count"))


def label_priors(docs: DataFrame) -> DataFrame:
    """(label, doc_count, label_prop): distinct documents per label and their share."""
    total = docs.agg(F.countDistinct("doc_id")).scalar()
    return (docs.groupBy("label").agg(F.countDistinct("doc_id").alias("doc_count"))
                .withColumn("label_prop", F.col("doc_count") / total))


def _word_sums(by_word: DataFrame) -> Column:
    """One struct in a scalar subquery: ``size``, the number of distinct words, and
    ``labels``, a map from label to its occurrences ``n`` and its distinct words ``present``.
    """
    sums = (by_word.select(F.posexplode("counts").alias("pos", "label", "n"))
            .groupBy("label").agg(F.sum("n").alias("n"),
                                  F.count_if(F.col("n") > 0).alias("present"),
                                  # Every word has one first entry in its map.
                                  F.count_if(F.col("pos") == 0).alias("first")))
    return sums.agg(F.struct(
        F.coalesce(F.sum("first"), F.lit(0)).alias("size"),
        F.map_from_entries(F.collect_list(F.struct("label", F.struct("n", "present"))))
        .alias("labels")).alias("sums")).scalar()


def _total(sums: Column, label: Column, absent_count: int) -> Column:
    """Words under a label over the whole grid; absent words add ``absent_count`` each."""
    mine = F.try_element_at(sums["labels"], label)
    absent = sums["size"] - F.coalesce(mine["present"], F.lit(0))
    return (F.coalesce(mine["n"], F.lit(0)) + F.lit(absent_count) * absent).cast("bigint")


def label_totals(docs: DataFrame, labels: DataFrame, absent_count: int = 0) -> DataFrame:
    """(label, total_count_words_in_label) over the whole label-word grid.

    Summed from the pairs that occur; the absent ones need only be counted.
    """
    sums = _word_sums(count_by_word(docs, few_labels(labels)))
    return (labels.select("label").distinct().select(
        "label", _total(sums, F.col("label"), absent_count).alias("total_count_words_in_label")))


def _assemble(by_word: DataFrame, priors: DataFrame, absent_count: int) -> DataFrame:
    """The dense model from word counts and one row per label that has documents."""
    label, prior_of = F.col("label"), priors.agg(
        F.map_from_entries(F.collect_list(F.struct("label", "label_prop")))).scalar()
    grid = by_word.select(F.explode(prior_of).alias("label", "label_prop"), "value", "counts",
                          _word_sums(by_word).alias("sums"))
    counted = grid.select(
        "label", "value", _count_in(label, absent_count).alias("word_count"),
        _total(F.col("sums"), label, absent_count).alias("total_count_words_in_label"),
        "label_prop", F.col("sums.size").alias("total_words"))
    prop = calc_prop(F.col("word_count"), F.col("total_count_words_in_label"),
                     F.col("total_words"))
    return counted.withColumn("word_prop", prop).select(*MODEL_COLUMNS)


def fit(docs: DataFrame, labels: DataFrame, absent_count: int = 0) -> DataFrame:
    """Train on ``docs(label, text, doc_id)`` cut to the label set; columns MODEL_COLUMNS."""
    few = few_labels(labels)
    kept = in_label_set(docs, labels, few)
    return _assemble(count_by_word(kept, few), label_priors(kept), absent_count)


def fit_rows(docs: DataFrame, labels: Sequence[int] | None = None) -> DataFrame:
    """Train on ``docs(label, text)``, one row being one document.

    ``labels`` cuts the documents to a few label values; without it all labels are taken.
    Returns (label, word, label_probability, word_probability).
    """
    if labels is not None:
        docs = with_label_in(docs, labels)
    per_label = docs.groupBy("label").agg(F.count("*").alias("doc_count"))
    total = docs.agg(F.count("*")).scalar()
    priors = per_label.withColumn("label_prop", F.col("doc_count") / total)
    model = _assemble(count_by_word(docs, labels), priors, absent_count=0)
    return model.select("label", F.col("value").alias("word"),
                        F.col("label_prop").alias("label_probability"),
                        F.col("word_prop").alias("word_probability"))
