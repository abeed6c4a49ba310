"""Smoothed word probability (F3) and fixed-point log scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the smallest probability a word may get (a subnormal double).
PROBABILITY_FLOOR = 1e-322

# Log terms are summed as whole multiples of 1 / LOG_UNIT, so that a rank does not
# depend on the order in which Spark adds the words of a document. Multiples of LOG_PART and
# the rest are summed apart, so that neither sum leaves the range of BIGINT.
LOG_UNIT = 1e12
LOG_PART = 1e6


def calc_prop(word_count: Column, label_words: Column, vocabulary: Column) -> Column:
    """Add-one smoothing ``(n + 1) / (T + V)``, not below the floor."""
    share = (word_count + 1).cast("double") / (label_words + vocabulary).cast("double")
    return F.greatest(share, F.lit(PROBABILITY_FLOOR))


def log_units(times: Column, probability: Column) -> Column:
    """``times * ln(probability)`` in whole log units; null where the probability is 0."""
    return F.floor(times * F.log(F.nullif(probability, F.lit(0.0))) * F.lit(LOG_UNIT) + F.lit(0.5))


def log_sum(times: Column, probability: Column) -> Column:
    """The sum of ``times * ln(probability)`` over a group, factors of 0 left out."""
    units = log_units(times, probability)
    parts = F.floor(units / F.lit(LOG_PART))
    rest = units - parts * F.lit(int(LOG_PART))
    return F.coalesce(F.sum(parts) * F.lit(LOG_PART / LOG_UNIT) + F.sum(rest) / F.lit(LOG_UNIT),
                      F.lit(0.0))


def rank_score(prior: Column, least: Column, logs: Column) -> Column:
    """``ln(prior) + sum of logs``, or minus infinity when a factor is 0."""
    return F.when(least == 0, F.lit(float("-inf"))).otherwise(F.log(prior) + logs)
