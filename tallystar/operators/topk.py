"""The best-ranked label per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_by_rank(scores: DataFrame) -> DataFrame:
    """Add ``id`` = 1 for the best ``rank`` of each document; ties go to the lowest label."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("rank"), F.asc("label"))
    return scores.withColumn("id", F.row_number().over(order))


def best_label(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per ``key`` with ``label`` and ``rank`` of the best score.

    An aggregate with map-side partial results, so no sort of the scores is needed. Equal
    to ``number_by_rank`` followed by ``id = 1``.
    """
    best = F.max(F.struct(F.col("rank"), (-F.col("label").cast("bigint")).alias("neg")))
    return (scores.groupBy(key).agg(best.alias("best"))
                  .select(key, (-F.col("best.neg")).cast("int").alias("label"),
                          F.col("best.rank").alias("rank")))
