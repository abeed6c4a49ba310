"""The label set: inline rows, and documents cut to it (IO2, P1, J1)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to this many labels become literals of the plan; larger label tables are joined.
FEW_LABELS = 100
# Up to this many distinct labels, whole numbers all, are sent to every task.
MOST_LABELS = 1_000_000


def inline_labels(spark: SparkSession, labels: Iterable[int]) -> DataFrame:
    """A one-column ``label`` table from literal values."""
    rows = ", ".join(f"({int(v)})" for v in labels)
    return spark.sql(f"SELECT label FROM VALUES {rows} AS t(label)")


def few_labels(labels: DataFrame) -> list[int] | None:
    """The distinct label values if they are few, else None."""
    rows = (labels.select("label").where("label IS NOT NULL").distinct()
            .limit(FEW_LABELS + 1).collect())
    return sorted(r.label for r in rows) if len(rows) <= FEW_LABELS else None


def with_label_in(docs: DataFrame, labels: Iterable[int]) -> DataFrame:
    """Rows whose label is one of a few literal values; the filter reaches the scan."""
    return docs.where(F.col("label").isin(*labels))


def in_label_set(docs: DataFrame, labels: DataFrame, few: list[int] | None = None) -> DataFrame:
    """Rows whose label occurs in the label table, each kept once.

    Few labels become a filter, more of them a semi join to which the distinct labels are
    sent: a shuffle on the label would gather the texts in a few partitions. Beyond
    MOST_LABELS, where every label has few texts, they are shuffled. ``few`` is
    ``few_labels(labels)`` if that is known already.
    """
    if few is None:
        few = few_labels(labels)
    if few is not None:
        return with_label_in(docs, few)
    distinct = labels.select("label").distinct()
    if distinct.count() <= MOST_LABELS:
        distinct = F.broadcast(distinct)
    return docs.join(distinct, "label", "left_semi").select(*docs.columns)
