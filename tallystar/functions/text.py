"""Text cleaning and tokenising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that survive cleaning.
DROPPED_CHARS = "[^A-Za-z 0-9]+"


def clean(text: Column | str) -> Column:
    """Delete every character but ASCII letters, digits and spaces, then lower.

    Newlines and tabs are deleted too, so ``"a\\nb"`` becomes ``"ab"``. Null stays null.
    """
    return F.lower(F.regexp_replace(text, DROPPED_CHARS, ""))


def words(text: Column | str) -> Column:
    """Array of the non-empty words of a text, in order, repeats kept."""
    return F.filter(F.split(clean(text), " "), lambda w: w != "")


def tokens(docs: DataFrame, keep: Sequence[str] = ("doc_id", "label"),
           text_col: str = "text") -> DataFrame:
    """One row per word occurrence: the ``keep`` columns and ``value``.

    A null text, or one without any word, gives no row.
    """
    return (docs.select(*keep, F.explode(F.split(clean(text_col), " ")).alias("value"))
                .where("value <> ''"))
