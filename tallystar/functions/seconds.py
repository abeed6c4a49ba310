"""Means of measured times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANO = 1e9


def _parts(name: str) -> tuple[Column, Column]:
    """Whole seconds of a column, and the rest in whole nanoseconds."""
    nanos = F.floor(F.col(name) * NANO + 0.5)
    whole = F.floor(nanos / NANO)
    return whole, nanos - whole * F.lit(int(NANO))


def _mean(whole: Column, rest: Column, count: Column) -> Column:
    total = whole.cast("decimal(28,0)") * F.lit(int(NANO)) + rest.cast("decimal(38,0)")
    return total.cast("double") / (count * F.lit(NANO))


def mean_seconds(name: str) -> Column:
    """Mean of a column of seconds, summed in whole nanoseconds.

    The sum of whole numbers is the same in any order of rows, unlike that of doubles. Whole
    seconds and the rest are summed apart, so that neither sum leaves the range of BIGINT.
    """
    whole, rest = _parts(name)
    return _mean(F.sum(whole), F.sum(rest), F.count(name))


def second_sums(name: str) -> Column:
    """A struct of the sums that ``mean_of_sums`` adds up over several groups."""
    whole, rest = _parts(name)
    return F.struct(F.sum(whole).alias("whole"), F.sum(rest).alias("rest"), F.count(name).alias("n"))


def mean_of_sums(name: str) -> Column:
    """``mean_seconds`` over the rows of all groups of which a column holds ``second_sums``."""
    return _mean(F.sum(f"{name}.whole"), F.sum(f"{name}.rest"), F.nullif(F.sum(f"{name}.n"), F.lit(0)))
