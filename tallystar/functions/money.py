"""Exact money sums on whole cents.

Products and sums run on BIGINT inside generated code and only the totals become decimals.
A total is kept as two BIGINT parts, so that it stays exact far beyond the range of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A low part stays below this per row, so 9e12 rows fit one BIGINT sum.
PART = 1_000_000


def hundredths(df: DataFrame, name: str) -> Column:
    """A two-decimal measure of ``df`` as a whole number of hundredths."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.floor(F.col(name) * 100 + 0.5)
    return (F.col(name) * 100).cast("bigint")


def exact_sum(units: str, scale: int) -> Column:
    """Sum of a BIGINT column counted in ``10 ** -scale``, as DECIMAL(38, scale)."""
    high = F.sum(F.expr(f"{units} div {PART}")).cast("decimal(24,0)")
    low = F.sum(F.expr(f"{units} % {PART}")).cast("decimal(24,0)")
    total = high * PART + low
    if scale:
        total = total * F.lit(f"1e-{scale}").cast(f"decimal({scale},{scale})")
    return total.cast(f"decimal(38,{scale})")
