"""Equi-join of a skewed side with a keyed side, its hot keys spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(skewed: DataFrame, keyed: DataFrame, key: str, hot: DataFrame,
                spread: Column, salts: int) -> DataFrame:
    """Inner join on ``key`` where rows of a hot key go to ``salts`` places instead of one.

    ``hot`` holds the hot keys. It only steers where rows travel: any set gives the same
    result. It is broadcast, so the caller must pass one whose size is bounded. Rows of
    ``keyed`` are repeated for hot keys only.
    """
    marks = F.broadcast(hot.select(F.col(key).alias("_hot")).distinct())
    is_hot = F.col("_hot").isNotNull()
    left = (skewed.join(marks, F.col(key) == F.col("_hot"), "left")
                  .withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)))
                                        .otherwise(F.lit(0)).cast("int"))
                  .drop("_hot"))
    right = (keyed.join(marks, F.col(key) == F.col("_hot"), "left")
                  .withColumn("_salt", F.explode(F.sequence(
                      F.lit(0), F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0)))))
                  .drop("_hot"))
    return left.join(right, [key, "_salt"]).drop("_salt")
