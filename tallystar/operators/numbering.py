"""Global row numbers without a one-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.sources.shared import checkpointed

# monotonically_increasing_id() holds the partition above these low bits, the position below.
POSITION_BITS = 33


def with_row_number(df: DataFrame, order: Sequence[str], name: str = "id",
                    key: Sequence[str] | None = None) -> DataFrame:
    """Add ``row_number() over (order by ...)`` as BIGINT, starting at 1.

    Rows are range-partitioned and sorted, and written down once, so that both passes see
    the same ranges: one counts the rows per range, the other adds the counts of the
    ranges before to each row's position. Only the counts, one row per range, pass
    through a single partition. ``order`` should be unique; ties are numbered as they lie.

    With ``key``, columns without nulls that tell all rows apart, only these and the position
    are written; the other columns, those of ``order`` too, are joined to the numbers by it.
    Spark takes the range bounds from a sample of the order columns on the driver, so for
    very long texts ``spark.sql.execution.rangeExchange.sampleSizePerPartition`` should be
    small.
    """
    held = list(df.columns if key is None else key)
    numbered = F.monotonically_increasing_id()
    ranged = checkpointed(
        df.select(*dict.fromkeys([*held, *order])).repartitionByRange(*order)
          .sortWithinPartitions(*order).select(*held, numbered.alias("_at"))
          .withColumn("_range", F.shiftright("_at", POSITION_BITS))
          .withColumn("_at", F.col("_at") - F.shiftleft(F.col("_range"), POSITION_BITS)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_range").agg(F.count("*").alias("_n"))
                     .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0))
                             .alias("_offset")))
    number = (F.col("_offset") + F.col("_at") + 1).alias(name)
    numbers = ranged.join(F.broadcast(offsets), "_range").select(number, *held)
    if set(df.columns) <= set(held):
        return numbers.select(name, *df.columns)
    return numbers.join(df, held).select(name, *df.columns)
