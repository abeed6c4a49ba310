"""Sharding: a uniform shuffle into shards whose sizes differ by one row at most.

Rows are written once with the number of the partition they were in and their place in it,
so that everything after is a function of stored values. The counts of the communication
matrix (rows of each partition for each shard) are drawn from the multivariate
hypergeometric distribution: partitions are halved again and again, and each half's share of
every shard is drawn given its size, so a task draws the line of its own partition from a
few generators that the seed and the half name. The partition's rows are permuted and dealt
by these counts, exchanged, and permuted again within the shard by random keys: shards are cut
into many equal ranges of the key, ranges are numbered by their counts, and rows by their
order within the range, so no shard passes through one task.

Nulls and empty texts are rows like others; repeated rows are shuffled as separate rows. The
result has all columns of the input and `shard` and `slot`; input columns of these names are
refused. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.common import in_batches, written

#: Rows that one range of a shard's random keys holds on average.
RANGE_ROWS = 250


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def _hypergeometric(random: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of the drawn are good. Beyond numpy's range of 10^9 a rounded normal draw."""
    if max(good + bad, drawn) < 1_000_000_000:
        return int(random.hypergeometric(good, bad, drawn))
    total = good + bad
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / (total - 1))) ** 0.5
    return int(min(max(round(random.normal(drawn * good / total, spread)), drawn - bad, 0),
                   good, drawn))


def _shares(random: np.random.Generator, share: np.ndarray, drawn: int) -> np.ndarray:
    """A multivariate hypergeometric draw, one shard after the other."""
    out, rest = np.zeros_like(share), int(share.sum())
    for i, good in enumerate(share.tolist()):
        rest -= good
        out[i] = _hypergeometric(random, good, rest, drawn) if good and drawn else 0
        drawn -= int(out[i])
    return out


def matrix_line(partition: int, ends: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows of a partition go to each shard; `ends` are running counts of rows."""
    low, high = 0, len(ends)
    share = shard_sizes(ends[-1], shards)
    while high - low > 1:
        middle = (low + high) // 2
        left = ends[middle - 1] - (ends[low - 1] if low else 0)
        draw = _shares(np.random.default_rng([seed, low, high]), share, left)
        low, high, share = ((low, middle, draw) if partition < middle
                            else (middle, high, share - draw))
    return share


def _permuted(index: int, ends: list[int], shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard and the random key of each place of a partition."""
    line = matrix_line(index, ends, shards, seed)
    random = np.random.default_rng([seed, len(ends), index, 1])
    shard = random.permutation(np.repeat(np.arange(shards, dtype=np.int32), line))
    return shard, random.integers(0, 1 << 63, len(shard))


def uniform_shards(docs: DataFrame, shards: int, *, seed: int = 0) -> DataFrame:
    """All rows with `shard` from 0 and `slot` from 0 without gaps in each shard."""
    made = ["shard", "slot", "_from", "_place", "_key", "_range", "_at", "_start"]
    if clash := set(made) & set(docs.columns):
        raise ValueError(f"columns of these names are made here: {sorted(clash)}")
    row = F.monotonically_increasing_id()
    rows = written(docs.withColumns({"_from": F.shiftright(row, 33).cast("int"),
                                     "_place": row.bitwiseAND((1 << 33) - 1)}), "shuffled")
    counts = rows.groupBy("_from").count().orderBy("_from").toArrow()  # a row per partition
    if not counts.num_rows:
        return docs.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    index = {name: i for i, name in enumerate(counts["_from"].to_pylist())}
    ends = np.cumsum(counts["count"].to_numpy()).tolist()
    ranges = -(-ends[-1] // (shards * RANGE_ROWS))
    held = docs.sparkSession.sparkContext.broadcast((index, ends))
    columns = docs.columns

    def dealt(batches):
        index, ends = held.value
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sources, places = batch.column("_from").to_numpy(), batch.column("_place").to_numpy()
            shard, key = np.empty(len(sources), np.int32), np.empty(len(sources), np.int64)
            for source in np.unique(sources).tolist():
                if source not in known:
                    known = {source: _permuted(index[source], ends, shards, seed)}
                at = sources == source
                shard[at], key[at] = (v[places[at]] for v in known[source])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(shard), pa.array(key),
                 pa.array(_range_of(key, ranges))], [*columns, "shard", "_key", "_range"])

    def counted(batches):
        """The same draws without the rows: sizes of the ranges, per partition."""
        _, ends = held.value
        for batch in batches:
            for partition in batch.column(0).to_pylist():
                shard, key = _permuted(partition, ends, shards, seed)
                at, count = np.unique(shard.astype(np.int64) * ranges + _range_of(key, ranges),
                                      return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at // ranges).astype(np.int32)), pa.array(at % ranges),
                     pa.array(count)], ["shard", "_range", "rows"])

    schema = T.StructType(list(docs.schema.fields)).add("shard", T.IntegerType()).add("_key", T.LongType()).add(
        "_range", T.LongType())
    sizes = in_batches(docs.sparkSession.range(len(ends)), counted,
                       "shard int, _range long, rows long")
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.groupBy("shard", "_range").agg(F.sum("rows").alias("rows")).select(
        "shard", "_range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_range").orderBy("_key")
    return (in_batches(rows, dealt, schema)
            .withColumn("_at", F.row_number().over(within) - 1)
            .join(starts, ["shard", "_range"])
            .select(*docs.columns, "shard", (F.col("_start") + F.col("_at")).alias("slot")))


def _range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    """The equal range of a random 63-bit key."""
    return ((key >> 31) * ranges) >> 32
