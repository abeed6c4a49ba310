"""Approximate nearest neighbours by collision counting with query-aware windows.

Vectors are scaled to length 1, so that cosine is a matter of distance. Each of many random
lines orders the vectors of a block by their projections. A query looks at a window of each
line around its own projection; a vector collides if it lies in it. Windows grow with the
radius, which is all the rehashing there is. A vector whose collisions reach what 84 % of the
vectors at the radius reach, and more of the nearer ones, is verified on the original vectors; the radius grows until
as many verified vectors as asked for lie within it; past the last radius all are verified.

Every row is indexed, in blocks of bounded size within the tasks; every task reads the
queries, a batch at a time, from a written table; its best rows per query are merged by rank.
Vectors that are null, zero, or hold null or non-finite components take no part, neither do
rows without an id; a query meets vectors of its own length only. Rows that repeat an id with
the same score count once, and a row with the query's id is never its neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import filesystem, in_batches
from tallystar.sources.shared import fresh_path

BLOCK_ROWS = 1 << 14
QUERY_ROWS = 2048
#: Wider than what the order of addition changes in a cosine.
NEAR_TIE = 1e-9
#: Half-width of a window per unit of radius, and the radii in turn.
HALF_WIDTH = 1.1
#: Standard deviations by which a vector at the radius may fall short of its mean collisions.
SLACK = 1.0
RADII = (0.3, 0.7, 1.0, 1.15, 1.25, 1.35, 1.45)


def _vectors(ids: pa.Array, column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length, the ids and vectors that take part."""
    found: dict[int, tuple[list, list]] = {}
    for name, vector in zip(ids.to_pylist(), column):
        if name is None or not vector.is_valid or vector.values.null_count:
            continue
        values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if len(values) and np.isfinite(values).all() and values.any():
            held = found.setdefault(len(values), ([], []))
            held[0].append(name)
            held[1].append(values)
    return {n: (np.array(a, np.int64), np.stack(b)) for n, (a, b) in found.items()}


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # so that squares neither over- nor underflow
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(1))


def cosine(query: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (vectors @ query) / (lengths * math.sqrt(query @ query))


def exact_cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The cosine with sums in one order, whatever rows stand beside a vector.

    A matrix product adds in an order that depends on the number of rows, so that equal
    vectors may differ in the last bit.
    """
    product, square, own = np.zeros(len(vectors)), np.zeros(len(vectors)), 0.0
    for value, column in zip(query.tolist(), vectors.T):
        product += column * value
        square += column * column
        own += value * value
    return product / (np.sqrt(square) * math.sqrt(own))


class Index:
    """The lines of one block of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lines: int, seed: int):
        self.ids, self.vectors, self.lengths = ids, vectors, norms(vectors)
        self.distinct = len(np.unique(ids)) == len(ids)
        random = np.random.default_rng([seed, vectors.shape[1]])
        self.lines = random.standard_normal((vectors.shape[1], lines))
        values = (_unit(vectors) @ self.lines).T
        self.order = np.argsort(values, axis=1).astype(np.int32)
        self.values = np.sort(values, axis=1)
        inside = math.erf(HALF_WIDTH / math.sqrt(2))  # a vector at the radius collides so often
        self.threshold = math.floor(lines * inside - SLACK * math.sqrt(lines * inside * (1 - inside)))

    def windows(self, queries: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each query's window on each line."""
        at = _unit(queries) @ self.lines
        half = HALF_WIDTH * radius
        pairs = [(np.searchsorted(v, at[:, j] - half), np.searchsorted(v, at[:, j] + half, "right"))
                 for j, v in enumerate(self.values)]
        return np.stack([a for a, _ in pairs], 1), np.stack([b for _, b in pairs], 1)

    def search(self, names: np.ndarray, queries: np.ndarray, k: int
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of the k best that were found, or of all if there are fewer."""
        windows = [self.windows(queries, radius) for radius in RADII]
        for i, name in enumerate(names.tolist()):
            open_rows = self.ids != name                     # not verified yet
            score = np.full(len(self.ids), -np.inf)
            count = np.zeros(len(self.ids), np.int64)
            before = windows[0][0][i], windows[0][0][i]      # nothing yet

            def verify(rows: np.ndarray) -> None:
                score[rows] = cosine(queries[i], self.vectors[rows], self.lengths[rows])
                open_rows[rows] = False

            for radius, (low, high) in zip(RADII, windows):
                # Only what the window has grown by is counted.
                ends = zip(self.order, low[i].tolist(), before[0].tolist(), before[1].tolist(),
                           high[i].tolist())
                grown = [part for o, a, b, c, d in ends for part in (o[a:b], o[c:d])]
                count += np.bincount(np.concatenate(grown), minlength=len(count))
                before = low[i], high[i]
                verify(np.flatnonzero((count >= self.threshold) & open_rows))
                # A vector at the radius has this cosine.
                if np.count_nonzero(score >= 1 - radius * radius / 2) >= k:
                    break
            else:
                verify(np.flatnonzero(open_rows))            # the windows span everything
            hit = np.flatnonzero(score > -np.inf)
            if self.distinct and len(hit) > k:               # what may tie with the k-th stays
                hit = hit[score[hit] >= np.partition(score[hit], -k)[-k] - NEAR_TIE]
            score = exact_cosine(queries[i], self.vectors[hit])
            ids = self.ids[hit]
            best = np.lexsort((ids, -score))
            ids, score = ids[best], score[best]
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
            yield name, ids[new][:k], score[new][:k]


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", lines: int = 192, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, ties to the smaller id."""
    spark = vectors.sparkSession
    columns = [F.col(id_col).cast("long").alias("id"),
               F.col(vector_col).cast("array<double>").alias("vector")]
    path = fresh_path(spark, "queries")
    queries.select(*columns).where("id IS NOT NULL").dropDuplicates(["id"]).write.parquet(path)

    def searched(batches):
        fs, root = filesystem(path)
        parts = sorted(f.path for f in fs.get_file_info(FileSelector(root))
                       if f.base_name.endswith(".parquet"))
        for block in _blocks(batches):
            for size, (ids, values) in _vectors(*block).items():
                index = Index(ids, values, lines, seed)
                for part in parts:
                    with fs.open_input_file(part) as source:
                        for held in pq.ParquetFile(source).iter_batches(QUERY_ROWS):
                            own = _vectors(held.column("id"), held.column("vector")).get(size)
                            rows = list(index.search(*own, k)) if own else []
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.repeat([r[0] for r in rows],
                                                    [len(r[1]) for r in rows]).astype(np.int64)),
                                 pa.array(np.concatenate([np.empty(0, np.int64), *(r[1] for r in rows)])),
                                 pa.array(np.concatenate([np.empty(0), *(r[2] for r in rows)]))],
                                ["query_id", "vec_id", "score"])

    found = in_batches(vectors.select(*columns), searched,
                       "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and vectors of at most BLOCK_ROWS rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(a, BLOCK_ROWS)
            if held and sum(b.num_rows for b in held) + part.num_rows > BLOCK_ROWS:
                yield _joined(held)
                held = []
            held.append(part)
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    rows = pa.Table.from_batches(held).combine_chunks()
    return rows["id"].combine_chunks(), rows["vector"].combine_chunks()
