"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are normalised to lower-case letters and digits with single spaces between. An item is
cut into overlapping windows of `window` characters (a shorter item is one window). A window
occurs in a document if some stretch of it aligns with at most `budget` of the window's
length in edits. Such an alignment of w characters with k edits keeps at least
w + 1 - q * (k + 1) of the window's q-grams on diagonals at most k apart. So q-grams that
document and item share are counted per item in diagonal bands of width 2k + 1 that overlap
by k; bands that reach the bound in a window are verified by an alignment that leaves a band
of diagonals around them.

Items are taken in blocks of bounded size, one pass over the documents per block, so the
benchmark may be of any size. Null and empty texts, and items with fewer than `min_chars`
normalised characters, match nothing. Repeated rows are judged alike; items with a null id
are used and reported as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallystar.llm.common import in_batches

#: Characters of benchmark items that one broadcast block holds, except for one longer item.
BLOCK_CHARS = 4_000_000
_FILTER_BITS = 22
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _letter_table() -> np.ndarray:
    """Per code point, its lower-case form if that is a letter or digit, a space otherwise."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        low = chr(point).lower()
        if low[0].isalnum():
            out[point] = ord(low[0])
    return out


_table: list[np.ndarray] = []


def normalised(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Code points without repeated or outer spaces, and where each stands in the text."""
    if not _table:
        _table.append(_letter_table())
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    points = _table[0][raw]
    space = points == 32
    keep = ~(space & np.concatenate([[True], space[:-1]]))
    at = np.flatnonzero(keep)
    if len(at) and space[at[-1]]:
        at = at[:-1]
    return points[at], at


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """The hash of the q code points that begin at each place."""
    if len(points) < q:
        return np.empty(0, np.uint64)
    total, length = points.astype(np.uint64), 1
    parts: list[tuple[np.ndarray, int]] = []
    power_of = lambda k: np.uint64(pow(int(_PRIME), k, 1 << 64))
    while True:                                       # by doubling: 1, 2, 4, ... characters
        if q & length:
            parts.append((total, length))
        if length * 2 > q:
            break
        total = total[:-length] * power_of(length) + total[length:]
        length *= 2
    n, out, offset = len(points) - q + 1, None, 0
    for part, size in parts:
        piece, power = part[offset:offset + n], power_of(size)
        out = piece.copy() if out is None else out * power + piece
        offset += size
    out ^= out >> np.uint64(31)
    return out * _PRIME


def align(patterns: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the fewest edits with which the whole pattern occurs in the text, and its end.

    Cells are prefixes of the pattern, one text character a step; an occurrence may begin and
    end anywhere, and of equal edits the first end counts. Rows are aligned in step.
    """
    rows, m = patterns.shape
    steps = np.arange(m + 1, dtype=np.int32)
    column = np.broadcast_to(steps, (rows, m + 1))
    best, ends = np.full(rows, m, np.int32), np.zeros(rows, np.int64)
    for end in range(1, texts.shape[1] + 1):
        cost = np.zeros((rows, m + 1), np.int32)
        np.minimum(column[:, 1:] + 1, column[:, :-1] + (patterns != texts[:, end - 1:end]),
                   out=cost[:, 1:])
        column = np.minimum.accumulate(cost - steps, axis=1) + steps
        better = column[:, m] < best
        best = np.where(better, column[:, m], best)
        ends[better] = end
    return best, ends


def step_of(edits):
    """Bands this far apart, each 2 * edits + 1 wide, hold any edits + 1 adjacent diagonals."""
    return edits + 1


@dataclass
class Items:
    """A block of items with its q-grams in order of their hashes."""

    ids: list
    points: list[np.ndarray]
    q: int
    window: int
    budget: float

    def prepare(self) -> Items:
        own = [grams(p, self.q) for p in self.points]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        hashes = np.concatenate(own) if own else np.empty(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(own)), sizes)[order]
        self.place = (np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        self.member = np.zeros(1 << _FILTER_BITS, bool)
        self.member[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.width = np.array([min(self.window, len(p)) for p in self.points], np.int64)
        edits = np.floor(self.width * self.budget).astype(np.int64)
        # Fewer edits where the lemma would leave no shared q-gram to look for.
        self.edits = np.minimum(edits, self.width // self.q - 1)
        self.least = self.width + 1 - self.q * (self.edits + 1)
        return self

    def occurrences(self, text: str | None, any_hit: bool = False
                    ) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) per item found, in places of the original text.

        The first of the windows with the fewest edits, or any window if that is enough.
        """
        points, origin = normalised(text)
        shared = np.flatnonzero(
            self.member[(h := grams(points, self.q)) >> np.uint64(64 - _FILTER_BITS)])
        if not len(shared) or not len(self.hashes):
            return []
        low = np.searchsorted(self.hashes, h[shared], "left")
        high = np.searchsorted(self.hashes, h[shared], "right")
        times = high - low
        if not times.sum():
            return []
        at = np.repeat(shared, times)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(times) - times - low, times)
        item, place = self.item[entry], self.place[entry]
        enough = np.bincount(item, minlength=len(self.ids)) >= self.least
        item, place, at = item[enough[item]], place[enough[item]], at[enough[item]]
        out: dict[int, tuple[int, int, int, int]] = {}
        for which, diagonal, starts in self._bands(item, place, at) if len(item) else ():
            if which in out and (any_hit or not out[which][3]):
                continue                              # no window has fewer edits
            found = self._verify(which, diagonal, starts, points, origin, any_hit)
            if found and (which not in out or found[3] < out[which][3]):
                out[which] = found
        return list(out.values())

    def _bands(self, item: np.ndarray, place: np.ndarray, at: np.ndarray
               ) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item, least diagonal, starts of the windows that reach the bound) per band."""
        edits, diagonal = self.edits[item], at - place
        step = step_of(edits)                         # bands [b * step, b * step + 2 * edits]
        band = diagonal // step
        lower = diagonal - band * step + step <= 2 * edits  # also in the band before
        item = np.concatenate([item, item[lower]])
        diagonal = np.concatenate([diagonal, diagonal[lower]])
        place = np.concatenate([place, place[lower]])
        band = np.concatenate([band, band[lower] - 1])
        order = np.lexsort((place, band, item))
        item, band, place = item[order], band[order], place[order]
        new = np.concatenate([[True], (item[1:] != item[:-1]) | (band[1:] != band[:-1])
                              | (place[1:] != place[:-1])])
        item, band, place = item[new], band[new], place[new]  # a q-gram of the item counts once
        # The hit `least - 1` further on must be of the same band and within one window.
        ahead = np.arange(len(item)) + self.least[item] - 1
        inside = ahead < len(item)
        ahead = np.minimum(ahead, len(item) - 1)
        hit = np.flatnonzero(inside & (item[ahead] == item) & (band[ahead] == band)
                             & (place[ahead] - place <= self.width[item] - self.q))
        new = np.flatnonzero((item[hit][1:] != item[hit][:-1]) | (band[hit][1:] != band[hit][:-1]))
        for part in np.split(hit, new + 1):
            if len(part):
                k, width = item[part[0]], self.width[item[part[0]]]
                first = np.maximum(0, place[ahead[part]] + self.q - width)
                last = np.minimum(place[part], len(self.points[k]) - width)
                change = np.zeros(len(self.points[k]) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, np.maximum(last + 1, first), -1)
                yield (int(k), int(band[part[0]] * step_of(self.edits[k])),
                       np.flatnonzero(np.cumsum(change) > 0))

    def _verify(self, item: int, diagonal: int, starts: np.ndarray, points: np.ndarray,
                origin: np.ndarray, any_hit: bool) -> tuple[int, int, int, int] | None:
        """The window that aligns with the fewest edits around the band's diagonals, or any."""
        best = None
        width, edits = int(self.width[item]), int(self.edits[item])
        pattern, span = self.points[item], width + 4 * edits + 1
        padded = np.concatenate([np.zeros(span, np.uint32), points, np.zeros(span, np.uint32)])
        for at in np.split(starts, [8, *range(200, len(starts), 500)]):
            begin = np.clip(at + diagonal - edits, -span, len(points))
            windows = pattern[at[:, None] + np.arange(width)]
            texts = padded[(begin + span)[:, None] + np.arange(span)]
            found, ends = align(windows, texts)
            row = int(np.argmax(found <= edits) if any_hit else np.argmin(found)) if len(found) else 0
            if len(found) and found[row] <= (best[3] - 1 if best else edits):
                end = int(ends[row])
                _, back = align(windows[row:row + 1, ::-1], texts[row:row + 1, :end][:, ::-1])
                last = int(begin[row]) + end
                best = (item, int(origin[max(0, last - int(back[0]))]), int(origin[last - 1]) + 1,
                        int(found[row]))
                if any_hit or not best[3]:
                    break
        return best


def blocks(benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text",
           q: int = 10, window: int = 80, budget: float = 0.0625, min_chars: int = 30
           ) -> list[Broadcast]:
    """The benchmark's items as broadcast blocks of at most BLOCK_CHARS, or one longer item."""
    context, out, size = benchmark.sparkSession.sparkContext, [], 0
    ids, points = [], []

    def close():
        if ids:
            out.append(context.broadcast(Items(list(ids), list(points), q, window, budget).prepare()))
        ids.clear()
        points.clear()

    for row in benchmark.select(id_col, text_col).toLocalIterator():
        item, _ = normalised(row[1])
        if len(item) >= max(min_chars, 2 * q):
            if size + len(item) > BLOCK_CHARS:
                close()
                size = 0
            ids.append(row[0])
            points.append(item)
            size += len(item)
    close()
    return out


def occurrences(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id", **parameters) -> DataFrame:
    """(id, item, start, end, edits): per document and item the stretch of fewest edits, the first
    found of several such."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, start long, end long, edits int"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def searching(held: Broadcast):
        def found(batches):
            for batch in batches:
                rows = {}
                for i, text in enumerate(batch.column("text")):
                    for item, start, end, edits in held.value.occurrences(text.as_py()):
                        key = (i, item)
                        if key not in rows or edits < rows[key][2]:
                            rows[key] = (start, end, edits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array([i for i, _ in rows], pa.int64())),
                     pa.array([held.value.ids[j] for _, j in rows]).cast(item_type),
                     *(pa.array([v[k] for v in rows.values()], t)
                       for k, t in enumerate((pa.int64(), pa.int64(), pa.int32())))],
                    ["id", "item", "start", "end", "edits"])
        return found

    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    found = [in_batches(texts, searching(held), schema)
             for held in blocks(benchmark, id_col=item_col, **parameters)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema).toDF(
            id_col, item_col, "start", "end", "edits")
    return reduce(DataFrame.unionAll, found).toDF(id_col, item_col, "start", "end", "edits")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                      item_col: str = "item_id", **parameters) -> DataFrame:
    """The rows, with all their columns, in which no item's window occurs."""
    at = docs.columns.index(text_col)

    def clean(held: Broadcast):
        def kept(batches):
            for batch in batches:
                yield batch.filter(pa.array(
                    [not held.value.occurrences(t.as_py(), any_hit=True) for t in batch.column(at)], pa.bool_()))
        return kept

    for held in blocks(benchmark, id_col=item_col, **parameters):
        docs = in_batches(docs, clean(held), docs.schema)
    return docs
