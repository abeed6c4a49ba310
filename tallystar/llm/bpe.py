"""Byte-level BPE with merges chosen by a segment tree, and the way back.

Each piece of a text is a row of byte positions. The leaves of its segment tree hold the rank
of the pair that begins at a live position (or none), packed with the position, so the root
is the leftmost pair of the least rank. A merge kills the right position, and updates the
leaves of the merged pair and of its left neighbour along their paths to the root. All pieces
of a batch whose trees have the same width merge in step, one numpy operation for all; the few
of a rare width, very long ones above all, merge one after the other by plain updates.

Null texts count as empty and give no ids. Decoding returns the exact bytes of the text.
Repeated rows are encoded alike; only the named id and text columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import chunks, in_batches
from tallystar.llm.pieces import PieceTable

CHUNK_BYTES = 2_000_000
_NONE = np.int64(1) << 62
_POSITION_BITS = 32
#: Pieces of one width from which a step for all of them costs less than a step for each.
IN_STEP = 32


class Vocabulary:
    """Ranks by token bytes, and for every pair of tokens whose bytes join to a token, its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        pairs = {(ranks[t[:i]] << 32) | ranks[t[i:]]: rank
                 for t, rank in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks}
        self._keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self._ranks = np.fromiter((pairs[k] for k in self._keys.tolist()), np.int64, len(pairs))
        self._bytes = np.fromiter((ranks[bytes([b])] for b in range(256)), np.int64, 256)
        self.packed_tokens = [np.uint32(i).tobytes() for i in range(len(self.tokens))]

    @staticmethod
    @cache
    def load(path: str) -> Vocabulary:
        """From a file with a base64 token and its rank per line."""
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece: its own token if there is one, else its merges."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[tuple[int, bytes]]] = {}
        for i, piece in enumerate(pieces):
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                out[i] = self.packed_tokens[rank]
            else:
                width = max(4, 1 << (len(data) - 1).bit_length())
                by_width.setdefault(width, []).append((i, data))
        for width, group in by_width.items():
            if len(group) < IN_STEP:
                for i, data in group:
                    out[i] = self._merge_one(data, width)
                continue
            step = max(1, 4_000_000 // width)              # bounds the memory of one forest
            for a in range(0, len(group), step):
                part = group[a:a + step]
                for (i, _), ids in zip(part, self._merge([d for _, d in part], width)):
                    out[i] = ids
        return out

    def _merge(self, rows: list[bytes], width: int) -> Iterable[bytes]:
        n, lengths = len(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8)
        ids = self._bytes[data].reshape(n, width)
        place = np.arange(width)
        live = place < lengths[:, None]
        after = np.where(place + 1 < lengths[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        has_pair = after >= 0
        leaves = np.full((n, width), _NONE)
        r, p = np.nonzero(has_pair)
        rank = self.pair_ranks(ids[r, p], ids[r, p + 1])
        leaves[r, p] = np.where(rank < _NONE, (rank << _POSITION_BITS) | p, _NONE)
        tree = [leaves]                                     # leaves first, the root last
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, 0::2], tree[-1][:, 1::2]))

        def update(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            tree[0][row, at] = value
            for low, high in zip(tree, tree[1:]):
                at = at >> 1
                high[row, at] = np.minimum(low[row, 2 * at], low[row, 2 * at + 1])

        def pair_leaf(row: np.ndarray, at: np.ndarray) -> np.ndarray:
            nxt = after[row, at]
            rank = self.pair_ranks(ids[row, at], ids[row, nxt])
            return np.where((nxt >= 0) & (rank < _NONE), (rank << _POSITION_BITS) | at, _NONE)

        row = np.nonzero(tree[-1][:, 0] < _NONE)[0]
        while len(row):
            best = tree[-1][row, 0]
            at = best & ((1 << _POSITION_BITS) - 1)
            gone = after[row, at]
            ids[row, at] = best >> _POSITION_BITS
            live[row, gone] = False
            nxt = after[row, gone]
            after[row, at] = nxt
            some = nxt >= 0
            before[row[some], nxt[some]] = at[some]
            update(row, gone, np.full(len(row), _NONE))
            update(row, at, pair_leaf(row, at))
            prev = before[row, at]
            some = prev >= 0
            update(row[some], prev[some], pair_leaf(row[some], prev[some]))
            row = row[tree[-1][row, 0] < _NONE]
        flat, counts = ids[live].astype("<u4").tobytes(), live.sum(1)
        ends = np.cumsum(counts) * 4
        return (flat[b - 4 * c:b] for b, c in zip(ends.tolist(), counts.tolist()))

    def _merge_one(self, data: bytes, width: int) -> bytes:
        """The merges of one piece; node i has the children 2i and 2i + 1, the leaves come last."""
        n, ranks, tokens, none = len(data), self.ranks, self.tokens, int(_NONE)
        first = self._bytes[np.frombuffer(data, np.uint8)]
        pairs = self.pair_ranks(first[:-1], first[1:])
        leaves = np.full(width, _NONE)
        leaves[:n - 1] = np.where(pairs < _NONE, (pairs << _POSITION_BITS) | np.arange(n - 1), _NONE)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][0::2], levels[-1][1::2]))
        tree = [none, *np.concatenate(levels[::-1]).tolist()]
        ids = first.tolist()
        after, before = [*range(1, n), -1], list(range(-1, n - 1))

        def update(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            while node > 1:
                other, node = tree[node ^ 1], node >> 1
                if other < value:
                    value = other
                if tree[node] == value:
                    return                                 # nothing changes further up
                tree[node] = value

        def pair_leaf(at: int) -> int:
            if (nxt := after[at]) < 0:
                return none
            rank = ranks.get(tokens[ids[at]] + tokens[ids[nxt]])
            return none if rank is None else (rank << _POSITION_BITS) | at

        low = (1 << _POSITION_BITS) - 1
        while (best := tree[1]) < none:
            at = best & low
            gone = after[at]
            ids[at], ids[gone] = best >> _POSITION_BITS, -1
            after[at] = nxt = after[gone]
            if nxt >= 0:
                before[nxt] = at
            update(gone, none)
            update(at, pair_leaf(at))
            if (prev := before[at]) >= 0:
                update(prev, pair_leaf(prev))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@cache
def _encoder(path: str) -> PieceTable:
    return PieceTable(Vocabulary.load(path).encode_pieces)


def encode(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids) per row; ids are packed as little-endian unsigned 32-bit integers."""
    kind = docs.schema[id_col].dataType.simpleString()

    def encoded(batches):
        table = _encoder(ranks_path)
        for batch in batches:
            for start, texts in chunks(batch.column(1), CHUNK_BYTES):
                ids = table.packed([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(ids)), pa.array(ids, pa.binary())],
                    ["id", "ids"])
        table.forget()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (in_batches(texts, encoded, f"id {kind}, ids binary")
            .select(F.col("id").alias(id_col), "ids"))


def decode(encoded: DataFrame, ranks_path: str, *, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(id, ids, text) per row; text holds the decoded bytes."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def decoded(batches):
        vocabulary = Vocabulary.load(ranks_path)
        for batch in batches:
            for start, ids in chunks(batch.column(1), CHUNK_BYTES):
                texts = [vocabulary.decode(x or b"") for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, len(ids)) for c in batch.columns),
                     pa.array(texts, pa.binary())], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return (in_batches(rows, decoded, f"id {kind}, ids binary, text binary")
            .select(F.col("id").alias(id_col), "ids", "text"))


def round_trip(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, ids, text) per row: `decode(encode(docs))` in one pass, with one vocabulary a worker."""
    kind = docs.schema[id_col].dataType.simpleString()

    def both(batches):
        table, vocabulary = _encoder(ranks_path), Vocabulary.load(ranks_path)
        for batch in batches:
            for start, texts in chunks(batch.column(1), CHUNK_BYTES):
                ids = table.packed([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(ids)), pa.array(ids, pa.binary()),
                     pa.array(list(map(vocabulary.decode, ids)), pa.binary())],
                    ["id", "ids", "text"])
        table.forget()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (in_batches(texts, both, f"id {kind}, ids binary, text binary")
            .select(F.col("id").alias(id_col), "ids", "text"))


def digests(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Encode and decode; per row the number of ids and the SHA-256 of ids and decoded bytes."""
    back = decode(encode(docs, ranks_path, id_col=id_col, text_col=text_col), ranks_path,
                  id_col=id_col)
    return back.select(F.col(id_col),
                       (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
