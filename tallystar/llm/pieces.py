"""The split before the merges: pieces of a text as the byte-level pattern finds them.

The pattern is `public_tokenizers.PATTERN`. Its alternatives tell only four kinds of characters
apart, so where pieces begin is found for many texts at once, over the bytes of all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Entries after which a task's table of known pieces is begun anew: bounds its memory only.
CACHE_PIECES = 1_200_000
#: Bytes whose characters beyond ASCII are decoded at once.
_DECODED = 1 << 20
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            out[ord(found[0][0]):ord(found[0][-1]) + 1] = kind
    return out


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    kinds = _kinds()
    out = kinds[:256][data]
    for a in range(0, len(data), _DECODED):
        lead = a + np.flatnonzero(data[a:a + _DECODED] >= 0xC0)
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = data[lead] & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            point[more] = (point[more] << 6) | (data[lead[more] + k] & 0x3F)
        found = kinds[point]
        for k in range(4):
            more = size > k
            out[lead[more] + k] = found[more]
    return out


def _cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in the texts that lie between the bounds, and where the last one ends.

    Pieces are runs of one kind, with three exceptions: of white space before another kind the
    last character stands alone; if that is a blank, it belongs to the run that it precedes;
    and a contraction is a piece if its apostrophe begins one.
    """
    n, kind = len(data), _kinds_of(data)
    text = np.zeros(n, bool)
    text[bounds[bounds < n]] = True
    first = text.copy()
    first[1:] |= kind[1:] != kind[:-1]

    space = kind == _SPACE
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~text[1:]) + 1
    last = after - 1
    while len(inside := np.flatnonzero(data[last] & 0xC0 == 0x80)):
        last[inside] -= 1
    first[last] = True
    first[after[data[last] == ord(" ")]] = False

    mark = np.flatnonzero((data == ord("'")) & first)
    end = bounds[np.searchsorted(bounds, mark, "right")]
    one, two = (np.where(mark + k < end, data[np.minimum(mark + k, n - 1)], 0).astype(np.int64)
                for k in (1, 2))
    long = np.isin(one << 8 | two, [a << 8 | b for a, b in (b"re", b"ve", b"ll")])
    whole = long | np.isin(one, list(b"stmd"))
    first[mark[whole] + 1] = False
    rest = (mark + 2 + long)[whole]
    first[rest[rest < end[whole]]] = True
    return np.append(np.flatnonzero(first), n)


def _pieces(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of all texts, and how many of them lie before each text and before the end."""
    column = pa.array(texts, pa.large_string())
    _, offsets, held = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[:len(texts) + 1]
    if not len(texts) or not bounds[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    cuts = _cuts(np.frombuffer(held, np.uint8)[:bounds[-1]], bounds)
    return (pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), held),
            np.searchsorted(cuts, bounds))


def split(text: str) -> list[str]:
    """The matches of `public_tokenizers.PATTERN` in order; together they are the text."""
    return _pieces([text])[0].to_pylist()


class PieceTable:
    """Known pieces with their packed ids; unknown ones are encoded many at a time."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self._encode = encode
        self.forget()

    def forget(self) -> None:
        """Drop the known pieces: a worker that stays after its task would keep them."""
        self._known, self._ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        pieces, before = _pieces(texts)
        coded = pieces.dictionary_encode()
        ids = self._of_distinct(coded.dictionary).take(coded.indices)
        _, offsets, held = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[before].tolist() if len(ids) else [0] * len(before)
        data = memoryview(held or b"")
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def _of_distinct(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        place = pc.index_in(pieces, value_set=self._known)
        missing = pieces.filter(place.is_null())
        if not len(missing):
            return self._ids.take(place)
        new = pa.array(list(self._encode(missing.to_pylist())), pa.large_binary())
        order = place.is_null().to_numpy(zero_copy_only=False).cumsum() + (len(self._known) - 1)
        known, ids = (pa.concat_arrays(x) for x in ((self._known, missing), (self._ids, new)))
        found = ids.take(pc.coalesce(place.cast(pa.int64()), pa.array(order, pa.int64())))
        if len(known) > CACHE_PIECES:                     # frequent pieces are among these
            known, ids = (pa.concat_arrays([x[:CACHE_PIECES]]) for x in (pieces, found))
        self._known, self._ids = known, ids
        return found
