"""Cleaning and counting of words on Arrow batches, as ``text`` does on columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallystar.functions.text import DROPPED_CHARS

# Bytes of text that are split at once: words and their counts take many times as much.
SLICE_BYTES = 4_000_000


def cleaned(texts: pa.Array) -> pa.Array:
    """``functions.text.clean`` on an Arrow array."""
    return pc.ascii_lower(pc.replace_substring_regex(texts, DROPPED_CHARS, ""))


def slices(rows: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in runs of about SLICE_BYTES of text, one row at least: what a worker takes apart."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(rows.column(text)), 0).cast(
        pa.int64())).to_numpy()
    begin = 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(ends.searchsorted(before + SLICE_BYTES, "right")))
        yield rows.slice(begin, end - begin)
        begin = end


def row_words(rows: pa.RecordBatch) -> pa.Table:
    """(doc_id, value, tf): how often each word occurs in each row of ``(doc_id, text)``."""
    split = pc.split_pattern(pc.fill_null(cleaned(rows.column("text")), ""), " ")
    words = pc.list_flatten(split).dictionary_encode()
    row = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    width = max(1, len(words.dictionary))
    cells, tf = np.unique(row * width + words.indices.to_numpy(), return_counts=True)
    row, word = np.divmod(cells, width)
    found = pa.table({"doc_id": rows.column("doc_id").take(pa.array(row)),
                      "value": words.dictionary.take(pa.array(word)), "tf": tf})
    return found.filter(pc.not_equal(found["value"], ""))
