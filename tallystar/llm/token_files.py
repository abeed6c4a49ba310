"""Token ids in binary files: one zstandard frame per document and a shared dictionary.

A file holds, in this order: 8 bytes of magic, the SHA-256 of the dictionary, the bytes per
id; one frame per document (its ids, little-endian unsigned, compressed with the dictionary);
per document its id, whether that is not null, the offset and length of its frame and its
number of ids; and the offset of this index with the number of documents. The dictionary lies
beside the files. A reader of one short document reads the index and that frame only.

Rows are written in ascending order of the integer id (nulls first; rows with one id in the
order of their texts' hashes): ranges of ids are sorted, encoded and written by one task each.
The running count of ids per file gives every document's place in the whole sequence. Null
and empty texts have the end id only; repeated rows are written as often as they are there.
The string of an added token in a text has that token's id, as the library gives it.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallystar.llm.common import SharedFile, chunks, filesystem, in_batches, written
from tallystar.llm.pieces import PieceTable

MAGIC = b"TOKENS01"
# Frames without magic, dictionary id and size: the file's head and index have all three.
_FORMAT = zstandard.FORMAT_ZSTD1_MAGICLESS
_HEAD = struct.Struct("<8s32sB")
_TAIL = struct.Struct("<QQ")
_ENTRY = np.dtype([("id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("length", "<u8"),
                   ("ids", "<u8")])
FILE_BYTES = 1 << 28
READ_BYTES = 1 << 22
CHUNK_BYTES = 12_000_000
#: Pieces that the library encodes as one text.
JOINED = 256
#: Bounds of the sample on which the dictionary is trained: documents, and bytes of each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 600, 1 << 14, 1 << 16


@cache
def _encoder(path: str) -> PieceTable:
    """The tokenizer's ids of single pieces; its own split would find each as it is."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True            # no piece is an added token

    # A token is written with one character per byte, so its length tells where a piece ends.
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    sizes[list(vocabulary.values())] = list(map(len, vocabulary))

    def encode(pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        # The split begins anew at a space before a letter or number, so such pieces go many to a call.
        rest = [i for i, p in enumerate(pieces) if p[0] != " " or not p[1:].isalnum()]
        words = np.delete(np.arange(len(pieces)), rest).tolist()
        for a in range(0, len(words), 40 * JOINED):
            run = words[a:a + 40 * JOINED]
            text = [pieces[i] for i in run]
            found = tokenizer.encode_batch_fast(
                ["".join(text[k:k + JOINED]) for k in range(0, len(text), JOINED)],
                add_special_tokens=False)
            ids = np.array(list(chain.from_iterable(f.ids for f in found)), "<u4")
            packed, ends = ids.tobytes(), np.cumsum(sizes[ids])
            piece_ends = np.cumsum([len(p.encode()) for p in text])
            cuts = np.searchsorted(ends, piece_ends, "right")
            if not len(ids) or not np.array_equal(ends[cuts - 1], piece_ends):
                rest += run                               # not in bytes: each by itself
                continue
            begin = 0
            for i, end in zip(run, (4 * cuts).tolist()):
                out[i] = packed[begin:end]
                begin = end
        for a in range(0, len(rest), 20_000):
            some = rest[a:a + 20_000]
            for i, found in zip(some, tokenizer.encode_batch_fast(
                    [pieces[i] for i in some], add_special_tokens=False)):
                out[i] = np.array(found.ids, "<u4").tobytes()
        return out

    return PieceTable(encode)


@cache
def _added(path: str) -> tuple[re.Pattern | None, dict[str, bytes], Tokenizer | None]:
    """The added tokens as a pattern, their packed ids, and the library if it must find them."""
    tokenizer = Tokenizer.from_file(path)
    tokens = tokenizer.get_added_tokens_decoder()
    if not tokens:
        return None, {}, None
    longest_first = sorted((t.content for t in tokens.values()), key=len, reverse=True)
    plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values())
    return (re.compile(f"({'|'.join(map(re.escape, longest_first))})"),
            {t.content: np.uint32(i).tobytes() for i, t in tokens.items()},
            None if plain else tokenizer)


def encode_documents(path: str, texts: list[str | None], end_id: int) -> list[np.ndarray]:
    """The ids the library gives each text, its added tokens found first, and the end id."""
    pattern, known, library = _added(path)
    texts = [t or "" for t in texts]
    held = [i for i, t in enumerate(texts) if any(name in t for name in known)]
    if not held:
        return encode_texts(path, texts, end_id)
    end = np.uint32(end_id).tobytes()
    if library is not None:
        special = {i: np.array(library.encode(texts[i], add_special_tokens=False).ids,
                               "<u4").tobytes() for i in held}
    else:
        special = {}
        for i in held:
            parts = pattern.split(texts[i])
            parts[::2] = _encoder(path).packed(parts[::2])
            parts[1::2] = map(known.__getitem__, parts[1::2])
            special[i] = b"".join(parts)
    rest = iter(_encoder(path).packed([t for i, t in enumerate(texts) if i not in special]))
    return [np.frombuffer((special[i] if i in special else next(rest)) + end, "<u4")
            for i in range(len(texts))]


def encode_texts(path: str, texts: list[str | None], end_id: int) -> list[np.ndarray]:
    """The ids of each text and the end id; strings of added tokens are plain text here."""
    end = np.uint32(end_id).tobytes()
    return [np.frombuffer(p + end, "<u4") for p in _encoder(path).packed([t or "" for t in texts])]


def train_dictionary(docs: DataFrame, path: str, end_id: int, width: int, *, id_col: str,
                     text_col: str) -> bytes:
    """From the documents whose hashed ids are smallest; empty if there is too little to learn."""
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL")
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sampled(batches):
        for batch in batches:
            for _, part in chunks(batch.column("text"), CHUNK_BYTES):
                ids = encode_documents(path, part, end_id)
                yield pa.RecordBatch.from_arrays([pa.array(
                    [x[:SAMPLE_BYTES // width].astype(f"<u{width}").tobytes() for x in ids],
                    pa.binary())], ["ids"])

    once = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"))
    samples = [r.ids for r in in_batches(once.select("text"), sampled, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class TokenFile:
    """A file that is being written."""

    def __init__(self, folder: str, dictionary: bytes, width: int):
        self.file = SharedFile(folder, ".tokens")
        self.file.write(_HEAD.pack(MAGIC, hashlib.sha256(dictionary).digest(), width))
        self._entries: list[tuple] = []
        self._pack = zstandard.ZstdCompressor(
            dict_data=_dictionary(dictionary),
            compression_params=zstandard.ZstdCompressionParameters.from_level(
                3, format=_FORMAT, write_dict_id=False, write_content_size=False))
        self._width, self.ids = width, 0

    def add(self, name: int | None, ids: np.ndarray) -> None:
        frame = self._pack.compress(ids.astype(f"<u{self._width}").tobytes())
        offset = self.file.write(frame)
        self._entries.append((name or 0, name is not None, offset, len(frame), len(ids)))
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        offset = self.file.write(np.array(self._entries, _ENTRY).tobytes())
        self.file.write(_TAIL.pack(offset, len(self._entries)))
        self.file.close()
        return self.file.name, len(self._entries), self.ids


def write(docs: DataFrame, folder: str, tokenizer_path: str, *, id_col: str = "doc_id",
          text_col: str = "text", end_id: int = 2) -> DataFrame:
    """Write the files; returns (file, documents, ids, start) per file, in order of the ids."""
    spark = docs.sparkSession
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer_path, end_id, width, id_col=id_col,
                                  text_col=text_col)
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    held = spark.sparkContext.broadcast(dictionary)   # DICTIONARY_BYTES at most

    def encoded(batches):
        out, order, done = None, 0, []
        for batch in batches:
            for start, texts in chunks(batch.column("text"), CHUNK_BYTES):
                names = batch.column("id").slice(start, len(texts)).to_pylist()
                for name, ids in zip(names, encode_documents(tokenizer_path, texts, end_id)):
                    out = out or TokenFile(folder, held.value, width)
                    out.add(name, ids)
                    if out.file.size >= FILE_BYTES:
                        done.append((order, *out.close()))
                        out, order = None, order + 1
        if out is not None:
            done.append((order, *out.close()))
        part = TaskContext.get().partitionId()
        columns = list(zip(*((part, *d) for d in done))) or [[]] * 5
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["part", "seq", "file", "documents", "ids"])

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .withColumn("tie", F.xxhash64("text")))
    ordered = ordered.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    files = written(in_batches(ordered.select("id", "text"), encoded,
                               "part int, seq int, file string, documents long, ids long"),
                    "token-files").orderBy("part", "seq").toArrow()  # one row per file
    ids = files["ids"].to_numpy()
    rows = list(zip(files["file"].to_pylist(), files["documents"].to_pylist(), ids.tolist(),
                    (np.cumsum(ids) - ids).tolist()))
    return spark.createDataFrame(rows, "file string, documents long, ids long, start long")


def open_index(source) -> tuple[np.ndarray, bytes, int]:
    """(index entries, hash of the dictionary, bytes per id) of an open file."""
    magic, name, width = _HEAD.unpack(source.read_at(_HEAD.size, 0))
    if magic != MAGIC:
        raise ValueError("not a token file")
    size = source.size()
    offset, count = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
    return np.frombuffer(source.read_at(count * _ENTRY.itemsize, offset), _ENTRY), name, width


def _unpacker(fs, root: str, name: bytes) -> zstandard.ZstdDecompressor:
    with fs.open_input_file(f"{root}/dictionary") as source:
        dictionary = source.read()
    if hashlib.sha256(dictionary).digest() != name:
        raise ValueError("the dictionary beside the file is not the one it was written with")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary), format=_FORMAT)


def read_document(folder: str, file: str, place: int) -> np.ndarray:
    """The ids of one document by its place in a file: reads the index and one frame."""
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{file}") as source:
        entries, name, width = open_index(source)
        entry = entries[place]
        frame = source.read_at(int(entry["length"]), int(entry["offset"]))
        data = _unpacker(fs, root, name).decompress(frame, int(entry["ids"]) * width)
    return np.frombuffer(data, f"<u{width}").astype("<u4")


def read(files: DataFrame, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids) per document; ids packed as unsigned 32-bit integers."""
    def documents(batches):
        fs, root = filesystem(folder)
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(),
                                   batch.column("start").to_pylist()):
                with fs.open_input_file(f"{root}/{file}") as source:
                    entries, name, width = open_index(source)
                    unpacker = _unpacker(fs, root, name)
                    counts = entries["ids"].astype(np.int64)
                    starts = first + np.cumsum(counts) - counts
                    ends = (entries["offset"] + entries["length"]).astype(np.int64)
                    a = 0
                    while a < len(entries):
                        begin = int(entries["offset"][a])
                        b = max(a + 1, int(np.searchsorted(ends, begin + READ_BYTES, "right")))
                        data = source.read_at(int(ends[b - 1]) - begin, begin)
                        ids = [np.frombuffer(unpacker.decompress(data[o - begin:o - begin + n],
                                                                 k * width),
                                             f"<u{width}").astype("<u4").tobytes()
                               for o, n, k in zip(*(entries[c][a:b].tolist()
                                                    for c in ("offset", "length", "ids")))]
                        names = [x if k else None for x, k in zip(
                            entries["id"][a:b].tolist(), entries["known"][a:b].tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names, pa.int64()), pa.array(starts[a:b], pa.int64()),
                             pa.array(entries["ids"][a:b].astype(np.int64)),
                             pa.array(ids, pa.binary())], ["id", "start", "n_tokens", "ids"])
                        a = b

    spread = files.select("file", "start").repartition(max(1, files.count()), "file")
    return in_batches(spread, documents, "id long, start long, n_tokens long, ids binary")
