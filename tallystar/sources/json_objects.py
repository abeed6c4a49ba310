"""JSON objects from files that hold an array of them, or one after the other (IO15, IO16, IO18).

The text source cuts a file at every opening brace, so many tasks read a large one. Whether a
block of a file begins inside a string, and how deep in objects, are running sums over the blocks
before it: of quotes, and of braces outside strings for both cases. They take a first pass that
gives one row per block. The second pass cuts each block at the objects of their own, those that
begin at depth 0; only what lies at a block's ends travels to be put together. A compressed file
that Spark cannot cut is one block, which needs no sums and no putting together: it is read once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = ("file", "block")

# Ends of names by which Hadoop knows files that one task must read as a whole.
COMPRESSED = (".gz", ".deflate", ".lz4", ".snappy", ".zst")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(value): the text of every top-level object of every file under the path.

    Commas and brackets of an array and any white space may stand between objects; any other
    text there is an error.
    """
    # Functions that tasks run are nested, so that executors need no copy of this package.
    quote, opening, closing, back = b'"{}\\'
    around = " \t\n\v\f\r,[]"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
        """(columns but the text, bytes) of stretches of blocks, with the braces put back."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, *place = batch.columns[:3]
            code = [column.dictionary_encode().indices.to_numpy() for column in place]
            cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in code], axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
                key = tuple(batch.column(i)[a].as_py() for i in range(1, batch.num_columns))
                # No brace stands before a file's first piece.
                start = b"" if key != last and not any(key[1:2]) else b"{"
                last = key
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([a, b], pa.int32()), texts),
                                        pa.scalar("{", texts.type))
                yield key, start + joined[0].as_buffer()

    def scan(data: bytes, text: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Positions of braces, 1 or -1 for each, whether a string holds it, quotes in all."""
        chars = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((chars == quote) | (chars == opening) | (chars == closing))
        kind = chars[at]
        quotes = kind == quote
        if back in data:
            plain = np.maximum.accumulate(np.where(chars == back, -1, np.arange(len(chars))))
            before = at[quotes] - 1
            run = np.where(before >= 0, before - plain[np.maximum(before, 0)], 0)
            quotes[quotes] = run % 2 == 0
        brace = kind != quote
        held = (np.cumsum(quotes)[brace] + text) % 2 == 1
        return (at[brace], np.where(kind[brace] == opening, 1, -1), held,
                int(np.count_nonzero(quotes)))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, [0, 0, 0]

        def row():
            return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "quotes": sums[0],
                                                "outside": sums[1], "within": sums[2]}])
        for at, data in blocks(batches):
            if at != key:
                if key is not None:
                    yield row()
                key, sums = at, [0, 0, 0]
            _, step, held, quotes = scan(data, sums[0] % 2)
            sums = [sums[0] + quotes, sums[1] + int(step[~held].sum()), sums[2] + int(step[held].sum())]
        if key is not None:
            yield row()

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int | None, pa.Array]]:
        """(block, part, texts): what is at a block's ends (part 0 and 1), objects within it (None).

        The objects are without the white space, commas and brackets that follow them.
        """
        key, open_, part, text, depth = None, [], 0, 0, 0
        for at, data in blocks(batches):
            if at != key:
                if key is not None:
                    yield key, part, pa.array([b"".join(open_)])
                key, open_, part = at, [], 0
                quotes, depth = at[2:] or (0, 0)
                text = quotes % 2
            where, step, held, quotes = scan(data, text)
            where, step = where[~held], step[~held]
            deep = depth + np.cumsum(step)
            begins = where[(step == 1) & (deep == 1)]
            text = (text + quotes) % 2
            depth = int(deep[-1]) if len(deep) else depth
            if not len(begins):
                open_.append(data)
                continue
            open_.append(data[:begins[0]])
            first = pa.array([b"".join(open_)])
            if not part:
                yield key, 0, first
            whole = pa.StringArray.from_buffers(
                len(begins) - 1, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(data))
            whole = pa.concat_arrays([first.view(pa.string())] * part + [whole])
            if len(whole):
                yield key, None, pc.ascii_rtrim(whole, around)
            open_, part = [data[begins[-1]:]], 1
        if key is not None:
            yield key, part, pa.array([b"".join(open_)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Objects that lie in a block, and apart from them what is at its ends."""
        names = ["file", "block", "part", "text", "whole"]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
        for key, part, texts in parted(batches):
            if part is None:
                row = [*(pa.nulls(len(texts), kind) for kind in kinds), texts]
            else:
                row = [pa.array([key[0]]), pa.array([key[1]]), pa.array([part], pa.int32()), texts,
                       pa.nulls(1, pa.string())]
            yield pa.RecordBatch.from_arrays(row, names)

    def cut_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All objects of files that are one block, and as number -1 what stands before them."""
        for _, part, texts in parted(batches):
            number = pa.array(np.full(len(texts), -1 if part == 0 else 0, np.int32))
            if part is not None:
                texts = texts.view(pa.string())
            yield pa.RecordBatch.from_arrays([number, pc.ascii_rtrim(texts, around) if part else texts],
                                             ["object", "text"])

    def at_braces(reader: DataFrameReader) -> DataFrame:
        return reader.option("lineSep", "{").text(path)

    # A hash tells a file from the next one: its path would be longer than most pieces. Spark measures
    # the batch after every row, column by column, so there is no column that is always 0.
    file = F.when(F.expr("input_file_block_start() = 0"), F.xxhash64(F.input_file_name())).otherwise(
        F.raise_error(F.lit("a compressed file was cut")))
    alone = at_braces(spark.read.option("pathGlobFilter", "*{%s}" % ",".join(COMPRESSED))).select(
        F.col("value").alias("text"), file.cast("long").alias("file")).mapInArrow(
        cut_alone, "object int, text string")
    name = F.col("_metadata.file_name")
    cuttable = ~reduce(Column.__or__, (name.endswith(end) for end in COMPRESSED))
    pieces = at_braces(spark.read).where(cuttable).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda name: F.coalesce(F.sum(name).over(before), F.lit(0))
    starts = (pieces.mapInArrow(
        summaries, "file string, block long, quotes long, outside long, within long")
        .withColumn("quoted", earlier("quotes"))
        .withColumn("step", F.when(F.col("quoted") % 2 == 1, F.col("within")).otherwise(F.col("outside")))
        .select(*BLOCK, "quoted", earlier("step").alias("depth")))
    parts = (pieces.join(F.broadcast(starts), list(BLOCK)).select("text", *BLOCK, "quoted", "depth")
             .mapInArrow(cut, "file string, block long, part int, text binary, whole string"))
    # An end belongs to the last object that began in a block before; number -1 is what stands
    # before a file's first object.
    upto = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0)
    ends = parts.where("file IS NOT NULL").withColumn("object", F.coalesce(F.last(
        F.when(F.col("part") == 1, F.col("block")), True).over(upto), F.lit(-1)))
    joined = ends.groupBy("file", "object").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "part", F.col("text").cast("string").alias("text")))),
        lambda piece: piece["text"]), "").alias("text"))
    joined = joined.select("object", F.when(F.col("object") == -1, F.col("text")).otherwise(
        F.regexp_replace("text", r"[\s,\[\]]+$", "")).alias("text"))
    whole = parts.where("whole IS NOT NULL").select(F.lit(0).alias("object"), F.col("whole").alias("text"))
    found = alone.unionAll(whole).unionAll(joined)
    value = F.when(F.col("object") == -1, F.when(
        F.col("text").rlike(r"[^\s\[\],\x{feff}]"), F.raise_error(F.lit("text before an object")))).when(
        ~F.col("text").endswith("}"), F.raise_error(F.lit("text after an object, or an object cut off"))
        ).otherwise(F.col("text"))
    return found.select(value.cast("string").alias("value")).where("value IS NOT NULL")
