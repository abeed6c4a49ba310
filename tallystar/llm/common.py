"""What the operators share: given tables, written tables, binary files on the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import os
import posixpath
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

import tallystar
from tallystar.sources.shared import fresh_path

#: Rows that a task takes at least once every core has one.
ROWS_A_TASK = 50_000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the executors, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(tallystar.__file__).parent
        path = os.path.join(tempfile.mkdtemp(prefix="tallystar-"), "tallystar.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, source.relative_to(root.parent))
        context.addPyFile(path)
        _shipped.add(context.applicationId)


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]],
                                                 Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` whose function may use this package on any executor."""
    ship(df.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        released()

    return df.mapInArrow(whole, schema)


def released() -> None:
    """Give free memory back to the system: a worker stays after its task, beside the next ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):     # other C libraries than glibc
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> int:
    """To how many tasks what is made of so many rows may be coalesced: one per core at least.

    A shuffle has as many tasks as the session says, whatever there is to do; where many rounds
    go over few rows, starting these tasks would be most of the work. Large tables keep them all.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_a_task))


def chunks(column: pa.Array, chunk_bytes: int) -> Iterator[tuple[int, list]]:
    """(position of the first, values) of slices with about `chunk_bytes` each, one value at least."""
    start, held, size = 0, [], 0
    for i, value in enumerate(column):
        held.append(value.as_py())
        size += len(held[-1]) if held[-1] is not None else 0
        if size >= chunk_bytes:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder given by URI or plain path, and the path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(folder)
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


class SharedFile:
    """A binary file that appears under its name only when it is closed.

    Every attempt of a task writes a name of its own, so a lost or repeated attempt leaves
    at most a file that no index names.
    """

    def __init__(self, folder: str, suffix: str):
        self.fs, root = filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self._path = posixpath.join(root, self.name)
        self._out = self.fs.open_output_stream(f"{self._path}.part", compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; returns the offset at which the data begins."""
        self._out.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        self._out.close()
        self.fs.move(f"{self._path}.part", self._path)
