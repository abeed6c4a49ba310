"""Typed Parquet and CSV tables (IO1, IO3, IO5, IO8-IO12) and the model file (IO6, IO7)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallystar.sources.schemas import MODEL

# Text cells may hold quotes, newlines and outer spaces; all must come back unchanged.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# A missing value is written as nothing and an empty text as "". The reader tells them apart
# only if its null marker is not empty too.
READ_NULL = "\0"
FILE_COLUMN = "_file"
BYTES_PER_FILE = 1 << 27


def read_parquet(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None,
                 where: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table; ``columns`` picks and casts, ``where`` filters.

    Both reach the scan: only the named columns are read and simple predicates prune row
    groups. A declared ``schema`` saves the job that reads it from a file footer.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*(F.col(name).cast(kind).alias(name) for name, kind in columns.items()))
    return df


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table chosen by name at run time: a catalog table or view, or a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def replace_table(df: DataFrame, target: str, folder: str | None = None) -> None:
    """Create or replace a table from a query, at a path or in the catalog.

    A catalog table lies in the warehouse, or in ``folder``; a replaced one that lay in another
    folder leaves its files there.
    """
    writer = df.write.mode("overwrite")
    if "/" in target:
        writer.parquet(target)
    else:
        (writer if folder is None else writer.option("path", folder)).saveAsTable(target)


def _line_bytes(df: DataFrame) -> Column:
    """At least what a row takes in a CSV file: quoted cells, doubled quotes, separators."""
    sizes = [F.octet_length(F.replace(f"`{f.name}`", F.lit('"'), F.lit('""')))
             if isinstance(f.dataType, StringType)
             else F.octet_length(F.col(f"`{f.name}`").cast("string")) + 16 for f in df.schema]
    return sum((F.coalesce(s, F.lit(0)).cast("bigint") + 3 for s in sizes), F.lit(0).cast("bigint"))


def _cut_by_bytes(df: DataFrame, limit: int) -> DataFrame:
    """Number the files of each task in a column of their own, rows in order, by running sums."""
    header = sum(len(c.encode()) + 3 for c in df.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = 0, header
        for batch in batches:
            ends = np.cumsum(batch.column(batch.num_columns - 1).to_numpy())
            files, begin, before = np.empty(len(ends), np.int64), 0, 0
            while begin < len(ends):
                end = int(np.searchsorted(ends, before + limit - held, "right"))
                if end <= begin:                    # the next row does not fit
                    if held > header:
                        file, held = file + 1, header
                        continue
                    end = begin + 1                 # a row above the limit has a file of its own
                files[begin:end] = file
                held += int(ends[end - 1]) - before
                begin, before = end, int(ends[end - 1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(files)], batch.schema.names)

    sized = df.withColumn(FILE_COLUMN, _line_bytes(df))
    return sized.mapInArrow(cut, StructType([*df.schema.fields, sized.schema[FILE_COLUMN]]))


def write_csv(df: DataFrame, path: str, bytes_per_file: int = 0) -> None:
    """A folder of CSV files with headers and no index, one file per task.

    A file with newlines inside cells is read by one task, so ``bytes_per_file`` should cut
    tables of texts into files that one task can read: no file is larger, but for a single row
    that is. No row is shuffled for it.
    """
    if bytes_per_file:
        writer = _cut_by_bytes(df, bytes_per_file).write.partitionBy(FILE_COLUMN)
    else:
        writer = df.write
    writer.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             newlines_in_cells: bool = False) -> DataFrame:
    """A folder of CSV files as ``write_csv`` makes them.

    Without newlines inside cells a large file is split among tasks.
    """
    return (spark.read.schema(schema).options(**CSV_OPTIONS).option("recursiveFileLookup", True)
            .option("nullValue", READ_NULL).option("multiLine", newlines_in_cells).option("mode", "FAILFAST")
            .csv(path))


def convert_to_csv(spark: SparkSession, parquet_path: str, csv_path: str,
                   columns: Sequence[str] | None = None, bytes_per_file: int = 0) -> None:
    """Parquet to CSV, all columns or the named ones."""
    df = spark.read.parquet(parquet_path)
    write_csv(df.select(*columns) if columns else df, csv_path, bytes_per_file)


# The words of a model hold only letters and digits, so no cell is ever quoted; empty and
# null markers are set to what no word can be, so that a word like "null" survives.
MODEL_OPTIONS = {"sep": ";", "header": False, "compression": "none",
                 "nullValue": "\\N", "emptyValue": ""}


def export_model(model: DataFrame, path: str) -> None:
    """The row-function model as uncompressed ``;``-separated files, replacing older ones.

    The label is not used for partitioning and files are written in parallel: a folder of
    parts, not one file.
    """
    model.write.mode("overwrite").options(**MODEL_OPTIONS).csv(path)


def import_model(spark: SparkSession, path: str) -> DataFrame:
    """The model files read back with their types."""
    return spark.read.schema(MODEL).options(**MODEL_OPTIONS).option("mode", "FAILFAST").csv(path)
