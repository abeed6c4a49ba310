"""Scans, conversions and round trips through files in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import SCHEMAS, Query, load, plain
from tallystar.functions.money import exact_sum, hundredths
from tallystar.functions.naming import log_normalised
from tallystar.sources.shared import fresh_path
from tallystar.sources.tables import (BYTES_PER_FILE, read_csv, read_parquet, replace_table,
                                      table, write_csv)


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pick and cast columns of a Parquet file into a table, then read the table."""
    picked = read_parquet(spark, f"{sf_dir}/documents.parquet",
                          {"doc_id": "bigint", "text": "string", "n_chars": "int"},
                          schema=SCHEMAS["documents"])
    path = fresh_path(spark, "ingested")
    replace_table(picked, path)
    return table(spark, path)


def named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by name, twice, and read by a name that is a parameter, through a view."""
    docs = load(spark, sf_dir, "documents")
    name = "documents_by_name"
    replace_table(docs.select("doc_id"), name, fresh_path(spark, "named"))
    replace_table(docs, name, fresh_path(spark, "named"))
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW documents_read AS SELECT * FROM IDENTIFIER(:name)",
              args={"name": name})
    return table(spark, "documents_read").groupBy("lang", "source").agg(
        F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


def log_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", F.round(
        log_normalised(F.col("o_totalprice")), 6).alias("log_price"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with newlines and quotes to CSV and back."""
    docs = load(spark, sf_dir, "documents")
    path = fresh_path(spark, "documents-csv")
    write_csv(docs, path, BYTES_PER_FILE)
    return read_csv(spark, path, docs.schema, newlines_in_cells=True)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table from CSV files that many tasks can share."""
    lines = load(spark, sf_dir, "lineitem")
    path = fresh_path(spark, "lineitem-csv")
    write_csv(lines, path)
    scanned = read_csv(spark, path, lines.schema)
    return plain(scanned.select("l_returnflag", "l_linestatus",
                                hundredths(scanned, "l_extendedprice").alias("price"))
                 .groupBy("l_returnflag", "l_linestatus")
                 .agg(F.count("*").alias("n"), exact_sum("price", 2).alias("sum_price")))


FILTERED = ("l_discount BETWEEN 0.01D AND 0.03D AND l_quantity < 25 "
            "AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01'")


def scan_lines(spark: SparkSession, sf_dir: str, columns: dict[str, str] | None = None,
               where: str | None = None) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet", columns, where, SCHEMAS["lineitem"])


QUERIES: dict[str, Query] = {
    "io_parquet_ingest": ingest,
    "io_named_tables": named_tables,
    "fn_log_normalised": log_prices,
    "io_parquet_csv_roundtrip": csv_round_trip,
    "scan_csv": csv_scan,
    "scan_parquet_full": lambda s, d: plain(scan_lines(s, d)),
    "scan_parquet_projected": lambda s, d: scan_lines(
        s, d, {"l_orderkey": "bigint", "l_extendedprice": "double"}),
    "scan_filtered": lambda s, d: scan_lines(
        s, d, {"l_orderkey": "bigint", "l_discount": "double", "l_extendedprice": "double"},
        FILTERED),
}

ORACLES: dict[str, str] = {
    "io_parquet_ingest": "SELECT doc_id, text, CAST(n_chars AS INTEGER) AS n_chars FROM documents",
    "io_named_tables": """SELECT lang, source, count(*) AS docs,
        CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang, source""",
    "fn_log_normalised": """SELECT o_orderkey, round(ln(o_totalprice + 1e-10::DOUBLE), 6) AS log_price
        FROM orders""",
    "io_parquet_csv_roundtrip": "SELECT * FROM documents",
    "scan_csv": """SELECT l_returnflag, l_linestatus, count(*) AS n,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "scan_parquet_full":
        "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
    "scan_parquet_projected": "SELECT l_orderkey, l_extendedprice FROM lineitem",
    "scan_filtered": """SELECT l_orderkey, l_discount, l_extendedprice FROM lineitem
        WHERE l_discount BETWEEN 0.01::DOUBLE AND 0.03::DOUBLE AND l_quantity < 25
          AND l_shipdate >= TIMESTAMP '1998-01-01'""",
}
