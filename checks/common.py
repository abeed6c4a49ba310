"""Loading of the given tables and plain column types for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.sources.lazy import LazyTables

# The columns of the given tables, declared so that no job has to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

TPCH = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tpch_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables({name: lambda name=name: load(spark, sf_dir, name) for name in TPCH})


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps as dates, which both engines write alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = column.cast("date")
        columns.append(column.alias(field.name))
    return df.select(*columns)
