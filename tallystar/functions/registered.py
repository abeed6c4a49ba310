"""The two scalar functions under their SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``clean_string`` and ``calc_prop`` callable from ``spark.sql``."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION clean_string(str STRING) RETURNS STRING
        DETERMINISTIC
        RETURN lower(regexp_replace(str, '[^A-Za-z 0-9]+', ''))
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calc_prop(
            word_count BIGINT, total_words_with_label BIGINT, total_words BIGINT)
        RETURNS DOUBLE
        DETERMINISTIC
        RETURN greatest(
            CAST(word_count + 1 AS DOUBLE) / CAST(total_words_with_label + total_words AS DOUBLE),
            CAST('1e-322' AS DOUBLE))
    """)
