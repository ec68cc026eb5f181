"""The column templates that are handy inside `spark.sql`, as temporary SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "month_diff": (
        "(a DATE, b DATE) RETURNS INT RETURN (year(b) - year(a)) * 12 + month(b) - month(a)"
    ),
    "hhmmss": (
        "(s DOUBLE) RETURNS STRING RETURN CASE WHEN s IS NOT NULL THEN format_string('%02d:%02d:%02d', "
        "CAST(round(s) AS BIGINT) DIV 3600, (CAST(round(s) AS BIGINT) % 3600) DIV 60, CAST(round(s) AS BIGINT) % 60) END"
    ),
    "safe_pct": (
        "(part DOUBLE, whole DOUBLE) RETURNS DOUBLE RETURN round(try_divide(part * 100, whole), 2)"
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return list(SQL_FUNCTIONS)
