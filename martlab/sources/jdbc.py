"""Read-only queries on databases as partitioned reads, and the load into a catalog table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .guard import bind_parameters, check_select, split_with
from .tables import MODES, qualified, write_table

# JDBC driver classes.
DRIVERS = {"postgres": "org.postgresql.Driver", "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver"}
SNOWFLAKE_REQUIRED = ("sfURL", "sfUser", "sfPassword", "sfDatabase", "sfSchema", "sfWarehouse")


@dataclass(frozen=True)
class Source:
    """Where a query runs: a dialect, its address and further reader options such as user and password."""

    dialect: str
    url: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    def __repr__(self) -> str:  # options hold credentials
        return f"Source({self.dialect!r}, {self.url!r})"


@dataclass(frozen=True)
class Split:
    """How a read is divided: a numeric, date or timestamp column, its range and the number of parts.

    The bounds only place the cuts; rows outside them, and rows with NULL, are still read.
    """

    column: str
    lower: str | int
    upper: str | int
    parts: int


def reader_options(
    source: Source,
    query: str,
    params: Mapping[str, Any] | None = None,
    *,
    chunk_size: int = 100_000,
    split: Split | None = None,
) -> tuple[str, dict[str, str]]:
    """Data source format and options for a checked query. The query runs on the source, so it filters there.

    `chunk_size` is the number of rows per round trip of each task. Without `split` a single task reads the result.
    """
    if chunk_size <= 0:
        raise ValueError(f"a round trip fetches one row or more, not {chunk_size}")
    text = bind_parameters(check_select(query, source.dialect), params, source.dialect)
    if source.dialect == "snowflake":
        missing = [k for k in SNOWFLAKE_REQUIRED if not source.options.get(k)]
        if missing:
            raise ValueError(f"Missing Snowflake connection values: {', '.join(missing)}")
        # The connector unloads in parallel by itself.
        return "snowflake", {**source.options, "query": text}
    options = {"url": source.url, "fetchsize": str(chunk_size), "driver": DRIVERS[source.dialect], **source.options}
    if source.dialect == "sqlserver":  # takes no WITH inside the brackets Spark puts round a query
        head, text = split_with(text)
        options |= {"prepareQuery": head} if head else {}
    if split is None:
        return "jdbc", {**options, "query": text}
    # Spark allows a partition column with `dbtable` only.
    options |= {
        "dbtable": f"({text}) AS pushed_query",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }
    return "jdbc", options


def read_query(spark: SparkSession, source: Source, query: str, params: Mapping[str, Any] | None = None,
               **how: Any) -> DataFrame:
    kind, options = reader_options(source, query, params, **how)
    return spark.read.format(kind).options(**options).load()


def read_catalog_query(spark: SparkSession, query: str, params: Mapping[str, Any] | None = None,
                       dialect: str = "postgres") -> DataFrame:
    """The same guard and `:name` parameters for a query over catalog tables; Spark binds the values."""
    return spark.sql(check_select(query, dialect), args=dict(params or {}))


def load_query(
    spark: SparkSession,
    source: Source,
    query: str,
    target_table: str,
    params: Mapping[str, Any] | None = None,
    *,
    database: str | None = None,
    if_exists: str = "replace",
    **how: Any,
) -> int:
    """Query result into a catalog table; returns the number of rows. Arguments are checked before connecting."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists is {if_exists!r}, which is none of {MODES}")
    qualified(target_table, database)
    return write_table(
        read_query(spark, source, query, params, **how), target_table, database=database, if_exists=if_exists
    )
