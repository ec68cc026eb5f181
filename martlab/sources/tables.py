"""Catalog tables: scans, writes with replace/append/fail, views and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .guard import check_identifier

MODES = ("replace", "append", "fail")


def qualified(name: str, database: str | None = None) -> str:
    """`database.table` from a plain or a dotted name, each part checked."""
    parts = name.split(".") if database is None else [database, name]
    if len(parts) > 2:
        raise ValueError("use a table name or database.table")
    return ".".join(check_identifier(p) for p in parts)


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(qualified(name, database))


def write_table(
    df: DataFrame,
    name: str,
    *,
    database: str | None = None,
    if_exists: str = "replace",
    by_name: bool = False,
    partition_by: tuple[str, ...] = (),
    bucket_by: tuple[int, str] | None = None,
    file_format: str = "parquet",
) -> int:
    """Write a frame to a catalog table and return the number of rows written.

    replace: the rows go to a staging table first, which then takes the name, so a failed job leaves the old table as
    it was; an empty frame replaces it by an empty table. append: inserts by position, or by name with `by_name`, and
    creates the table when absent. fail: raises when the table is present. Rows are counted while they are written.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists is {if_exists!r}, which is none of {MODES}")
    spark, target = df.sparkSession, qualified(name, database)
    if "." in target:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.split('.')[0]}")
    present = spark.catalog.tableExists(target)
    if present and if_exists == "fail":
        raise ValueError(f"a table {target} already exists, and if_exists is 'fail'")

    # One uncut key keeps the count apart from other observations in the plan.
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if present and if_exists == "append":
        columns = spark.table(target).columns
        if by_name:
            counted = counted.select(*columns)
        elif len(columns) != len(df.columns):
            raise ValueError(f"'{target}' has {len(columns)} columns, the frame has {len(df.columns)}")
        counted.write.insertInto(target)
        return seen.get["rows"]

    staging = f"{target}__staging_{uuid.uuid4().hex[:12]}"
    try:
        writer = counted.write.format(file_format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
        writer.saveAsTable(staging)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    aside = f"{staging}_old"
    if present:
        spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {target}")
    except Exception:
        if present:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    if present:
        spark.sql(f"DROP TABLE {aside}")
    if partition_by:  # some catalogs keep the staging paths of the partitions through a rename
        spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")
    return seen.get["rows"]


def materialize(df: DataFrame, name: str, kind: str = "view", database: str | None = None) -> DataFrame:
    """The frame as a temporary view (evaluated by each reader) or a table (evaluated once)."""
    if kind == "view":
        df.createOrReplaceTempView(check_identifier(name))
        return df
    if kind != "table":
        raise ValueError("kind must be one of: 'view', 'table'")
    write_table(df, name, database=database)
    return read_table(df.sparkSession, name, database)


def export_files(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Files for a reporting tool, one per partition; the folder must not exist yet."""
    writer = df.write.mode("errorifexists")
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("file_format must be one of: 'parquet', 'csv'")
