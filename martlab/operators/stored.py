"""Edits on a stored table: only the partitions that hold an edited record are written again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import qualified, write_table
from .changes import apply_changes, rejected_changes

PART = "key_range"


def store_records(df: DataFrame, name: str, *, key: str = "id", rows_per_part: int = 1_000_000) -> int:
    """Write records partitioned by ranges of their numeric key, so that a batch of edits names its partitions itself."""
    part = F.floor(F.col(key) / F.lit(rows_per_part)).cast("long")
    spread = df.withColumn(PART, part)
    rows = write_table(spread.repartition(PART), name, partition_by=(PART,))
    df.sparkSession.sql(f"ALTER TABLE {qualified(name)} SET TBLPROPERTIES ('rows_per_part' = '{rows_per_part}')")
    return rows


def edit_records(spark: SparkSession, name: str, changes: DataFrame, *, key: str = "id", most_parts: int = 100_000) -> tuple[list[int], DataFrame]:
    """Apply the changes that keep the record rules to a table of `store_records`; returns (touched partitions, refused changes).

    The partitions to rewrite follow from the keys of the changes alone; their numbers are the only thing that reaches the
    driver, and more than `most_parts` of them are an error, as such a batch calls for a whole rewrite. Spark writes the new
    files beside the old ones and puts them in place of whole partitions when all tasks are done; other partitions
    keep their files.
    """
    target = qualified(name)
    found = spark.sql(f"SHOW TBLPROPERTIES {target} ('rows_per_part')").first()["value"]
    refused = rejected_changes(changes)
    part = F.floor(F.col(key) / F.lit(int(found))).cast("long").alias("part")
    named = changes.where(F.col(key).isNotNull()).select(part).distinct().limit(most_parts + 1).collect()
    if len(named) > most_parts:
        raise ValueError(f"the changes touch more than {most_parts} partitions; rewrite the table instead")
    held = {r[PART] for r in spark.sql(f"SHOW PARTITIONS {target}").select(
        F.regexp_extract("partition", rf"{PART}=(-?\d+)", 1).cast("long").alias(PART)).collect()}
    touched = sorted(held.intersection(r["part"] for r in named))
    if touched:
        rows = spark.table(target).where(F.col(PART).isin(touched))
        edited = apply_changes(rows, changes, key=key, editable=tuple(c for c in rows.columns if c not in (key, PART)))
        # the folders of the touched partitions are known to the catalog, so only their files change
        path = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Location'").first()["data_type"]
        edited.repartition(PART).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(PART).parquet(path)
        spark.catalog.refreshTable(target)
    return touched, refused


def file_digest(spark: SparkSession, name: str, but: list[int] | None = None) -> tuple[int, int]:
    """(files, digest of their names, sizes and times) of the partitions that are not in `but`."""
    rows = spark.table(qualified(name)).where(~F.col(PART).isin(but or [None]) if but else F.lit(True))
    files = rows.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    found = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*files.columns)).alias("digest")).first()
    return found["n"], found["digest"] or 0
