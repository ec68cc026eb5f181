"""Search by postings: a table of three-letter pieces finds the candidates, the pattern itself decides."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import qualified, write_table

PIECE = 3


def pieces(text: Column) -> Column:
    """The distinct runs of three letters of a text in lower case; empty for shorter texts and NULL."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(low) - (PIECE - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.substring(low, i, F.lit(PIECE)))
    return F.coalesce(F.when(F.length(low) >= PIECE, F.array_distinct(runs)), F.array().cast("array<string>"))


def build_index(df: DataFrame, name: str, columns: Sequence[str], *, key: str = "id", buckets: int = 64) -> int:
    """Write (piece, key): one row for each piece that one of the columns of a record holds, bucketed by piece."""
    every = F.array_distinct(F.flatten(F.array(*[pieces(F.col(c)) for c in columns])))
    return write_table(df.select(F.explode(every).alias("piece"), key), name, bucket_by=(buckets, "piece"))


def pattern_pieces(term: str) -> list[str]:
    """Pieces that every match of a LIKE pattern holds; none for a term without three letters in a row between wildcards."""
    runs = re.split(r"[%_]", term.lower())
    return sorted({run[i:i + PIECE] for run in runs for i in range(len(run) - PIECE + 1)})


def candidates(spark: SparkSession, name: str, wanted: Sequence[str], *, key: str = "id") -> DataFrame:
    """Keys of the records that hold all the pieces; only the buckets of these pieces are read."""
    hits = spark.table(qualified(name)).where(F.col("piece").isin(*wanted))
    return hits.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select(key)


def indexed_search(df: DataFrame, name: str, columns: Sequence[str], term: str, *, key: str = "id") -> DataFrame:
    """Rows one of whose columns contains the term (`%` and `_` are wildcards), whatever the case.

    With pieces the candidates come from the index and the pattern is checked on them; a shorter term scans the rows.
    """
    pattern = "%" + term.replace("\\", "\\\\") + "%"
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.col(c).ilike(pattern)
    wanted = pattern_pieces(term)
    if not wanted:
        return df.where(hit)
    return df.join(candidates(df.sparkSession, name, wanted, key=key), key, "left_semi").where(hit)
