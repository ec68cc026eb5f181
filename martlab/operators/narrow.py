"""Comparison of two large tables by digests: only rows of key ranges that differ are sorted or joined.

Keys are hashed into buckets. Both sides are reduced to one order-free digest for each bucket, summed per task, in which
equal rows cancel out. Rows of differing buckets alone are digested again by finer buckets, and so on; what is left goes to
the exact comparison. Equal tables end after the first digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import dataset_diff
from .membership import key_parity

BITS, LEVELS = 14, 2  # 16,384 buckets a level


def _bucket(keys: Sequence[str], level: int) -> Column:
    """The first `level` times BITS bits of the hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - BITS * level)


def bucket_digests(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], level: int) -> DataFrame:
    """(bucket, rows, mixed, added): order-free digests of `a` less those of `b`; `added` tells repeats apart that cancel out in `mixed`."""
    row = F.xxhash64(*keys, *columns, *[F.col(c).isNull() for c in [*keys, *columns]])
    sides = [df.select(_bucket(keys, level).alias("bucket"), F.lit(sign).cast("long").alias("side"), row.alias("row")) for df, sign in ((a, 1), (b, -1))]
    return sides[0].unionByName(sides[1]).groupBy("bucket").agg(
        F.sum("side").alias("rows"), F.bit_xor("row").alias("mixed"), F.sum(F.col("side") * F.shiftrightunsigned("row", 32)).alias("added"))


def differing_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], level: int) -> DataFrame:
    """Buckets whose digests are not the same on both sides: one table of sums a task, not one for each side and one for both."""
    return bucket_digests(a, b, keys, columns, level).where("rows <> 0 OR mixed <> 0 OR added <> 0").select("bucket")


def narrowed(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in buckets that differ, by `levels` passes of ever finer buckets."""
    keys, columns = list(keys), list(columns)
    for level in range(1, levels + 1):
        wanted = differing_buckets(a, b, keys, columns, level)
        # the first buckets are few enough for every task; of finer ones a task hashes its own, so that no row is sorted
        wanted = F.broadcast(wanted) if level == 1 else wanted.hint("shuffle_hash")
        a, b = (df.withColumn("bucket", _bucket(keys, level)).join(wanted, "bucket", "left_semi").drop("bucket") for df in (a, b))
    return a, b


def narrowed_parity(ours: DataFrame, theirs: DataFrame, key: str, columns: Sequence[str], *, ours_name: str, theirs_name: str) -> DataFrame:
    """`key_parity` over the differing buckets of the keys. Rows without a key occur nowhere and are always kept."""
    named = [ours.select(*columns), theirs.select(*columns)]
    a, b = narrowed(*(df.where(F.col(key).isNotNull()) for df in named), [key], [])
    a, b = (few.unionByName(df.where(F.col(key).isNull())) for few, df in zip((a, b), named, strict=True))
    return key_parity(a, b, key, columns, ours_name=ours_name, theirs_name=theirs_name)


def narrowed_diff(a: DataFrame, b: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """`dataset_diff` over the differing buckets. A key that repeats alike on both sides is no difference and may not be reported."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(columns or [c for c in a.columns if c in b.columns and c not in keys])
    # compared as the texts that the difference shows, so that equal values of two types are equal
    few = narrowed(*(df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns]) for df in (a, b)), keys, columns)
    return dataset_diff(*few, keys, columns)
