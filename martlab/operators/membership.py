"""Which rows belong to which reference sets, and which keys are missing where."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def tag_membership(df: DataFrame, sets: Mapping[str, DataFrame], key: str, *, any_name: str, all_name: str,
                   label_name: str) -> DataFrame:
    """Adds `in_<name>` for every set, any/all flags and a label: BOTH, <NAME>_ONLY or NEITHER.

    The sets are first reduced to one row per key with a flag each, so the large side is joined once however many sets
    there are. With more than two sets the labels ALL, NONE and the joined names are used.
    """
    flags = [f"in_{n}" for n in sets]
    tagged = [
        d.select(F.col(key), *[F.lit(n == m).alias(f"in_{m}") for m in sets]).where(F.col(key).isNotNull())
        for n, d in sets.items()
    ]
    one_per_key = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(*[F.bool_or(f).alias(f) for f in flags])
    joined = df.join(one_per_key, key, "left").withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})
    columns = [F.col(f) for f in flags]
    joined = joined.withColumns({any_name: reduce(or_, columns), all_name: reduce(and_, columns)})
    return joined.withColumn(label_name, _label(list(sets))).select(
        *df.columns, *flags, any_name, all_name, label_name
    )


def _label(names: Sequence[str]) -> Column:
    hits = [F.col(f"in_{n}") for n in names]
    everywhere, nowhere = ("BOTH", "NEITHER") if len(names) == 2 else ("ALL", "NONE")
    label = F.when(reduce(and_, hits), everywhere)
    if len(names) == 2:
        for name, hit in zip(names, hits):
            label = label.when(hit, f"{name.split('_')[0].upper()}_ONLY")
    else:
        joined = F.array_join(F.array_compact(F.array(*[F.when(h, n.upper()) for n, h in zip(names, hits)])), "+")
        label = label.when(reduce(or_, hits), joined)
    return label.otherwise(nowhere)


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows of `wanted` whose key does not occur in `present`. A NULL key occurs nowhere."""
    return wanted.join(distinct_keys(present, key), key, "left_anti").select(*wanted.columns)


def key_parity(ours: DataFrame, theirs: DataFrame, key: str, columns: Sequence[str], *, ours_name: str,
               theirs_name: str) -> DataFrame:
    """Rows found on one side only, with the direction spelled out."""
    def side(df: DataFrame, other: DataFrame, text: str) -> DataFrame:
        return missing_keys(df.select(*columns), other, key).withColumn("discrepancy_type", F.lit(text))

    under = side(theirs, ours, f"In {theirs_name}, missing from {ours_name} (under-capture)")
    over = side(ours, theirs, f"In {ours_name}, missing from {theirs_name} (over-capture)")
    return under.unionByName(over)


def keep_in_lookup(df: DataFrame, lookup: DataFrame, column: str, lookup_column: str | None = None) -> DataFrame:
    """`column in (select ... from lookup)` as a left semi join."""
    values = lookup.select(F.col(lookup_column or column).alias(column)).distinct()
    return df.join(values, column, "left_semi").select(*df.columns)
