"""Rows as of a date: the latest snapshot not after it, values of the period before, changes from period to period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .changes import dataset_diff
from .intervals import slot_totals


def as_of_rows(
    asked: DataFrame, facts: DataFrame, keys: Sequence[str], *, asked_day: str, fact_day: str, out: str = "found", slot_days: int = 366,
) -> DataFrame:
    """`asked` plus `out`: the latest row of `facts` with the same keys whose day is not after `asked_day`, as a struct, or NULL.

    No range join: both sides are stacked and the last fact is carried forward, inside (key, time slot) over the rows,
    and from slot to slot over one row for each. A key with very many rows is thus spread over its slots. Of several
    facts of one key and day the greatest row counts. NULL keys and days meet nothing. Neither side may have map columns.
    """
    keys = list(keys)
    row, fact = F.struct(*asked.columns).alias("_row"), F.struct(*facts.columns).alias("_fact")
    asked_rows = asked.select(F.struct(*keys).alias("_key"), F.col(asked_day).cast("date").alias("_day"), F.lit(1).alias("_kind"), row)
    fact_rows = facts.dropna(subset=[*keys, fact_day]).select(
        F.struct(*keys).alias("_key"), F.col(fact_day).cast("date").alias("_day"), F.lit(0).alias("_kind"), fact)
    fact_type, row_type = fact_rows.schema["_fact"].dataType, asked_rows.schema["_row"].dataType
    names = ["_key", "_day", "_kind", "_row", "_fact"]
    marks = fact_rows.withColumn("_row", F.lit(None).cast(row_type)).select(*names).union(
        asked_rows.withColumn("_fact", F.lit(None).cast(fact_type)).select(*names))
    # without a day a row comes before all facts
    slot = F.coalesce(F.floor(F.unix_date("_day") / F.lit(slot_days)), F.lit(-(2**40)))
    at = ["_key", "_slot"]
    marks = marks.withColumn("_slot", slot).where(F.col("_slot").isNotNull()).repartition(*at)

    newest = F.max_by("_fact", F.when(F.col("_kind") == 0, F.struct("_day", "_fact")))
    slots = slot_totals(marks, at, newest.alias("_newest"))
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select(*at, F.last("_newest", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy(*at).orderBy("_day", "_kind", "_fact").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = marks.withColumn("_seen", F.last("_fact", ignorenulls=True).over(inside)).where(F.col("_row").isNotNull())
    return seen.join(carried, at).select("_row.*", F.coalesce("_seen", "_carried").alias(out))


def snapshots_at(df: DataFrame, keys: Sequence[str], day: str, periods: Sequence[str], *, period: str = "period") -> DataFrame:
    """For each of `periods` and each key: the latest row of `df` that is not after the period's date. Keys without one are left out."""
    keys = list(keys)
    dates = F.array(*[F.lit(p).cast("date") for p in periods])
    asked = df.select(*keys).dropna().distinct().withColumn(period, F.explode(dates))
    found = as_of_rows(asked, df, keys, asked_day=period, fact_day=day, out="_found").where(F.col("_found").isNotNull())
    return found.select(period, "_found.*")


def with_previous(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str], *, prefix: str = "previous_") -> DataFrame:
    """Adds the values of the row before in order of `period` within the keys; one row for each key and period is expected."""
    before = Window.partitionBy(*keys).orderBy(period)
    return df.withColumns({f"{prefix}{c}": F.lag(c).over(before) for c in columns})


def period_diff(df: DataFrame, keys: Sequence[str], day: str, periods: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows added, removed or changed from each of `periods` (dates in order) to the next: `period` is the later one.

    Each row is sent once as the new state of its own period and once as the old state of the next.
    """
    keys, dates = list(keys), [F.lit(p).cast("date") for p in periods]
    if len(dates) < 2:
        raise ValueError("a comparison needs two periods or more")
    following = F.lit(None).cast("date")
    for this, later in zip(dates, dates[1:]):
        following = F.when(F.col(day).cast("date") == this, later).otherwise(following)
    kept = df.where(F.col(day).cast("date").isin(*dates))
    old = kept.select(following.alias("period"), *keys, *columns).where(F.col("period").isNotNull())
    new = kept.where(F.col(day).cast("date") != dates[0]).select(F.col(day).cast("date").alias("period"), *keys, *columns)
    return dataset_diff(old, new, ["period", *keys], columns)
