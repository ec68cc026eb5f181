"""Status logs to intervals, clipping, and overlap sums.

No step gathers all rows of a key into one task. Rows are split by key, day *and* time slot, so even one agent that
writes a third of the log is spread over many tasks; only one row per slot is ordered along the whole key, and what it
carries from the earlier or later slots is joined back to the slot's rows. Rows and slot totals come from one shuffle: both
sides of that join keep all columns up to it, so Spark plans the exchange once and reuses it. Overlap sums never
form interval pairs: the other side is reduced to signed end points and a running sum over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_of_micros, from_micros, micros, micros_between

DAY = "work_date"
START, END = "status_start", "status_end"
START_US, END_US = "start_us", "end_us"


def close_events(
    log: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    then_by: Sequence[str] = (),
    slot_minutes: int = 10,
    day_columns: DataFrame | None = None,
    merge_copies: bool = False,
) -> DataFrame:
    """Each event becomes an interval up to the next event of the same key and day; the day's last one is dropped.

    Adds `work_date`, `status_start` and `status_end`, and the two times in microseconds as `start_us` and `end_us`, in
    place of the time column. `then_by` orders events of the same instant. `day_columns`, one or more rows per key and
    `work_date`, is inner joined on the way: its columns ride on the slot table, so the log itself is never shuffled by
    key and day alone.

    Equal log rows are combined per task before they are shuffled. All but one of them have zero length: they are put
    back as such at the end, or left out with `merge_copies`, which keeps every time sum.
    """
    keys = list(keys)
    others = [c for c in log.columns if c != ts]
    at = ["_key", DAY, "_slot"]

    # Times travel as numbers: they are converted once per row, and sort and compare cheaply.
    timed = log.where(F.col(ts).isNotNull()).select(*others, micros(ts).alias(START_US))
    if day_columns is not None:
        timed = timed.dropna(subset=keys)
    once = timed.distinct() if merge_copies else timed.groupBy(*timed.columns).agg(F.count("*").alias("_copies"))
    # Events without a key form a group of their own: as part of a struct their NULL keys meet in the join.
    rows = once.withColumns({
        "_key": F.struct(*keys), DAY: day_of_micros(START_US),
        "_slot": F.floor(F.col(START_US) / F.lit(slot_minutes * 60_000_000)),
    }).where(F.col(DAY).isNotNull() & F.col("_slot").isNotNull()).repartition(*at)
    order = [START_US, *then_by, *[c for c in others if c not in then_by]]
    slots = slot_totals(rows, at, F.min(START_US).alias("_first"))
    along = Window.partitionBy("_key", DAY).orderBy("_slot")
    slots = slots.withColumn("_later", F.lead("_first").over(along)).drop("_first")
    if day_columns is not None:
        days = day_columns.withColumn("_key", F.struct(*keys)).drop(*keys)
        slots = slots.join(days, ["_key", DAY])
    rows = rows.withColumn("_next", F.lead(START_US).over(Window.partitionBy(*at).orderBy(*order)))
    closed = rows.join(slots, at).withColumn(END_US, F.coalesce("_next", "_later"))
    if not merge_copies:
        closed = put_back(_split_copies(closed), "_n").drop("_copies")
    closed = closed.where(F.col(END_US).isNotNull()).drop("_key", "_slot", "_next", "_later")
    return closed.withColumns({START: from_micros(START_US), END: from_micros(END_US)})


def slot_totals(rows: DataFrame, at: Sequence[str], *totals: Column) -> DataFrame:
    """Totals of each slot of `rows`, which are already partitioned by `at`.

    The hash of all columns is never NULL, so the condition on it drops nothing. It keeps columns that the totals do not
    need from being pruned below the exchange, which could not be shared with the rows themselves otherwise. For the
    same reason callers state that `at` is not NULL before they partition, as the later join would for one side only.
    """
    whole = F.max(F.xxhash64(*rows.columns)).alias("_whole")
    return rows.groupBy(*at).agg(*totals, whole).where(F.col("_whole").isNotNull()).drop("_whole")


def _split_copies(rows: DataFrame) -> DataFrame:
    """Every row once as it is, and once more for its `_copies` - 1 repeats, which have zero length; `_n` tells how many."""
    kinds = F.array(
        F.struct(F.col(END_US).alias("end"), F.lit(1).cast("long").alias("n")),
        F.struct(F.col(START_US).alias("end"), (F.col("_copies") - 1).alias("n")),
    )
    few = rows.withColumn("_kind", F.explode(F.filter(kinds, lambda k: k["n"] > 0)))
    return few.withColumns({END_US: F.col("_kind.end"), "_n": F.col("_kind.n")}).drop("_kind")


def put_back(rows: DataFrame, count: str, block: int = 1000) -> DataFrame:
    """Every row as often as `count` says, without that column. Arrays stay within `block` entries."""
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / block))))
    size = F.least(F.lit(block).cast("long"), F.col(count) - F.col("_block") * block)
    return blocks.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop(count, "_block", "_i")


def clip_to_window(
    intervals: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    *,
    start: str = START,
    end: str = END,
    window_start: str = "window_start",
    window_end: str = "window_end",
) -> DataFrame:
    """Intervals cut to the windows of the same keys; intervals wholly outside are left out."""
    joined = intervals.join(windows, list(keys))
    return clip(joined, start, end, window_start, window_end)


def clip(df: DataFrame, start: str, end: str, window_start: str, window_end: str) -> DataFrame:
    s, e, ws, we = (F.col(c) for c in (start, end, window_start, window_end))
    kept = df.where((s < we) & (e > ws))
    return kept.withColumns({"clipped_start": F.greatest(s, ws), "clipped_end": F.least(e, we)})


# --- overlap sums ---------------------------------------------------------------------------------------------------


def end_points(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Signed end points: keys, x (microseconds), step (+1 for each start at x, -1 for each end).

    Equal points are summed before the shuffle, so copies of one interval cost one row. Intervals that end before they
    start share no time with anything and are left out.
    """
    pairs = F.array(
        F.struct(micros(start).alias("x"), F.lit(1).cast("long").alias("step")),
        F.struct(micros(end).alias("x"), F.lit(-1).cast("long").alias("step")),
    )
    points = intervals.where(F.col(end) > F.col(start)).select(*keys, F.explode(pairs).alias("p"))
    summed = points.groupBy(*keys, F.col("p.x").alias("x")).agg(F.sum("p.step").alias("step"))
    return summed.where(F.col("step") != 0)


def overlap_by_running_sum(
    left: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start_us: str,
    end_us: str,
    *,
    out: str = "overlap_us",
    slot_minutes: int = 10,
) -> DataFrame:
    """`left` plus the microseconds each interval shares with all intervals behind the points, shared time counting once for each.

    G(y) = sum of step * (y - x) over points x <= y is the time covered before y, so an interval shares
    G(end) - G(start). Each interval sends two marks that carry its row. A running sum inside (key, time slot) gives what
    the slot adds up to the mark; one row for each slot carries the time covered before the slot, and the intervals still open
    there. The two marks of a row meet again by the row itself, equal rows together, and `left` is read once.

    A NULL key meets nothing. `left` must not have map columns.
    """
    keys, us = list(keys), slot_minutes * 60_000_000
    a, b, one = F.col(start_us), F.col(end_us), F.lit(1)
    mark = lambda x, sign: F.struct(x.cast("long").alias("x"), F.lit(sign).alias("sign"))
    # an interval without length shares nothing, but its row must come through
    both = F.when(b > a, F.array(mark(a, -1), mark(b, 1))).otherwise(F.array(mark(F.coalesce(a, b, F.lit(0)), 0)))
    asked = left.select(F.struct(*keys).alias("_key"), F.explode(both).alias("_m"), F.struct(*left.columns).alias("_row"))
    asked = asked.select("_key", "_m.x", F.lit(0).cast("long").alias("step"), "_m.sign", "_row")
    given = points.dropna(subset=keys).select(
        F.struct(*keys).alias("_key"), F.col("x").cast("long").alias("x"), F.col("step").cast("long").alias("step"),
        F.lit(0).alias("sign"), F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    at = ["_key", "_slot"]
    slot = F.floor(F.col("x") / F.lit(us))
    marks = given.union(asked).withColumn("_slot", slot).withColumn("_y", F.col("x") - F.col("_slot") * us)
    marks = marks.where(F.col("_slot").isNotNull()).repartition(*at)

    # inside a slot: step and step * (distance from the slot's start), both far from the range of a long
    weight = F.col("step") * F.col("_y")
    totals = slot_totals(marks, at, F.sum("step").alias("_n"), F.sum(weight).alias("_w"))
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: c.cast("decimal(38,0)")
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    open_ = earlier(F.col("_n"))
    covered = wide(wide(F.col("_slot") * open_ - earlier(F.col("_n") * F.col("_slot"))) * F.lit(us)) - wide(earlier(wide(F.col("_w"))))
    carry = totals.select(*at, open_.cast("long").alias("_open"), wide(covered).alias("_covered"))

    inside = Window.partitionBy(*at).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.sum("step").over(inside) * F.col("_y") - F.sum(weight).over(inside)
    g = marks.withColumn("_local", local).where(F.col("_row").isNotNull()).join(carry, at)
    g = g.select("_row", "sign", wide(F.col("_covered") + F.col("_local") + F.col("_open") * F.col("_y")).alias("_g"))
    met = g.groupBy("_row").agg(
        F.max(F.when(F.col("sign") == 1, F.col("_g"))).alias("_b"), F.max(F.when(F.col("sign") == -1, F.col("_g"))).alias("_a"),
        F.count(F.when(F.col("sign") <= 0, one)).alias("_n"))
    shared = F.coalesce((F.col("_b") - F.col("_a")).cast("long"), F.lit(0).cast("long"))
    return put_back(met.select("_row", shared.alias("_shared"), "_n"), "_n").select("_row.*", F.col("_shared").alias(out))


def overlap_micros(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    start: str,
    end: str,
    right_start: str,
    right_end: str,
    out: str = "overlap_us",
) -> DataFrame:
    """`left` plus the time each interval shares with the right intervals of the same keys, 0 if none.

    One lazy plan for any number of intervals per key; building it starts no job.
    """
    points = end_points(right, keys, right_start, right_end)
    timed = left.withColumns({"_lo": micros(start), "_hi": micros(end)})
    return overlap_by_running_sum(timed, points, keys, "_lo", "_hi", out=out).drop("_lo", "_hi")


def duration_by_day(df: DataFrame, keys: Sequence[str], start: str, end: str, out: str = "duration_us") -> DataFrame:
    """Summed length of intervals per key and start day, in exact microseconds."""
    return df.groupBy(*keys, F.to_date(start).alias(DAY)).agg(F.sum(micros_between(start, end)).alias(out))
