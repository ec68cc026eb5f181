"""Workforce marts: absenteeism and schedule adherence per agent and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (
    at_time_of_day,
    floor_at_zero,
    from_micros,
    hhmmss,
    hours_from_micros,
    micros,
    micros_between,
    whole_seconds,
)
from ..operators import intervals as iv

AGENT_DAY = ["payroll", "work_date"]
PERSON = ["firstname", "surname", "team", "lob"]
# Phone states that count as productive.
PRODUCTIVE = ("Waiting", "Connected", "After Call Work", "Dialer Login")


def roster_days(roster: DataFrame) -> DataFrame:
    """Rosters with real start and finish times; the source keeps the time of day under a dummy date."""
    day = F.to_date("rdate")
    return roster.select(
        "roster_key",
        "payroll",
        day.alias("work_date"),
        at_time_of_day(day, "start").alias("roster_start"),
        at_time_of_day(day, "finish").alias("roster_finish"),
        F.col("hours").alias("rostered_hours"),
    )


def break_intervals(breaks: DataFrame, only_breaks: bool) -> DataFrame:
    """Breaks as payroll, work_date, break_start, break_end; meetings are left out on request."""
    rows = breaks.where(F.col("break") == 1) if only_breaks else breaks
    return rows.select(
        "roster_key",
        F.col("person").alias("payroll"),
        F.to_date("from").alias("work_date"),
        F.col("from").alias("break_start"),
        F.col("to").alias("break_end"),
    )


def break_hours(breaks: DataFrame) -> DataFrame:
    """Rounded break and lunch hours per roster, agent and day."""
    rows = break_intervals(breaks, only_breaks=True)
    summed = rows.groupBy("roster_key", *AGENT_DAY).agg(F.sum(micros_between("break_start", "break_end")).alias("_us"))
    return summed.select("roster_key", *AGENT_DAY, hours_from_micros(F.col("_us")).alias("_break_hours"))


def scheduled_hours(roster: DataFrame, breaks: DataFrame) -> DataFrame:
    days = roster_days(roster).drop("roster_start", "roster_finish")
    joined = days.join(break_hours(breaks), ["roster_key", *AGENT_DAY], "left")
    return joined.withColumn("_break_hours", F.coalesce("_break_hours", F.lit(0.0)))


def leave_by_source(leave: DataFrame, partial_leave: DataFrame, breaks: DataFrame) -> DataFrame:
    """Net leave per agent, day, source (0 full, 1 partial) and type: exact microseconds and number of entries.

    Rostered breaks inside a leave do not count. Full and partial leave share one overlap join; equal entries are
    combined before it.
    """
    full = leave.select("payroll", F.col("start").alias("_from"), F.col("stop").alias("_to"), F.col("type").alias("leave_type"))
    part = partial_leave.select(
        "payroll", F.col("leavestart").alias("_from"), F.col("leavefinish").alias("_to"), F.col("leavetype").alias("leave_type")
    )
    both = full.withColumn("_source", F.lit(0)).unionByName(part.withColumn("_source", F.lit(1)))
    entries = both.groupBy("payroll", "_from", "_to", "leave_type", "_source").agg(F.count("*").alias("_copies"))
    entries = entries.withColumn("work_date", F.to_date("_from"))
    with_overlap = iv.overlap_micros(
        entries,
        break_intervals(breaks, only_breaks=True),
        AGENT_DAY,
        start="_from",
        end="_to",
        right_start="break_start",
        right_end="break_end",
    )
    net = floor_at_zero(micros_between("_from", "_to") - F.col("overlap_us"))
    return with_overlap.groupBy(*AGENT_DAY, "_source", "leave_type").agg(
        F.sum(net * F.col("_copies")).alias("_us"), F.sum("_copies").alias("_entries")
    )


def absenteeism_by_type(
    roster: DataFrame, breaks: DataFrame, leave: DataFrame, partial_leave: DataFrame, personnel: DataFrame,
) -> DataFrame:
    """One row per rostered agent, day and leave type. Hours are rounded per source before they are added."""
    by_source = leave_by_source(leave, partial_leave, breaks)
    by_type = by_source.groupBy(*AGENT_DAY, "leave_type").agg(
        F.round(F.sum(hours_from_micros(F.col("_us"))), 4).alias("absenteeism_hours")
    )
    scheduled = scheduled_hours(roster, breaks).select(
        *AGENT_DAY,
        "rostered_hours",
        F.round(F.col("rostered_hours") - F.col("_break_hours"), 4).alias("scheduled_hours"),
    )
    joined = by_type.join(scheduled, AGENT_DAY).join(personnel.select("payroll", *PERSON), "payroll", "left")
    share = F.when(
        F.col("scheduled_hours") > 0, F.round(F.col("absenteeism_hours") / F.col("scheduled_hours"), 4)
    )
    return joined.select(
        "work_date", "payroll", *PERSON, "leave_type", "rostered_hours", "scheduled_hours", "absenteeism_hours",
        share.alias("absenteeism_pct"),
    )


def _types_text(entries: str) -> Column:
    """Types of the entries in order, each as often as it was entered; the text is as long as its entries, nothing else is held."""
    gap = " | "
    texts = F.transform(F.array_sort(entries), lambda e: F.concat(
        F.repeat(F.concat(e["leave_type"], F.lit(gap)), (e["n"] - 1).cast("int")), e["leave_type"]))
    return F.array_join(texts, gap)


def absenteeism_daily(
    roster: DataFrame, breaks: DataFrame, leave: DataFrame, partial_leave: DataFrame, personnel: DataFrame,
) -> DataFrame:
    """One row per roster: break, scheduled and absent hours, leave types (full before partial, then by name)."""
    by_source = leave_by_source(leave, partial_leave, breaks)
    # One entry per distinct type and source, so the list per agent and day is as short as the list of leave types.
    entry = F.when(
        F.col("leave_type").isNotNull(),
        F.struct(F.col("_source").alias("s"), "leave_type", F.col("_entries").alias("n")),
    )
    absent = by_source.groupBy(*AGENT_DAY).agg(
        hours_from_micros(F.sum("_us")).alias("_absent"), F.collect_list(entry).alias("_types")
    )
    joined = (
        scheduled_hours(roster, breaks)
        .join(absent, AGENT_DAY, "left")
        .join(personnel.select("payroll", *PERSON), "payroll", "left")
    )
    absent_hours = F.coalesce("_absent", F.lit(0.0))
    scheduled = F.col("rostered_hours") - F.col("_break_hours")
    return joined.select(
        "work_date",
        "payroll",
        *PERSON,
        "rostered_hours",
        F.round("_break_hours", 4).alias("break_lunch_hours"),
        F.round(scheduled, 4).alias("scheduled_hours"),
        F.round(absent_hours, 4).alias("absenteeism_hours"),
        F.coalesce(_types_text("_types"), F.lit("")).alias("leave_types"),
        F.when(scheduled > 0, F.round(absent_hours / scheduled, 4)).alias("absenteeism_pct"),
    )


def productive_intervals(
    log: DataFrame,
    roster: DataFrame,
    breaks: DataFrame,
    *,
    slot_minutes: int = 10,
) -> DataFrame:
    """Status intervals inside the roster window with their length and the part covered by rostered activities.

    Roster windows ride on the slot table of the log and the break end points are summed by slot, so the log is never
    shuffled by agent and day.
    """
    events = log.where(F.col("payroll").isNotNull()).select("payroll", "tstamp", "newstatus")
    windows = roster_days(roster).select(
        *AGENT_DAY, micros("roster_start").alias("_opens"), micros("roster_finish").alias("_closes")
    )
    activities = break_intervals(breaks, only_breaks=False)
    points = iv.end_points(activities, AGENT_DAY, "break_start", "break_end")
    closed = iv.close_events(
        events, ["payroll"], "tstamp", then_by=["newstatus"], slot_minutes=slot_minutes, day_columns=windows, merge_copies=True
    )
    clipped = iv.clip(closed, iv.START_US, iv.END_US, "_opens", "_closes").select(
        *AGENT_DAY, "newstatus", "clipped_start", "clipped_end"
    )
    shared = iv.overlap_by_running_sum(
        clipped, points, AGENT_DAY, "clipped_start", "clipped_end", slot_minutes=slot_minutes
    )
    return shared.select(
        *AGENT_DAY,
        "newstatus",
        from_micros("clipped_start").alias("clipped_start"),
        from_micros("clipped_end").alias("clipped_end"),
        (F.col("clipped_end") - F.col("clipped_start")).alias("interval_us"),
        "overlap_us",
    )


def adherence_daily(
    log: DataFrame,
    roster: DataFrame,
    breaks: DataFrame,
    personnel: DataFrame,
    *,
    productive: Sequence[str] = PRODUCTIVE,
    slot_minutes: int = 10,
) -> DataFrame:
    """One row per roster: rostered, activity, adherent and non-adherent time, and the adherent share as a decimal.

    Two rosters on one agent-day each show the totals of the day. Shifts and statuses that cross midnight are lost, as
    intervals end with the day.
    """
    detail = productive_intervals(log, roster, breaks, slot_minutes=slot_minutes)
    net = floor_at_zero(F.col("interval_us") - F.col("overlap_us"))
    good = F.coalesce(F.col("newstatus").isin(*productive), F.lit(False))
    daily = detail.groupBy(*AGENT_DAY).agg(
        whole_seconds(F.sum(F.when(good, net).otherwise(0))).alias("_adherent"),
        whole_seconds(F.sum(F.when(~good, net).otherwise(0))).alias("_other"),
    )
    activity = break_intervals(breaks, only_breaks=False).groupBy(*AGENT_DAY).agg(
        whole_seconds(F.sum(micros_between("break_start", "break_end"))).alias("_activity")
    )
    joined = (
        roster_days(roster)
        .join(activity, AGENT_DAY, "left")
        .join(daily, AGENT_DAY, "left")
        .join(personnel.select("payroll", *PERSON), "payroll", "left")
    )
    zero = F.lit(0).cast("long")
    seconds = {
        "rostered_seconds": F.round(F.col("rostered_hours") * 3600).cast("long"),
        "rostered_activity_seconds": F.coalesce("_activity", zero),
        "adherent_seconds": F.coalesce("_adherent", zero),
        "non_adherent_seconds": F.coalesce("_other", zero),
    }
    joined = joined.withColumns(seconds).withColumn(
        "scheduled_productive_seconds", F.col("rostered_seconds") - F.col("rostered_activity_seconds")
    )
    tracked = F.col("adherent_seconds") + F.col("non_adherent_seconds")
    names = ["rostered", "rostered_activity", "scheduled_productive", "adherent", "non_adherent"]
    return joined.select(
        "work_date",
        "payroll",
        *PERSON,
        *[f"{n}_seconds" for n in names],
        *[hhmmss(f"{n}_seconds").alias(f"{n}_time") for n in names],
        F.when(tracked > 0, F.round(F.col("adherent_seconds") / tracked, 4)).alias("adherence_pct"),
    )
