"""Date and duration expressions. Every function maps columns to a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_SECOND = 1_000_000


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds of a zoneless timestamp since 1970-01-01, exact in a UTC session.

    `timestampdiff` costs more than twice as much per row, and depends on the session zone just the same.
    """
    return F.unix_micros(as_column(ts).cast("timestamp"))


def from_micros(us: str | Column) -> Column:
    """The zoneless timestamp behind a number of microseconds."""
    return F.timestamp_micros(as_column(us)).cast("timestamp_ntz")


def day_of_micros(us: str | Column) -> Column:
    return F.date_from_unix_date(F.floor(as_column(us) / F.lit(MICROS_PER_DAY)).cast("int"))


def micros_between(start: str | Column, end: str | Column) -> Column:
    return micros(end) - micros(start)


def hours_between(start: str | Column, end: str | Column) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return micros_between(start, end) / F.lit(float(MICROS_PER_SECOND))


def hours_from_micros(us: Column, digits: int = 4) -> Column:
    return F.round(us / F.lit(float(MICROS_PER_HOUR)), digits)


def whole_seconds(us: Column) -> Column:
    """Microseconds rounded to whole seconds, halves away from zero."""
    return F.round(us / F.lit(float(MICROS_PER_SECOND))).cast("long")


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Number of month boundaries between two dates: 31 December to 1 January is 1."""
    a, b = as_column(start), as_column(end)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def is_stale(day: str | Column, report_date: str | Column, months: int = 24) -> Column:
    """True when `day` lies more than `months` before the report date; False for NULL."""
    d = as_column(day)
    return d.isNotNull() & (d < F.add_months(as_column(report_date), -months))


def at_time_of_day(day: str | Column, clock: str | Column) -> Column:
    """The time of day of `clock`, whatever its dummy date, put on `day` (whole seconds)."""
    t = as_column(clock)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.timestamp_add("SECOND", seconds, as_column(day).cast("date").cast("timestamp_ntz"))


def hhmmss(seconds: str | Column) -> Column:
    """Seconds as HH:MM:SS; hours may pass 99 and every field keeps the sign of a negative input."""
    s = F.round(as_column(seconds)).cast("long")
    hours = F.call_function("div", s, F.lit(3600))
    minutes = F.call_function("div", s % 3600, F.lit(60))
    # format_string prints "null" for a NULL argument, SQL text functions give NULL
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", hours, minutes, s % 60))


def floor_at_zero(x: Column) -> Column:
    """max(0, x) which stays NULL for a NULL input."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0).cast("long"), x))
