"""Federal holidays with observed dates, and weekday flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import as_column

# Holiday names with their rule, either (month, day) or (month, weekday, nth); nth -1 is the last one.
FIXED_HOLIDAYS = (
    ("New Year's Day", 1, 1),
    ("Juneteenth", 6, 19),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("Christmas Day", 12, 25),
)
FLOATING_HOLIDAYS = (
    ("MLK Jr. Day", 1, "Mon", 3),
    ("Washington's Birthday", 2, "Mon", 3),
    ("Memorial Day", 5, "Mon", -1),
    ("Labor Day", 9, "Mon", 1),
    ("Columbus Day", 10, "Mon", 2),
    ("Thanksgiving", 11, "Thu", 4),
)


def _holiday(name: Column, day: Column) -> Column:
    return F.struct(name.alias("Holiday"), day.alias("Date"))


def _fixed(year: Column, name: str, month: int, day: int) -> Column:
    actual = F.make_date(year, F.lit(month), F.lit(day))
    weekday = F.dayofweek(actual)  # 1 is Sunday, 7 is Saturday
    observed = F.when(weekday == 7, F.date_sub(actual, 1)).when(weekday == 1, F.date_add(actual, 1)).otherwise(actual)
    return _holiday(F.when(weekday.isin(1, 7), f"{name} (Observed)").otherwise(name), observed)


def _floating(year: Column, name: str, month: int, weekday: str, nth: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if nth > 0:
        day = F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (nth - 1))
    else:
        day = F.next_day(F.date_sub(F.last_day(first), 7), weekday)
    return _holiday(F.lit(name), day)


def federal_holidays(years: DataFrame, year: str = "Year") -> DataFrame:
    """One row per holiday of every distinct year in `years`: Year, Holiday, Date."""
    y = F.col("Year")
    rules = [_fixed(y, *r) for r in FIXED_HOLIDAYS] + [_floating(y, *r) for r in FLOATING_HOLIDAYS]
    one_per_year = years.select(F.col(year).cast("int").alias("Year")).where(y.isNotNull()).distinct()
    return one_per_year.select("Year", F.explode(F.array(*rules)).alias("h")).select("Year", "h.Holiday", "h.Date")


def calendar_flags(day: str | Column) -> dict[str, Column]:
    """Weekday name and flags of a date."""
    d = as_column(day)
    number = F.dayofweek(d)
    return {
        "Weekday": F.date_format(d, "EEEE"),
        "Monday_to_Saturday": number != 1,
        "Is_Monday": number == 2,
        "Is_Saturday": number == 7,
    }
