"""Ratios, labels and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import as_column

# Label texts for how well a field value predicts membership.
SIGNAL_STRONG = "STRONG — all loans captured"
SIGNAL_HIGH = "HIGH — mostly captured, minor leakage"
SIGNAL_MEDIUM = "MEDIUM — partial signal, likely needs additional filter"
SIGNAL_WEAK = "WEAK — mostly excluded, not a good filter"
SIGNAL_NONE = "NONE — no loans captured"


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded; NULL when the whole is zero."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def exact_sum(amount: str | Column) -> Column:
    """Sum of amounts that does not depend on the order of the rows: added as decimals with six places."""
    return F.sum(as_column(amount).cast("decimal(24,6)")).cast("double")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def signal_strength(percentage: str | Column, population: str | Column) -> Column:
    p, n = as_column(percentage), as_column(population)
    return (
        F.when((p == 100) & (n > 0), SIGNAL_STRONG)
        .when(p >= 90, SIGNAL_HIGH)
        .when(p >= 50, SIGNAL_MEDIUM)
        .when(p > 0, SIGNAL_WEAK)
        .otherwise(SIGNAL_NONE)
    )


def decimals_text(value: str | Column, digits: int = 2) -> Column:
    v = as_column(value)
    return F.when(v.isNotNull(), F.call_function("format_number", v.cast("double"), F.lit("0." + "0" * digits if digits else "0")))


def yes_no(flag: str | Column) -> Column:
    return F.when(as_column(flag).cast("int") == 1, "Yes").otherwise("No")


NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def number_from_text(value: str | Column, strip_commas: bool = False) -> Column:
    """Double from text, NULL where it is not a number. Java suffixes such as `1d` are refused."""
    text = F.trim(as_column(value).cast("string"))
    if strip_commas:
        text = F.regexp_replace(text, ",", "")
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
