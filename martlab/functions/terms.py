"""Loan term expressions as of a report date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import as_column, month_diff


def effective_origination(is_arc: str | Column, conversion_date: str | Column, origination: str | Column) -> Column:
    """Construction loans count from their conversion to permanent, all others from origination."""
    converted = as_column(conversion_date)
    return F.when(as_column(is_arc) & converted.isNotNull(), converted).otherwise(as_column(origination))


def remaining_terms(
    as_of: str | Column,
    maturity: str | Column = "maturity_date",
    origination: str | Column = "effective_origination_date",
    amortization: str | Column = "original_amortization_term_months",
    io_end: str | Column = "io_end_date",
) -> dict[str, Column]:
    """Seven term columns. `as_of` is an ISO date text or a date column.

    The floored month counts are never NULL, because `greatest` skips NULL; use the raw one to tell.
    """
    today = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    due, start, io = as_column(maturity), as_column(origination), as_column(io_end)
    term = as_column(amortization)
    zero = F.lit(0)
    to_maturity = month_diff(today, due)
    clock = F.when(io <= today, io).otherwise(start)
    return {
        "months_to_maturity_raw": to_maturity,
        "months_to_maturity": F.greatest(zero, to_maturity),
        "is_matured": F.coalesce(due <= today, F.lit(False)),
        "months_since_origination": month_diff(start, today),
        "amortization_term_remaining": F.when(term.isNull(), None)
        .when(io > today, term)
        .otherwise(F.greatest(zero, term - month_diff(clock, today))),
        "io_term_remaining": F.when(io <= today, zero).otherwise(month_diff(today, io)),
        "is_io_expired": F.coalesce(io <= today, F.lit(False)),
    }
