"""Interactive record operations: wildcards, column filters, facets, search and sorting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import number_from_text
from ..functions.text import shown

ALL = "All"
ALL_MONTHS = "All months"


def filter_records(df: DataFrame, category: str = ALL, month: str | int = ALL_MONTHS) -> DataFrame:
    """Rows of a category and a month, each of which may be a wildcard."""
    if category != ALL:
        df = df.where(F.col("category") == category)
    if month != ALL_MONTHS:
        df = df.where(F.col("month") == int(month))
    return df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The sorted choices of a column."""
    return df.select(column).distinct().orderBy(column)


def _number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.col(column)
    return number_from_text(column, strip_commas=True)


def _condition(df: DataFrame, column: str, spec: Mapping[str, Any]) -> Column:
    if spec["mode"] == "set":
        allowed = [str(v) for v in spec["allowed"]]
        text = shown(F.col(column), df.schema[column].dataType)
        hit = text.isin(*allowed) if allowed else F.lit(False)
        # A missing value shows as the text None.
        return hit | text.isNull() if "None" in allowed else hit
    if spec["mode"] != "range":
        raise ValueError("mode must be one of: 'set', 'range'")
    number = _number(df, column)
    condition = number.isNotNull()
    if spec.get("min") is not None:
        condition = condition & (number >= spec["min"])
    if spec.get("max") is not None:
        condition = condition & (number <= spec["max"])
    return condition


def apply_column_filters(df: DataFrame, filters: Mapping[str, Mapping | None]) -> DataFrame:
    """Rows passing every column's filter: {"mode": "set", "allowed": [...]} or {"mode": "range", "min", "max"}.

    Sets compare as text. Ranges read numbers from text without thousands commas; other text is left out.
    """
    for column, spec in filters.items():
        if spec is not None:
            df = df.where(_condition(df, column, spec))
    return df


def facet_values(df: DataFrame, filters: Mapping[str, Mapping | None], column: str) -> DataFrame:
    """Distinct texts of a column under the filters of all other columns, sorted without regard to case."""
    others = {c: s for c, s in filters.items() if c != column}
    text = F.coalesce(shown(F.col(column), df.schema[column].dataType), F.lit("None")).alias("value")
    return apply_column_filters(df, others).select(text).distinct().orderBy(F.lower("value"), "value")


def all_facets(df: DataFrame, filters: Mapping[str, Mapping | None], columns: Sequence[str]) -> DataFrame:
    """(field, value): what `facet_values` gives for each of `columns`, in one pass over the rows.

    Every row knows which filters it fails. It counts for a column if it fails none, or that column's own alone.
    """
    active = {c: s for c, s in filters.items() if s is not None}
    failed = [F.when(~F.coalesce(_condition(df, c, s), F.lit(False)), F.lit(c)) for c, s in active.items()]
    marked = df.withColumn("_failed", F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>"))
    own = lambda c: (F.size("_failed") == 0) | ((F.size("_failed") == 1) & F.array_contains("_failed", c))
    shows = lambda c: F.coalesce(shown(F.col(c), df.schema[c].dataType), F.lit("None"))
    entries = [F.when(own(c), F.struct(F.lit(c).alias("field"), shows(c).alias("value"))) for c in columns]
    rows = marked.where(F.size("_failed") < 2).select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return rows.select("e.field", "e.value").distinct().orderBy("field", F.lower("value"), "value")


def sort_order(df: DataFrame, column: str, *, kind: str = "str", ascending: bool = True) -> Column:
    """The order of `typed_sort` by one column, for positions and pages."""
    if kind == "num":
        key = F.coalesce(_number(df, column).cast("double"), F.lit(float("inf")))
    else:
        key = F.lower(F.coalesce(shown(F.col(column), df.schema[column].dataType), F.lit("None")))
    return key.asc() if ascending else key.desc()


def typed_sort(df: DataFrame, column: str, *, kind: str = "str", ascending: bool = True, then: str | None = None) -> DataFrame:
    """Sort by number (what is no number counts as infinite) or by case-folded text.

    Ties keep the order of the input. That also lets Spark cut a value shared by very many rows into several sort
    partitions.
    """
    first = sort_order(df, column, kind=kind, ascending=ascending)
    return df.orderBy(first, *([F.col(then)] if then else []), F.monotonically_increasing_id())


def search_records(df: DataFrame, term: str | None, limit: int = 50) -> DataFrame:
    """Up to `limit` records by id: all-digit terms match the id, other terms part of category or item."""
    term = (term or "").strip()
    columns = ["id", "category", "item", "month"]
    if not term:
        hit = F.lit(False)
    elif term.isdigit():
        hit = F.col("id") == int(term)
    else:
        # `%` and `_` are wildcards, as in the search box; a backslash is an ordinary character
        pattern = "%" + term.replace("\\", "\\\\") + "%"
        hit = F.col("category").ilike(pattern) | F.col("item").ilike(pattern)
    found = df.where(hit).select(*columns).orderBy("id").limit(limit)
    label = F.concat_ws(" | ", F.col("id"), F.col("category"), F.col("item"), F.concat(F.lit("m="), F.col("month")))
    return found.withColumn("suggestion", label)


def suggestion_id(c: str | Column) -> Column:
    """The id at the head of a suggestion text, NULL when there is none."""
    text = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(text, r"^\s*([+-]?\d+)\s*(\||\z)", 1).try_cast("long")


def get_record(df: DataFrame, record_id: int) -> DataFrame:
    return df.where(F.col("id") == record_id)
