"""Field-by-field breakdown of a population in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD, VALUE = "filter_field", "field_value"


def profile_fields(
    df: DataFrame,
    fields: Sequence[str],
    measures: Mapping[str, Column],
    *,
    combos: Mapping[str, Sequence[str]] | None = None,
    missing: str = "(null)",
    sep: str = " | ",
) -> DataFrame:
    """The measures for every value of every field, and for every value combination of the named combos.

    Each row is expanded to one row per field while it is read and summed before the shuffle, so the input is scanned
    once and a value that holds most rows costs no more than a rare one. Values are grouped as arrays: a real NULL and
    the text "(null)" stay apart, and so do combinations that would read the same when joined.
    """
    groups = {f: [f] for f in fields} | {n: list(c) for n, c in (combos or {}).items()}
    entries = [
        F.struct(F.lit(name).alias(FIELD), F.array(*[F.col(c).cast("string") for c in columns]).alias("_values"))
        for name, columns in groups.items()
    ]
    expanded = df.withColumn("_entry", F.explode(F.array(*entries)))
    summed = expanded.groupBy(F.col(f"_entry.{FIELD}").alias(FIELD), F.col("_entry._values").alias("_values")).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    text = F.array_join(F.transform("_values", lambda v: F.coalesce(v, F.lit(missing))), sep)
    return summed.select(FIELD, text.alias(VALUE), *measures)
