"""Batches of field edits applied to a record table, and differences between two tables."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of a record that may be edited.
EDITABLE = ("category", "month", "item", "value", "accepted")


def apply_changes(
    df: DataFrame,
    changes: DataFrame,
    *,
    key: str = "id",
    field: str = "field",
    value: str = "new_value",
    order: str = "seq",
    editable: Sequence[str] = EDITABLE,
) -> DataFrame:
    """Records with the last change of every (id, field) applied; ids without a record are ignored.

    Changes hold text values. They are reduced to one row per id before the join, combining per task first, so an id
    with very many edits costs one row. A field outside `editable` raises when the plan runs. A value that breaks a record
    rule is refused, as `rejected_changes` lists it, and leaves the edit before it in force.
    """
    name = F.col(field)
    known = F.when(name.isin(*editable), name).otherwise(
        F.raise_error(F.concat(F.lit("Invalid field: "), F.coalesce(name, F.lit("(null)"))))
    )
    kept = F.when(~_breaks_rule(field, value), F.col(value))
    checked = changes.select(key, known.alias("_field"), kept.alias("_value"), F.col(order).alias("_order"))
    latest = checked.groupBy(key).agg(
        *[
            # fields hold no NULL, so a NULL edit is refused and leaves the edit before it in force
            F.max_by("_value", F.when((F.col("_field") == f) & F.col("_value").isNotNull(), F.col("_order"))).alias(f"_new_{f}")
            for f in editable
        ]
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    joined = df.join(latest, key, "left")
    updated = {f: F.coalesce(F.col(f"_new_{f}").cast(types[f]), F.col(f)) for f in editable if f in types}
    return joined.withColumns(updated).select(*df.columns)


def _breaks_rule(field: str, value: str) -> Column:
    """Whether a value is refused for its field: month outside 1..12, accepted not 0/1, blank text, no number; never NULL."""
    f, v = F.col(field), F.trim(F.col(value))
    fine = (
        F.when(f == "month", v.try_cast("int").between(1, 12))
        .when(f == "accepted", v.isin("0", "1"))
        .when(f.isin("category", "item"), v != "")
        .when(f == "value", v.try_cast("double").isNotNull())
        .otherwise(True)
    )
    return ~F.coalesce(fine, F.lit(False))


def rejected_changes(changes: DataFrame, *, field: str = "field", value: str = "new_value") -> DataFrame:
    """Changes that break a record rule: unknown field, month outside 1..12, accepted not 0/1, blank text, no number."""
    unknown = ~F.coalesce(F.col(field).isin(*EDITABLE), F.lit(False))
    return changes.where(unknown | _breaks_rule(field, value))


def toggle_flag(df: DataFrame, ids: DataFrame, *, key: str = "id", flag: str = "accepted") -> DataFrame:
    """Records with a 0/1 flag turned round for the given ids."""
    chosen = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_chosen", F.lit(True))
    turned = F.when(F.col("_chosen"), 1 - F.col(flag)).otherwise(F.col(flag))
    return df.join(chosen, key, "left").withColumn(flag, turned).select(*df.columns)


def column_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns only in `b` (added), only in `a` (dropped), and common ones whose type differs."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    return {
        "added": [c for c in b.columns if c not in left],
        "dropped": [c for c in a.columns if c not in right],
        "retyped": [c for c in a.columns if c in right and left[c] != right[c]],
    }


def dataset_diff(a: DataFrame, b: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows added, removed or changed from `a` to `b`: key columns, change_type, column_name, old_value, new_value.

    Keys should be unique. A key that repeats on a side is reported as DUPLICATE_KEY instead of being paired row by
    row. Both sides are stacked and grouped by key, so repeated keys are combined before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(columns or [c for c in a.columns if c in b.columns and c not in keys])

    def side(df: DataFrame, old: bool) -> DataFrame:
        return df.select(
            *keys,
            F.lit(1 if old else 0).alias("_na"),
            F.lit(0 if old else 1).alias("_nb"),
            *[(F.col(c).cast("string") if old else F.lit(None).cast("string")).alias(f"_a{i}") for i, c in enumerate(columns)],
            *[(F.lit(None).cast("string") if old else F.col(c).cast("string")).alias(f"_b{i}") for i, c in enumerate(columns)],
        )

    sums = [F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb")]
    values = [F.max(f"_{s}{i}").alias(f"_{s}{i}") for i in range(len(columns)) for s in "ab"]
    both = side(a, True).unionByName(side(b, False)).groupBy(*keys).agg(*sums, *values)

    def entry(kind: Column | str, column: str | None, old: Column | None, new: Column | None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            (F.lit(kind) if isinstance(kind, str) else kind).alias("change_type"),
            F.lit(column).cast("string").alias("column_name"),
            (none if old is None else old).alias("old_value"),
            (none if new is None else new).alias("new_value"),
        )

    whole = (
        F.when((F.col("_na") > 1) | (F.col("_nb") > 1), "DUPLICATE_KEY")
        .when(F.col("_na") == 0, "ADDED")
        .when(F.col("_nb") == 0, "REMOVED")
    )
    per_column = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")), entry("CHANGED", c, F.col(f"_a{i}"), F.col(f"_b{i}")))
                for i, c in enumerate(columns)
            ]
        )
    )
    entries = F.when(whole.isNotNull(), F.array(entry(whole, None, None, None))).otherwise(per_column)
    return both.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*")
