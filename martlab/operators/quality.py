"""Data checks. Each single check returns the failing rows; `run_checks` reports counts for many in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows; NULL is not compared."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def check_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the list, with their number of rows; NULL passes."""
    wrong = df.where(~F.col(column).isin(*values))
    return wrong.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def check_predicate(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is false. A rule that is NULL passes, as in a table constraint."""
    return df.where(~rule)


def check_rate(df: DataFrame, flag: str, threshold: float = 0.98, subject: str = "Collateral match rate") -> DataFrame:
    """One row when the share of set flags is below the threshold, none otherwise."""
    stats = df.agg(F.count("*").alias("total_loans"), F.count_if(F.col(flag)).alias("matched_loans"))
    stats = stats.withColumn("match_rate", ratio(F.col("matched_loans"), F.col("total_loans")))
    limit = f"{threshold * 100:g}"
    reason = F.concat(
        F.lit(f"{subject} "), F.round(F.col("match_rate") * 100, 2).cast("string"), F.lit(f"% is below {limit}% threshold")
    )
    return stats.where(F.col("match_rate") < threshold).withColumn("failure_reason", reason)


# The rules of a record row.
RECORD_RULES = {
    "month_in_range": "month BETWEEN 1 AND 12",
    "accepted_is_flag": "accepted IN (0, 1)",
    "category_not_blank": "trim(category) <> ''",
    "item_not_blank": "trim(item) <> ''",
}


def run_checks(
    df: DataFrame,
    *,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
    rules: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """One row per check: check, failures, passed, in one pass over the rows.

    A row sends an entry for each check that it fails and for each of its values in a unique column; entries are counted
    per task before they are shuffled. A failing check of a row adds up; of a unique column, the values counted more than once do.
    """
    failing: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    failing |= {f"accepted:{c}": ~F.col(c).isin(*v) for c, v in (accepted or {}).items()}
    failing |= {f"rule:{n}": ~(F.expr(r) if isinstance(r, str) else r) for n, r in (rules or {}).items()}
    names = [*failing, *(f"unique:{c}" for c in unique)]
    if not names:
        raise ValueError("run_checks needs at least one check")
    # values keep their types: one field for each unique column, of which an entry fills its own
    fields = {f"v{i}": (c, df.schema[c].dataType) for i, c in enumerate(unique)}

    def entry(number: int, filled: str | None) -> Column:
        values = [F.col(c).alias(v) if v == filled else F.lit(None).cast(t).alias(v) for v, (c, t) in fields.items()]
        return F.struct(F.lit(number).alias("number"), *values)

    sent = [F.when(wrong, entry(i, None)) for i, wrong in enumerate(failing.values())]
    sent += [F.when(F.col(c).isNotNull(), entry(len(failing) + i, v)) for i, (v, (c, _)) in enumerate(fields.items())]
    counted = (df.select(F.explode(F.array_compact(F.array(*sent))).alias("e")).select("e.*")
               .groupBy("number", *fields).agg(F.count("*").alias("n")))
    found = counted.groupBy("number").agg(
        F.sum(F.when(F.col("number") < len(failing), F.col("n")).otherwise((F.col("n") > 1).cast("long"))).alias("failures"))
    every = F.explode(F.array(*[F.struct(F.lit(i).alias("number"), F.lit(n).alias("check")) for i, n in enumerate(names)]))
    listed = df.sparkSession.range(1).select(every.alias("e")).select("e.*")
    return listed.join(found, "number", "left").select(
        "check", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"), (F.coalesce("failures", F.lit(0)) == 0).alias("passed"))
