"""Dashboard panels over the record table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import decimals_text, yes_no


def month_trend(records: DataFrame) -> DataFrame:
    return records.groupBy("month").agg(F.avg("value").alias("avg_value")).orderBy("month")


def item_breakdown(records: DataFrame) -> DataFrame:
    return records.groupBy("item").agg(F.avg("value").alias("avg_value")).orderBy("item")


def top_items(records: DataFrame, n: int = 8) -> DataFrame:
    """Items with the highest mean value, with accepted and total counts; ties go by name."""
    per_item = records.groupBy("item").agg(
        F.avg("value").alias("avg_value"), F.sum("accepted").alias("accepted"), F.count("id").alias("total")
    )
    best = per_item.orderBy(F.col("avg_value").desc_nulls_last(), F.col("item").asc()).limit(n)
    return best.withColumn("avg_value_text", decimals_text("avg_value"))


def acceptance_by_category(records: DataFrame) -> DataFrame:
    """Accepted share per category with one decimal, halves to even."""
    per_category = records.groupBy("category").agg(
        F.sum("accepted").alias("accepted_cnt"), F.count("id").alias("total_cnt")
    )
    share = F.bround(F.try_divide(F.col("accepted_cnt") * 100.0, F.col("total_cnt")), 1)
    shown = per_category.withColumn("accepted_pct", share)
    return shown.withColumn("accepted_pct_text", decimals_text("accepted_pct", 1)).orderBy("category")


def review_grid(records: DataFrame) -> DataFrame:
    """Records as display text for the review table."""
    return records.select(
        "id", "category", "month", "item", decimals_text("value").alias("value_text"), yes_no("accepted").alias("accepted_text")
    )
