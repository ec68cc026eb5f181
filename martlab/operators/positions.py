"""Row positions of a total order, and pages of it, without a window that holds all rows in one task.

Rows are dealt by ranges of the order and sorted inside each range, so a row's position is the number of rows in the
ranges before its own plus its place there. Only one count for each range reaches the driver.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlab.session import shared_folder

SLOT = "_slot"
ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in these bits


class Ordered:
    """A DataFrame written once in order of `order`, an order in which no two rows that differ may tie.

    Equal rows get neighbouring positions in any sequence. An empty input has no rows and no pages.
    """

    def __init__(self, df: DataFrame, *order: str | Column, ranges: int | None = None):
        spark = df.sparkSession
        if SLOT in df.columns:
            raise ValueError(f"the column name {SLOT} is taken")
        ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = f"{shared_folder(spark)}/ordered-{uuid.uuid4().hex}"
        placed = (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                  .withColumn(SLOT, F.monotonically_increasing_id()))
        placed.write.parquet(path)
        self.path, self.columns = path, df.columns
        self.stored = spark.read.schema(placed.schema).parquet(path)
        held = sorted((r["part"], r["n"]) for r in self.stored.groupBy(
            F.shiftright(SLOT, ROW_BITS).cast("int").alias("part")).agg(F.count("*").alias("n")).collect())
        self.before = dict(zip((part for part, _ in held), accumulate((n for _, n in held), initial=0), strict=False))
        self.sizes = dict(held)

    @property
    def total(self) -> int:
        return sum(self.sizes.values())

    def _numbered(self, stored: DataFrame, parts: list[int], name: str) -> DataFrame:
        offsets = stored.sparkSession.createDataFrame([(p, self.before[p]) for p in parts], "_part int, _before long")
        place = F.col(SLOT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        return (stored.withColumn("_part", F.shiftright(SLOT, ROW_BITS).cast("int")).join(offsets, "_part")
                .select(*self.columns, (F.col("_before") + place + 1).alias(name)))

    def rows(self, name: str = "position") -> DataFrame:
        """All rows with their position from 1."""
        return self._numbered(self.stored, list(self.sizes), name)

    def page(self, first: int, size: int, name: str = "position") -> DataFrame:
        """Rows at positions `first` to `first + size - 1`; the range of slots is a filter Parquet can use to skip files."""
        if first < 1 or size < 0:
            raise ValueError("a page starts at 1 or later and has no negative size")
        last, wanted = first + size - 1, F.lit(False)
        parts = [p for p in self.sizes if self.before[p] < last and self.before[p] + self.sizes[p] >= first]
        for p in parts:
            low, high = max(first - self.before[p], 1), min(last - self.before[p], self.sizes[p])
            wanted = wanted | F.col(SLOT).between((p << ROW_BITS) + low - 1, (p << ROW_BITS) + high - 1)
        return self._numbered(self.stored.where(wanted), parts, name)

    def drop(self) -> None:
        """Delete the written rows; nothing may read them any more."""
        spark = self.stored.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
