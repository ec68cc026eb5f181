"""Sharding by best-fit-decreasing bin packing.

Documents with equal texts form a group that stays together. Groups larger than a grain (a small fraction of the
total, so there is a fixed greatest number of them) are items of their own; all other groups ride in one of a fixed
number of bundles by their hash. The items, at most `shards * grains * 2` of them, enter bins in decreasing order of
size, each the bin with the least room that still holds it, found in a balanced tree of bins by room. For a given
number of shards the capacity is the least one, by bisection, for which that many bins are enough.

A group larger than a bin may be is dealt out first by document id into pieces of a grain, so one huge group cannot
make a shard too large. Only sizes by item reach the driver.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

GRAINS = 1024  # bundles for each shard


class RoomTree:
    """Bins ordered by (room, bin) in a balanced tree (a treap with seeded priorities)."""

    def __init__(self, seed: int = 1):
        self.root, self.draw = None, random.Random(seed).random

    def add(self, room: int, bin_: int) -> None:
        low, high = self._split(self.root, (room, bin_))
        self.root = self._join(self._join(low, [(room, bin_), self.draw(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room of at least `size`."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node, above = high, None
        while node[2] is not None:
            above, node = node, node[2]
        if above is None:
            high = node[3]
        else:
            above[2] = node[3]
        self.root = self._join(low, high)
        return node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high


def best_fit_decreasing(sizes: list[int], capacity: int, most_bins: int | None = None) -> list[int] | None:
    """Bin of each item in bins of fixed capacity; None if an item or the number of bins does not fit."""
    bins, tree, used = [0] * len(sizes), RoomTree(), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] > capacity:
            return None
        found = tree.take_tightest(sizes[i])
        if found is None:
            if used == most_bins:
                return None
            found, used = (capacity, used), used + 1
        bins[i] = found[1]
        tree.add(found[0] - sizes[i], found[1])
    return bins


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Best-fit-decreasing into `shards` bins of the least capacity for which it succeeds."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // shards))
    high = low + max(sizes)
    while (best := best_fit_decreasing(sizes, high, shards)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        bins = best_fit_decreasing(sizes, middle, shards)
        if bins is None:
            low = middle + 1
        else:
            best, high = bins, middle
    return best


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + F.lit(1)


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 8, grains: int = GRAINS) -> DataFrame:
    """(doc_id, size, text_crc32, group, shard, slot) for every row of `docs` (doc_id, text).

    `size` is the UTF-8 length plus one. Slots number a shard's rows from 0 without gaps. Null and empty texts have
    size 1 and are two groups; rows may repeat and ids may be null: each row gets a slot of its own. Other columns are
    ignored. Empty input gives no rows.
    """
    scratch = Scratch(spark, "packing")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = scratch.write(docs.select(
        "doc_id", size_of().alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col("text").isNull(), text).alias("group")))
    groups = scratch.write(rows.groupBy("group").agg(F.sum("size").alias("size")))
    total = groups.agg(F.sum("size")).first()[0] or 0
    bundles = shards * grains
    grain = max(1, total // bundles)

    wide = max(1, total // shards)
    whole = F.col("size") <= wide
    # at most `shards` groups exceed a shard and at most `bundles` a grain, whatever the number of groups
    huge = {row["group"]: -(-row["size"] // grain) for row in groups.where(~whole).collect()}
    large = [tuple(row) for row in groups.where(whole & (F.col("size") > grain)).select("group", "size").collect()]
    small = groups.where(F.col("size") <= grain).select(
        F.pmod("group", F.lit(bundles)).alias("bundle"), "size").groupBy("bundle").agg(F.sum("size").alias("size"))
    small = [tuple(row) for row in small.collect()]
    pieces = []
    piece_of = F.lit(None).cast("long")
    for group, count in huge.items():
        mine = F.col("group") == F.lit(group)
        piece_of = F.when(mine, F.pmod(F.xxhash64("doc_id"), F.lit(count))).otherwise(piece_of)
    if huge:
        pieces = [tuple(row) for row in rows.where(F.col("group").isin(list(huge)))
                  .groupBy("group", piece_of.alias("piece")).agg(F.sum("size").alias("size")).collect()]

    items = ([("group", g, 0, s) for g, s in large] + [("piece", g, p, s) for g, p, s in pieces]
             + [("bundle", b, 0, s) for b, s in small])
    bins = pack_into([i[3] for i in items], shards)
    places = spark.createDataFrame([(*i[:3], b) for i, b in zip(items, bins)], "kind string, key long, piece long, shard int")
    big_keys = F.broadcast(places.where("kind = 'group'").select(F.col("key").alias("group"), F.col("shard").alias("big")))
    bundle_keys = F.broadcast(places.where("kind = 'bundle'").select(
        F.col("key").alias("bundle"), F.col("shard").alias("shared")))
    piece_keys = F.broadcast(places.where("kind = 'piece'").select(
        F.col("key").alias("group"), "piece", F.col("shard").alias("part")))
    placed = scratch.write(
        rows.withColumns({"piece": piece_of, "bundle": F.pmod("group", F.lit(bundles)),
                          "lot": F.pmod(F.xxhash64("doc_id", "group", F.monotonically_increasing_id()), F.lit(bundles))})
        .join(big_keys, "group", "left").join(piece_keys, ["group", "piece"], "left").join(bundle_keys, "bundle", "left")
        .select("doc_id", "size", "text_crc32", "group", "lot", F.coalesce("big", "part", "shared").alias("shard")))
    # at most shards * bundles counts; a lot's rows are numbered in one task, its offset comes from the counts
    counts = sorted(tuple(r) for r in placed.groupBy("shard", "lot").count().collect())
    offsets, last, next_slot = [], None, 0
    for shard, lot, n in counts:
        next_slot = next_slot if shard == last else 0
        offsets.append((shard, lot, next_slot))
        last, next_slot = shard, next_slot + n
    offsets = F.broadcast(spark.createDataFrame(offsets, "shard int, lot long, slot_offset long"))
    numbered = placed.withColumn("in_lot", F.row_number().over(Window.partitionBy("shard", "lot").orderBy("doc_id", "group")))
    return (numbered.join(offsets, ["shard", "lot"])
            .select("doc_id", "size", "text_crc32", "group", "shard",
                    (F.col("slot_offset") + F.col("in_lot") - 1).cast("long").alias("slot")))


def op3_best_fit_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return shard_documents(spark, docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
