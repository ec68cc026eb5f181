"""Links between similar things from banded signatures, without all pairs of a bucket as rows and without losing a link.

Members of a bucket are first compared with one of them only, and after the links found so far are contracted to components once more
with another. Members of a bucket that are still in different components are compared inside tasks, where each brings its
contents: a large bucket goes in tiles of bounded size, a pair is looked at in the first bucket it shares, short sketches
leave out what is surely not similar, and the rest is decided by the contents. Only links leave the task. So every pair
that meets in a bucket is in one component, verified, or surely not similar.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, partitions

TILE, TILE_BYTES = 1024, 16 << 20
GROUP_BYTES = 16 << 20

Alike = Callable[[bytes, bytes], bool]


def as_rows(column: pa.Array, kind=np.uint8) -> np.ndarray:
    """Binary cells of equal length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def near_pairs(key: np.ndarray, labels: np.ndarray, sketch: np.ndarray, bands: np.ndarray, band: np.ndarray, least: float) -> np.ndarray:
    """Pairs of rows (sorted by key) of one key and two labels, whose sketches agree in `least` of their bytes and that share no earlier band."""
    found, rows, step = [np.zeros((0, 2), np.int64)], np.arange(len(key)), 1
    while len(rows := rows[rows + step < len(key)]):
        rows = rows[key[rows] == key[rows + step]]
        near = rows[labels[rows] != labels[rows + step]]
        for at in range(0, len(near), 16384):
            some = near[at:at + 16384]
            some = some[(sketch[some] == sketch[some + step]).mean(1) >= least]
            some = some[(bands[some] == bands[some + step]).argmax(1) == band[some]]
            found.append(np.stack([some, some + step], 1))
        step += 1
    return np.concatenate(found)


def compare_tiles(least: float, alike: Alike) -> Callable[[pa.Table], pa.Table]:
    """Links (u, v) among rows (key, band, id, label, sketch, bands, content)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("id", "ascending")]).combine_chunks()
        key, band, ids, labels = (table.column(c).to_numpy() for c in ("key", "band", "id", "label"))
        sketch, bands = as_rows(table.column("sketch")), as_rows(table.column("bands"), np.int64)
        content = table.column("content")
        cells: dict[int, bytes] = {}
        out = []
        for i, j in near_pairs(key, labels, sketch, bands, band, least):
            for x in (i, j):
                if x not in cells:
                    cells[x] = content[int(x)].as_py()
            if alike(cells[i], cells[j]):
                out.append(sorted((ids[i], ids[j])))
        found = np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    return run


def linked_classes(spark: SparkSession, things: DataFrame, contents: Callable[[DataFrame], DataFrame], alike: Alike,
                   least: float) -> tuple[DataFrame, DataFrame]:
    """Classes (id, label) and links (u, v) of distinct `things` (id, sketch, bands).

    `bands` holds one 64-bit hash a band as bytes; things with an equal hash in a band meet. `sketch` has one byte a register, and
    things that agree in a smaller share than `least` are surely not similar. `contents` gives (id, content) for a frame of ids, and
    `alike` decides on two contents. Ids without a link are in no class.
    """
    scratch = Scratch(spark, "links")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = as_rows(batch.column("bands"), np.int64)
                count = np.arange(table.shape[1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column("id").to_numpy(), len(count))), pa.array(np.tile(count, len(table))),
                    pa.array(table.ravel())], ["id", "band", "bucket"])

    bands = things.select("id", "bands").mapInArrow(opened, "id long, band long, bucket long")
    # a bucket with one member gives no pair; its extremes show that before anything is joined
    ends = scratch.write(bands.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("members"))
                         .where("first < last"))
    shared = scratch.write(bands.join(ends.select("bucket", "first", "members"), "bucket"))
    held = scratch.write(contents(shared.select("id").distinct()).join(things, "id"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                close = (as_rows(batch.column("su")) == as_rows(batch.column("sv"))).mean(1) >= least
                yield batch.select(["u", "v"]).filter(pa.array(close, pa.bool_()))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(a.as_py(), b.as_py()) for a, b in zip(batch.column("cu"), batch.column("cv"))]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda x, c: held.select(F.col("id").alias(x), F.col(c).alias(c[0] + x))
        close = scratch.write(pairs.join(side("u", "sketch"), "u").join(side("v", "sketch"), "v").mapInArrow(agree, "u long, v long"))
        return scratch.write(close.join(side("u", "content"), "u").join(side("v", "content"), "v").mapInArrow(decide, "u long, v long"))

    links = verify(shared.where("first < id").select(F.col("first").alias("u"), F.col("id").alias("v")).distinct())
    classes = scratch.write(components(spark, links))
    # in a bucket of two the pair has been compared, and `first` has been compared with all others
    large = scratch.write(shared.where("members > 2 AND id <> first").select("bucket", "band", "members", "id"))
    placed = large.join(classes, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rep = F.min_by(F.struct("id", "label"), F.xxhash64("id")).alias("rep")
    differ = placed.groupBy("bucket").agg(rep, F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    pairs = placed.join(differ.select("bucket", "rep"), "bucket").where("label <> rep.label").select(
        F.least("id", "rep.id").alias("u"), F.greatest("id", "rep.id").alias("v")).distinct()
    more = verify(pairs)
    classes, links = scratch.write(contract(spark, classes, more)), scratch.write(links.unionByName(more))

    placed = large.join(classes, "id", "left").withColumn("label", F.coalesce("label", "id"))
    size = held.select("id", F.length("content").alias("bytes"))
    mixed = (placed.join(size, "id").groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.sum("bytes").alias("bytes")).where("low < high")
        .select("bucket", F.greatest(F.lit(1), F.ceil(F.col("bytes") / TILE_BYTES)).alias("parts")))
    open_ = (placed.join(mixed, "bucket")
             .withColumn("tiles", F.greatest(F.ceil(F.col("members") / TILE), F.col("parts")).cast("long"))
             .withColumn("mine", F.pmod(F.xxhash64("id"), F.col("tiles")))
             .withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
             .select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "band", "id", "label"))
    open_ = scratch.write(open_)
    weight = open_.join(size, "id").agg(F.sum("bytes")).first()[0] or 0
    groups = max(partitions(spark), -(-weight // GROUP_BYTES))
    last = scratch.write(open_.join(held, "id").withColumn("g", F.pmod("key", F.lit(groups))).groupBy("g").applyInArrow(
        compare_tiles(least, alike), "u long, v long").distinct())
    links = scratch.write(links.unionByName(last).distinct())
    return contract(spark, classes, last), links


def contract(spark: SparkSession, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (id, label) after further links (u, v): components of the few labels that these join."""
    named = classes.select(F.col("id").alias("u"), F.col("label").alias("a"))
    ends = (links.join(named, "u", "left").join(named.withColumnsRenamed({"u": "v", "a": "b"}), "v", "left")
            .select(F.coalesce("a", "u").alias("u"), F.coalesce("b", "v").alias("v")))
    joined = components(spark, ends)
    ids = classes.unionByName(links.select(F.explode(F.array("u", "v")).alias("id"))
                              .join(classes, "id", "left_anti").distinct().select("id", F.col("id").alias("label")))
    return (ids.join(joined.select(F.col("id").alias("label"), F.col("label").alias("now")), "label", "left")
            .select("id", F.coalesce("now", "label").alias("label")))


def bands_and_rows(similarity: float, recall: float, rows: range = range(2, 9), most: int = 40) -> tuple[int, int]:
    """The most rows a band, with as many bands (up to `most`) as it takes to find a pair at `similarity` with `recall`."""
    best = None
    for r in rows:
        b, miss = 1, 1 - similarity ** r
        while miss ** b > 1 - recall:
            b += 1
        if b <= most:
            best = b, r
    return best
