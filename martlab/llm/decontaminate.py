"""Benchmark decontamination: containment search with size-partitioned MinHash sketches, verified exactly.

An item is contained in a document when at least `containment` of its distinct five-word shingles occur there. Items
are partitioned by their number of shingles (powers of two). An item's sketch is its bottom-k MinHash: the k shingles of
least hash. An item with q shingles may lack m = floor((1 - containment) * q) of them, and k is m + 1 for the largest q
of its size class (or q itself), so a document that contains the item holds at least k - m shingles of the sketch: the search loses
nothing, however long the document is, and needs no MinHash of the document.

An item of one to four words has one shingle, all its words; documents are then also looked up by their runs of as many words.

Documents are read twice and no text is shuffled. The first pass looks up their shingles in a bit filter of fixed
size that holds the sketches and joins the hits with the sketches; documents with enough hits of an item are candidates. The second pass
does the same with all shingles of the candidates' items and counts exact containment for the candidate pairs.

Defined cases: null and empty texts contain nothing and an item without words matches nothing;
items with equal texts all match; a repeated document row with one id counts once; rows with a null doc_id are never
flagged and kept; further columns are ignored; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, build_filter, filter_width, in_filter, slices
from .shingles import WORDS, flat_words, runs, weighted_sets, word_runs

CONTAINMENT = 0.8


def shingle_rows(rows: DataFrame, key: str, bits: np.ndarray | None = None, short: bool = False, lengths: tuple[int, ...] = ()) -> DataFrame:
    """(key, shingle): the distinct shingles of each row's text that a bit filter lets through.

    With `short` a text of one to four words has one shingle, all its words; `lengths` adds all runs of so many words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, bounds = flat_words(part.column("text"))
                owner, hashes, _, _ = weighted_sets(*runs(words, bounds, short=short))
                keys = part.column(key).to_numpy(zero_copy_only=False)
                for hashes, owner in [(hashes, owner), *(word_runs(words, bounds, n) for n in lengths)]:  # noqa: B020, PLR1704
                    if bits is not None:
                        found = in_filter(bits, hashes)
                        owner, hashes = owner[found], hashes[found]
                    once = np.unique(np.stack([owner.astype(np.int64), hashes.view(np.int64)], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[once[:, 0]]), pa.array(once[:, 1])], [key, "shingle"])

    return rows.select(F.col(key).cast("long"), F.col("text").cast("string")).where(
        f"{key} IS NOT NULL AND text IS NOT NULL").mapInArrow(run, f"{key} long, shingle long")


def short_lengths(items: DataFrame) -> tuple[int, ...]:
    """The numbers of words, below five, that items have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = np.diff(flat_words(batch.column("text"))[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(count[(count > 0) & (count < WORDS)]))], ["n"])

    return tuple(sorted(r["n"] for r in items.select(F.col("text").cast("string")).mapInArrow(run, "n long").distinct().collect()))


def spare(size: Column, containment: float) -> Column:
    """Shingles an item of this size may lack; worked out in whole numbers."""
    share = Fraction(str(containment))
    return size - F.ceil(size * F.lit(share.numerator) / F.lit(share.denominator)).cast("long")


def contained_items(spark: SparkSession, docs: DataFrame, items: DataFrame,
                    containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, shared, size): every pair where the document contains the item."""
    scratch = Scratch(spark, "contained")
    shingles = scratch.write(shingle_rows(items.select("item_id", "text"), "item_id", short=True).distinct())
    lengths = short_lengths(items)
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("size"))
    ranked = shingles.join(sizes, "item_id").withColumns({
        "class_top": F.expr("shiftleft(1L, cast(ceil(log2(size)) as int))"),
        "rank": F.expr("row_number() OVER (PARTITION BY item_id ORDER BY xxhash64(shingle), shingle)")})
    sketches = scratch.write(
        ranked.withColumn("sketch", F.least("size", spare(F.col("class_top"), containment) + 1))
        .where("rank <= sketch")
        .select("item_id", "shingle", (F.col("sketch") - spare(F.col("size"), containment)).alias("needed"), "size"))
    hits = shingle_rows(docs, "doc_id", build_filter(sketches, "shingle", filter_width(sketches.count())), lengths=lengths).join(sketches, "shingle")
    candidates = scratch.write(
        hits.groupBy("doc_id", "item_id").agg(F.count_distinct("shingle").alias("hits"), F.first("needed").alias("needed"),
                                              F.first("size").alias("size"))
        .where("hits >= needed").select("doc_id", "item_id", "size"))
    wanted = scratch.write(shingles.join(candidates.select("item_id").distinct(), "item_id", "left_semi"))
    found = (shingle_rows(docs, "doc_id", build_filter(wanted, "shingle", filter_width(wanted.count())), lengths=lengths).join(wanted, "shingle")
             .groupBy("doc_id", "item_id").agg(F.count_distinct("shingle").alias("shared")))
    share = Fraction(str(containment))
    return found.join(candidates, ["doc_id", "item_id"]).where(
        F.col("shared") * share.denominator >= F.col("size") * share.numerator)


def remove_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of `docs` that contain no item, with all their columns."""
    scratch = Scratch(spark, "clean")
    dirty = scratch.write(contained_items(spark, docs, items).select("doc_id").distinct())
    return docs.join(dirty, "doc_id", "left_anti").select(docs.columns)


def op5_minhash_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds benchmark items, with the items: doc_id, item_id, shared, size, containment."""
    pairs = contained_items(spark, spark.read.parquet(f"{folder}/documents.parquet"),
                            spark.read.parquet(f"{folder}/benchmark.parquet"))
    return pairs.select("doc_id", "item_id", "shared", "size", (F.col("shared") / F.col("size")).alias("containment"))
