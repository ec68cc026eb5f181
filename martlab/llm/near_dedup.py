"""Near duplicates of whole documents by probability Jaccard of weighted shingles.

A document is the distribution of its five-word shingles (weight: occurrences). ProbMinHash draws for each shingle a Poisson
process whose rate is the weight, and keeps for each of m registers the shingle of the first arrival; two documents agree in a
register with a probability equal to their probability Jaccard. Arrivals of all shingles are handled in rounds, the n-th
arrivals in round n; a shingle takes no further part once its last arrival is later than the latest register, which ends the rounds early.

Registers are cut into bands chosen for recall; documents that share a band are compared by register agreement, and
the survivors exactly from their texts. Documents with equal shingle counts are one thing from the start, so copies form no pairs.

Defined cases: a text of one to four words has one shingle, all its words; null, empty and blank texts have none and are never
duplicates of anything; a class is named by its least doc_id; rows with one id are
one document, and each row is classed by its own text; a row without a doc_id takes
no part and stays; further columns are ignored by the search and kept by the filter; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, build_filter, filter_width, in_filter, slices
from .nearlinks import bands_and_rows, linked_classes
from .shingles import flat_words, mix, runs, weighted_sets

SIMILARITY = 0.8
RECALL = 0.9999
BANDS, ROWS = bands_and_rows(SIMILARITY, RECALL, range(2, 7), most=32)
REGISTERS = BANDS * ROWS
# five standard deviations of the agreement of two documents at the similarity
SURELY_LESS = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
ROUND = np.uint64(0x9E3779B97F4A7C15)


def uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def registers(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """ProbMinHash: for each text, the shingle whose process arrives first at each register."""
    first = np.full((texts, REGISTERS), np.inf)
    held = np.zeros((texts, REGISTERS), np.uint64)
    alive = np.arange(len(hashes))
    time = np.zeros(len(hashes))
    state = hashes.copy()
    while len(alive):
        state[alive] = mix(state[alive] + ROUND)
        time[alive] -= np.log(uniform(state[alive])) / weights[alive]
        slot = (mix(state[alive] ^ ROUND) % np.uint64(REGISTERS)).astype(np.int64)
        at = owner[alive] * REGISTERS + slot
        order = np.lexsort((time[alive], at))
        at, who = at[order], alive[order]
        lead = np.ones(len(at), bool)
        lead[1:] = at[1:] != at[:-1]
        at, who = at[lead], who[lead]
        better = time[who] < first.ravel()[at]
        first.ravel()[at[better]] = time[who[better]]
        held.ravel()[at[better]] = hashes[who[better]]
        latest = first.max(1)
        alive = alive[time[alive] < latest[owner[alive]]]
    return held


def identity(hashes: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each text's shingle counts, whatever their order."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + counts.astype(np.uint64) * ROUND), dtype=np.uint64)])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]])


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row: identity of its shingle counts, one hash per band, one byte per register."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            n = part.num_rows
            owner, hashes, counts, bounds = weighted_sets(*runs(*flat_words(part.column("text"))))
            weights = counts.astype(np.float64)
            held = registers(owner, hashes, weights, n)
            bands = np.zeros((n, BANDS), np.uint64)
            for i in range(ROWS):  # the number of the band is part of its hash
                bands = mix(bands * ROUND + held[:, i::ROWS] + np.arange(BANDS, dtype=np.uint64))
            whole = identity(hashes, counts, bounds).view(np.int64)
            some = np.diff(bounds) > 0
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array(whole, mask=~some),
                pa.array([row.tobytes() for row in bands], pa.binary()),
                pa.array([row.tobytes() for row in (held & np.uint64(255)).astype(np.uint8)], pa.binary()),
            ], ["doc_id", "same", "bands", "marks"])


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact value from two sorted (hashes, counts): sum over shared x of 1 / sum over y of max(a_y / a_x, b_y / b_x)."""
    keys = np.union1d(a[0], b[0])
    p, q = np.zeros(len(keys)), np.zeros(len(keys))
    p[np.searchsorted(keys, a[0])], q[np.searchsorted(keys, b[0])] = a[1] / a[1].sum(), b[1] / b[1].sum()
    with np.errstate(divide="ignore"):
        order = np.argsort(q / p, kind="stable")
    p, q = p[order], q[order]
    p_until, q_after = np.cumsum(p), q.sum() - np.cumsum(q)
    shared = (p > 0) & (q > 0)
    return float((1 / (p_until[shared] / p[shared] + q_after[shared] / q[shared])).sum())


def pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    return hashes.tobytes() + counts.astype(np.int64).tobytes()


def alike(a: bytes, b: bytes) -> bool:
    """Whether the probability Jaccard of two packed texts reaches the similarity."""
    sets = []
    for cell in (a, b):
        both = np.frombuffer(cell, np.uint64)
        sets.append((both[:len(both) // 2], both[len(both) // 2:].astype(np.int64)))
    return probability_jaccard(*sets) >= SIMILARITY - 1e-12


def near_classes(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, same), classes (same, label) and links (u, v) between things with different shingle counts."""
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL")
    described = scratch.write(docs.mapInArrow(describe, "doc_id long, same long, bands binary, marks binary"))
    rows = scratch.write(described.select("doc_id", "same"))
    things = scratch.write(described.where("same IS NOT NULL").groupBy(F.col("same").alias("id")).agg(
        F.first("marks").alias("sketch"), F.first("bands").alias("bands"), F.min("doc_id").alias("holder")))
    scratch.drop(described)

    def contents(ids: DataFrame) -> DataFrame:
        wanted = scratch.write(things.select("id", "holder").join(ids, "id", "left_semi"))
        bits = build_filter(wanted.select(F.xxhash64("holder").alias("h")), "h", filter_width(wanted.count()))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = in_filter(bits, batch.column("h").to_numpy().view(np.uint64))
                for part in slices(batch.filter(pa.array(keep, pa.bool_())), "text"):
                    _, hashes, counts, at = weighted_sets(*runs(*flat_words(part.column("text"))))
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id"), pa.array(identity(hashes, counts, at).view(np.int64)),
                        pa.array([pack(hashes[i:j], counts[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary())], ["holder", "id", "content"])

        # most rows are left out before the shuffle; of rows with one id the one with the thing's shingles counts
        few = docs.withColumn("h", F.xxhash64("doc_id")).mapInArrow(packed, "holder long, id long, content binary")
        return few.join(wanted, ["holder", "id"], "left_semi").dropDuplicates(["id"]).select("id", "content")

    classes, links = linked_classes(spark, things.select("id", "sketch", "bands"), contents, alike, SURELY_LESS)
    return rows, classes.select(F.col("id").alias("same"), "label"), links


def classify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, links): every document with the least doc_id of its class.

    `links` counts only the links that built the components, not all similar texts; it depends on the order of hashes.
    """
    rows, classes, links = near_classes(spark, docs)
    scratch = Scratch(spark, "classes")
    labelled = scratch.write(rows.join(classes, "same", "left").select("doc_id", "same", F.coalesce("label", "same").alias("label")))
    least = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("class_id"))
    ends = links.select(F.explode(F.array("u", "v")).alias("same")).groupBy("same").agg(F.count("*").alias("links"))
    return (labelled.join(least, "label", "left").join(ends, "same", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links")))


def keep_one_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, without the documents that have one of less id in their class."""
    scratch = Scratch(spark, "firsts")
    extra = scratch.write(classify(spark, docs).where("doc_id <> class_id").select("doc_id").distinct())
    return docs.join(extra, "doc_id", "left_anti").select(docs.columns)


def op7_probminhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return classify(spark, spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "class_id")
