"""Substring dedup by paragraph MinHash banding.

Paragraphs are the lines of a text. Lines of at least `LINE_WORDS` words get MinHash bands tuned for recall; lines that collide
are compared by exact Jaccard of five-word shingles, and similar ones form components. Equal lines of any length are one thing.

A passage need not keep to lines. Of every `WINDOW` runs of `SEED` words in a row, over line feeds, the one with the least
hash is a seed, so any `RUN` equal words hold an equal seed wherever they stand. From one seed that stands in several documents to the next
the words between are one span, which repeats or not; at seeds where the span to a neighbour does not repeat, all
runs of `RUN` words round the seed are looked up, word by word. So a repeated passage of at least `RUN` words is found in its full length, and the inside
of a long one costs a row for each span only.

A line or run repeats when the first document that holds it, or one of its component, has a smaller doc_id. Repeating words
that touch are one passage; a passage of `PASSAGE_WORDS` words or more is taken out of the later documents and stays in the
first. So short common lines stay where they stand alone.

Nothing is compared within a group of equal lines or runs: each has one least doc_id, summed per task before the shuffle.

Defined cases: null, empty and blank texts have no paragraphs and stay as they are; repeats inside one document stay; rows with one id are one
document as a source, but each row loses words by its own text; rows without an id stay as they are; further columns are kept; empty input
gives no rows. Words are compared in lower case by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import Scratch, build_filter, filter_width, in_filter, slices
from .nearlinks import bands_and_rows, linked_classes
from .shingles import PLACE, flat_words, mix, runs, weighted_sets

SIMILARITY = 0.8
BANDS, ROWS = bands_and_rows(SIMILARITY, 0.999, range(2, 4), most=16)
# five standard deviations of the agreement of two lines at the similarity
SURELY_LESS = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / (BANDS * ROWS)) ** 0.5
LINE_WORDS = 9  # below five shingles no other set reaches the similarity
PASSAGE_WORDS = 30
RUN, SEED = 40, 16
WINDOW = RUN - SEED + 1
_rng = np.random.default_rng(8)
FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
TERMS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines and the number of the text that each belongs to."""
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.string()), ""), "\n")
    at = lists.offsets.to_numpy()
    return lists.flatten(), np.repeat(np.arange(len(texts)), np.diff(at))


def span_sums(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, salt: int) -> np.ndarray:
    """Hash of each run of words, by their order."""
    place = np.arange(len(hashes), dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes, dtype=np.uint64)])
    moments = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * place, dtype=np.uint64)])
    mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes), dtype=np.uint64)])
    total = sums[stop] - sums[start]
    ordered = (moments[stop] - moments[start]) - (mixed[stop] - mixed[start]) * start.astype(np.uint64)
    return mix(total ^ mix(ordered + (stop - start).astype(np.uint64) * np.uint64(2 * salt + 1)))


class Parts:
    """Words, lines, seeds and runs of the texts of a batch; places are words from the start of the batch."""

    def __init__(self, texts: pa.Array):
        self.lines, self.owner = lines_of(texts)
        self.words, self.bounds = flat_words(self.lines)
        self.count = np.diff(self.bounds)
        per_text = np.bincount(self.owner, self.count, len(texts)).astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(per_text)])
        self.line_hash = span_sums(self.words, self.bounds[:-1], self.bounds[1:], 1)
        self.text_of = np.repeat(np.arange(len(texts)), per_text)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of the seeds: of each window of run hashes the least, ties by place."""
        n = len(self.words) - SEED + 1
        if n < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for i in range(SEED):
            total += self.words[i:i + n] * PLACE[i]
        hashes = mix(total)
        # the place modulo 256 rides in the low bits, so the least value tells where it stands
        least, width = (hashes & ~np.uint64(255)) | (np.arange(n) & 255).astype(np.uint64), 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        start = np.arange(len(least))
        place = start + (((least & np.uint64(255)).astype(np.int64) - start) & 255)
        # a window must lie in one text
        inside = self.text_of[start] == self.text_of[start + RUN - 1]
        place = np.unique(place[inside])
        return place, hashes[place]

    def spans(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the first seed, start, stop) from each seed to the next one of its text that begins within a window."""
        at = np.flatnonzero((np.diff(seeds) <= WINDOW) & (self.text_of[seeds[:-1]] == self.text_of[seeds[1:]])) if len(seeds) else seeds
        return at, seeds[at], seeds[at + 1] + SEED if len(at) else at

    def runs_at(self, seeds: np.ndarray) -> np.ndarray:
        """Places where a run starts that holds one of the seeds and lies in one text."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, np.maximum(seeds - (WINDOW - 1), 0), 1)
        np.add.at(edge, seeds + 1, -1)
        place = np.flatnonzero(np.cumsum(edge)[:len(self.words)] > 0)
        place = place[place + RUN <= len(self.words)]
        return place[self.text_of[place] == self.text_of[place + RUN - 1]]


def texts_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Parts]]:
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            yield part, Parts(part.column("text"))


def parts_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, low, high): lines and seeds, once for each batch, with the least and greatest doc_id there."""
    for part, p in texts_in(batches):
        doc = part.column("doc_id").to_numpy()
        full = np.flatnonzero(p.count)
        place, seeds = p.seeds()
        hashes = np.concatenate([p.line_hash[full], seeds])
        docs = np.concatenate([doc[p.owner[full]], doc[p.text_of[place]]])
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        end = np.concatenate([new[1:], [len(hashes)]]) - 1 if len(new) else new
        yield pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64)), pa.array(docs[new]), pa.array(docs[end])], ["hash", "low", "high"])


def line_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, bands, sketch) of the longer lines, equal ones once for each batch."""
    for _, p in texts_in(batches):
        long_ = np.flatnonzero(p.count >= LINE_WORDS)
        long_ = long_[np.unique(p.line_hash[long_], return_index=True)[1]]
        long_.sort()
        if not len(long_):
            continue
        keep = np.zeros(len(p.count), bool)
        keep[long_] = True
        shingles, at = runs(p.words[np.repeat(keep, p.count)], np.concatenate([[0], np.cumsum(p.count[long_])]))
        table, marks = np.empty((len(long_), BANDS), np.uint64), np.empty((len(long_), BANDS * ROWS), np.uint8)
        for band in range(BANDS):
            key = np.full(len(long_), band, np.uint64)
            for i in range(band * ROWS, band * ROWS + ROWS):
                least = mix(np.minimum.reduceat(shingles * FACTORS[i] + TERMS[i], at[:-1]))
                key, marks[:, i] = mix(key + least), (least & np.uint64(255)).astype(np.uint8)
            table[:, band] = key
        yield pa.RecordBatch.from_arrays([
            pa.array(p.line_hash[long_].view(np.int64)), pa.array([row.tobytes() for row in table], pa.binary()),
            pa.array([row.tobytes() for row in marks], pa.binary())], ["id", "bands", "sketch"])


def alike(a: bytes, b: bytes) -> bool:
    """Whether the exact Jaccard of two lines' shingle sets reaches the similarity."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILARITY * (len(x) + len(y) - both)


def similar_lines(spark: SparkSession, scratch: Scratch, docs: DataFrame) -> DataFrame:
    """(id, label): components of similar lines."""
    things = scratch.write(docs.select("text").mapInArrow(line_bands, "id long, bands binary, sketch binary").dropDuplicates(["id"]))

    def contents(ids: DataFrame) -> DataFrame:
        wanted = scratch.write(ids)
        bits = build_filter(wanted, "id", filter_width(wanted.count()))

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    lines, _ = lines_of(part.column("text"))
                    words, bounds = flat_words(lines)
                    hashes = span_sums(words, bounds[:-1], bounds[1:], 1)
                    keep = np.flatnonzero(in_filter(bits, hashes) & (np.diff(bounds) >= LINE_WORDS))
                    keep = keep[np.unique(hashes[keep], return_index=True)[1]]
                    _, shingles, _, at = weighted_sets(*runs(*flat_words(lines.take(pa.array(keep)))))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(hashes[keep].view(np.int64)),
                        pa.array([shingles[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())], ["id", "content"])

        return docs.select("text").mapInArrow(fetch, "id long, content binary").join(wanted, "id", "left_semi").dropDuplicates(["id"])

    classes, _ = linked_classes(spark, things, contents, alike, SURELY_LESS)
    classes = scratch.write(classes)
    scratch.drop(things)
    return classes


def repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first, last, source): words to take out of a row, and a document where they stay."""
    scratch = Scratch(spark, "repeats")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    classes = similar_lines(spark, scratch, docs)
    again = scratch.write(docs.mapInArrow(parts_held, "hash long, low long, high long").groupBy("hash").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("hash"))
    wanted = scratch.write(again.unionByName(classes.select(F.col("id").alias("hash"))))
    bits = build_filter(wanted, "hash", filter_width(wanted.count()))
    scratch.drop(again)

    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    schema = "hash long, doc_id long, text_hash long, first int, last int"

    def batch_of(part: pa.RecordBatch, p: Parts, hashes: np.ndarray, of: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(hashes.view(np.int64)), part.column("doc_id").take(pa.array(of)), part.column("text_hash").take(pa.array(of)),
            pa.array((first - p.base[of]).astype(np.int32)), pa.array((last - p.base[of]).astype(np.int32))],
            ["hash", "doc_id", "text_hash", "first", "last"])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines that may repeat and the spans between seeds that may."""
        for part, p in texts_in(batches):
            full = np.flatnonzero(p.count)
            full = full[in_filter(bits, p.line_hash[full])]
            place, seeds = p.seeds()
            _, start, stop = p.spans(place[in_filter(bits, seeds)])
            yield batch_of(part, p, np.concatenate([p.line_hash[full], span_sums(p.words, start, stop, 2)]),
                           np.concatenate([p.owner[full], p.text_of[start]]).astype(np.int64),
                           np.concatenate([p.bounds[:-1][full], start]), np.concatenate([p.bounds[1:][full], stop]))

    coarse = scratch.write(rows.mapInArrow(units, schema))
    ends = lambda df: df.groupBy("hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    found = scratch.write(ends(coarse))
    held, alone = found.where("least < most"), found.where("least = most")
    # a filter never misses what is in it, so every span that does not repeat is known; a few more may look alike
    open_ = build_filter(alone, "hash", filter_width(alone.count()))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All runs round seeds that have no repeating span on one side."""
        for part, p in texts_in(batches):
            place, seeds = p.seeds()
            place = place[in_filter(bits, seeds)]
            at, start, stop = p.spans(place)
            same = at[~in_filter(open_, span_sums(p.words, start, stop, 2))]
            sides = np.zeros(len(place), np.int64)
            sides[same] += 1
            sides[same + 1] += 1
            run = p.runs_at(place[sides < 2])
            yield batch_of(part, p, span_sums(p.words, run, run + RUN, 3), p.text_of[run].astype(np.int64), run, run + RUN)

    fine = scratch.write(rows.mapInArrow(edges, schema))
    # a component stays in the document that has any of its lines first
    named = found.join(classes.withColumnRenamed("id", "hash"), "hash")
    heads = named.groupBy("label").agg(F.min("least").alias("source"))
    of_lines = scratch.write(named.join(heads, "label").select("hash", "source"))
    exact = held.select("hash", F.col("least").alias("source")).join(of_lines, "hash", "left_anti")
    sources = exact.unionByName(of_lines)
    later = lambda df, sources: df.join(sources, "hash").where("source < doc_id").select("doc_id", "text_hash", "first", "last", "source")
    return later(coarse, sources).unionByName(later(fine, ends(fine).where("least < most").select("hash", F.col("least").alias("source"))))


def passages(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, sources): the passages of each row, repeating words that touch or overlap being one."""
    row = ["doc_id", "text_hash"]
    spans = found.groupBy(*row, "first").agg(F.max("last").alias("last"), F.min("source").alias("source"))
    inside = Window.partitionBy(*row).orderBy("first")
    before = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.when(F.col("first") <= before, 0).otherwise(1))
    merged = (opened.withColumn("n", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*row, "n").agg(F.min("first").cast("long").alias("first"), F.max("last").cast("long").alias("last"),
                                      F.collect_set("source").alias("of"))
              .where(F.col("last") - F.col("first") >= PASSAGE_WORDS))
    return merged.groupBy(*row).agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("of")))).alias("sources"))


def take_out(text: str, first: list[int], last: list[int]) -> str:
    """A text without the words of the spans; a line that loses all its words goes with its line feed.

    Lines that keep all words keep every character; in a line that loses some, the others are joined by one space.
    """
    lines = text.split("\n")
    words = pc.utf8_split_whitespace(pa.array(lines)).to_pylist()
    words = [[w for w in line if w] for line in words]
    gone = np.zeros(sum(map(len, words)), bool)
    for a, b in zip(first, last):
        gone[a:b] = True
    out, place = [], 0
    for line, of in zip(lines, words):
        lost = gone[place:place + len(of)]
        place += len(of)
        if not lost.any():
            out.append(line)
        elif not lost.all():
            out.append(" ".join(w for w, x in zip(of, lost) if not x))
    return "\n".join(out)


@F.pandas_udf(StringType())
def without(text: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([t if a is None else take_out(t, a, b) for t, a, b in zip(text, first, last)], dtype=object)


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`docs` with repeated passages taken out of `text`; all columns and rows stay."""
    scratch = Scratch(spark, "passages")
    found = scratch.write(passages(repeats(spark, docs)).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans.first").alias("_first"), F.col("spans.last").alias("_last")))
    joined = docs.join(found, (docs["doc_id"] == found["_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["_hash"]), "left")
    changed = F.when(F.col("_first").isNotNull(), without("text", "_first", "_last")).otherwise(F.col("text"))
    return joined.select(*[changed.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op8_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that loses passages: words and spans taken out, documents that keep them, and what is left."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = Scratch(spark, "passages").write(passages(repeats(spark, docs)))
    return docs.withColumn("text_hash", F.xxhash64("text")).join(found, ["doc_id", "text_hash"]).select(
        "doc_id",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]).alias("n_removed"),
        F.size("spans").alias("n_spans"), "sources",
        without("text", F.col("spans.first"), F.col("spans.last")).alias("text"))
