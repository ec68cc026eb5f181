"""Ranked lexical search for many items at once, sharing the work of equal term sets.

Items are taken in groups whose terms number a bounded amount. For a group, shared term sets are mined as in grammar compression: each item is
the list of its terms, most shared first; the pairs of neighbours that occur in several items become new nodes, most frequent
first, and this is repeated on the shortened lists until no pair is shared. The nodes form a directed acyclic graph: a node
is the sum of two others, an item the sum of its last nodes, and items with equal term sets share everything.

One pass over the documents counts their terms and keeps those any item asks for; collection sums follow from that. A second pass
goes over that table in small batches of documents: an accumulator of partial scores is filled for each term, then once for each node of the graph
from its two parts, and each item adds up its last nodes. A task holds the best `k` of each item over all its batches, and the best of all
tasks are ranked at the end. Scores are whole numbers, so the order of addition does not matter.

Defined cases: a null or empty text has no term and is no document; an item without terms, or whose terms no document has,
has no rows; rows that share an item_id are one item with the terms of all of them, as are rows without item_id; every row of
the documents is a document of its own, also equal rows; equal scores are ordered by doc_id, null last; further columns
are ignored; empty tables give no rows. A score beyond 64 bits is not reached by less than 3 * 10 ** 8 terms an item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

# Fixed values of the contract: all but ASCII letters, ASCII digits and what is not ASCII divides terms; A to Z are lower-cased.
# In UTF-8 all bytes of a character that is not ASCII are above 0x7F, so bytes can be mapped one by one.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
GROUP_TERMS = 1 << 18  # the most terms of a group of items, unless one item has more
CELLS = 1 << 21  # accumulator cells of a batch of documents
TOP = 10


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


class Plan:
    """Shared sums for a group of items: `left` and `right` of each node above the terms, and the last nodes of each item."""

    def __init__(self, wanted: list[list[bytes]]):
        self.terms = sorted({t for item in wanted for t in item})
        self.leaf = {t: i for i, t in enumerate(self.terms)}
        lists = [[self.leaf[t] for t in set(item)] for item in wanted]
        left, right, depth = [], [], [0] * len(self.terms)
        while True:
            shared = Counter(n for nodes in lists for n in nodes)
            for nodes in lists:
                nodes.sort(key=lambda n: (-shared[n], n))  # one order for all lists, so shared terms meet
            pairs = Counter(p for nodes in lists for p in pairwise(nodes))
            made: dict[tuple[int, int], int] = {}
            for nodes in lists:
                # the most frequent pair first; a node goes into one pair
                for _, j in sorted((-pairs[p], j) for j, p in enumerate(pairwise(nodes)) if pairs[p] > 1):
                    pair = nodes[j], nodes[j + 1]
                    if None in pair or (pair not in made and pairs[pair] < 2):
                        continue
                    if pair not in made:
                        made[pair] = len(depth)
                        left.append(pair[0])
                        right.append(pair[1])
                        depth.append(1 + max(depth[pair[0]], depth[pair[1]]))
                    nodes[j:j + 2] = [None, -made[pair] - 1]
                nodes[:] = [-n - 1 if n < 0 else n for n in nodes if n is not None]
            if not made:
                break
        self.left, self.right, self.depth = (np.array(x, np.int64) for x in (left, right, depth))
        self.last = lists
        # additions for a document with and without sharing
        self.additions = len(left) + sum(max(len(nodes) - 1, 0) for nodes in lists)
        self.plain = sum(max(len(set(item)) - 1, 0) for item in wanted)

    def levels(self) -> list[np.ndarray]:
        """Nodes above the terms by depth: all parents of a level are in earlier ones."""
        n = len(self.terms)
        return [n + np.flatnonzero(self.depth[n:] == d) for d in range(1, int(self.depth.max(initial=0)) + 1)]

    def scores(self, ids: np.ndarray, docs: np.ndarray, parts: np.ndarray, count: int) -> np.ndarray:
        """Items x documents: `parts` are the partial scores of terms `ids` in documents `docs` (0 to count - 1)."""
        n = len(self.terms)
        sums = np.zeros((len(self.depth), count), np.int64)
        sums[ids, docs] = parts
        for level in self.levels():
            sums[level] = sums[self.left[level - n]] + sums[self.right[level - n]]
        return np.array([sums[nodes].sum(0) if nodes else np.zeros(count, np.int64) for nodes in self.last])


class Best:
    """The k best (score, document) of each item so far; equal scores by doc_id, null last."""

    def __init__(self, items: int, k: int):
        self.score = np.zeros((items, k), np.int64)
        self.none = np.ones((items, k), bool)
        self.doc = np.zeros((items, k), np.int64)

    def add(self, scores: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        kth, kth_none, kth_doc = self.score[:, -1:], self.none[:, -1:], self.doc[:, -1:]
        earlier = (none < kth_none) | ((none == kth_none) & (doc < kth_doc))
        better = (scores > kth) | ((scores == kth) & (scores > 0) & earlier)
        for item in np.flatnonzero(better.any(1)):
            mine = np.flatnonzero(better[item])
            score = np.concatenate([self.score[item], scores[item, mine]])
            no, at = np.concatenate([self.none[item], none[mine]]), np.concatenate([self.doc[item], doc[mine]])
            top = np.lexsort((at, no, -score))[:self.score.shape[1]]
            self.score[item], self.none[item], self.doc[item] = score[top], no[top], at[top]


def items_of(table: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column("text")]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array([t for f in found for t in f], pa.binary())], ["item_id", "term"])

    return (table.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(split, "item_id long, term binary").distinct()
            .groupBy("item_id").agg(F.collect_list("term").alias("terms")))


def search_group(scratch: Scratch, docs: DataFrame, ids: list[int | None], plan: Plan, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best documents of each task for each item of a group."""
    spark = scratch.spark
    leaf = spark.sparkContext.broadcast(plan.leaf)  # at most GROUP_TERMS terms, or one item's

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = leaf.value.get
        for batch in batches:
            length, sizes, found, often = [], [0], [], []
            for text in batch.column("text"):
                held = terms(text.as_py())
                tf = Counter(map(get, held))
                tf.pop(None, None)
                length.append(len(held))
                found.extend(tf.keys())
                often.extend(tf.values())
                sizes.append(len(found))
            offsets = pa.array(sizes, pa.int32())
            out = pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(length, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(often, pa.int32()))], ["doc_id", "n", "ids", "tf"])
            yield out.filter(pa.compute.greater(out.column("n"), 0))

    held = scratch.write(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                         .mapInArrow(count, "doc_id long, n long, ids array<int>, tf array<int>"))
    total = held.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"]
    weight = np.zeros(len(plan.terms), np.int64)
    for row in held.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        weight[row["id"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["count"] + 1)))
    sent = spark.sparkContext.broadcast((plan, weight))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = sent.value
        best, step = Best(len(ids), k), max(1, CELLS // max(len(plan.depth), 1))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found, often = part.column("ids"), part.column("tf").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(found.offsets.to_numpy()))
                term = found.flatten().to_numpy()
                length = part.column("n").to_numpy()
                # 10 for the constant part, 90 for the share of the mean length; 128 bits are not needed below 10 ** 16 terms
                m = 10 + np.array([90 * int(x) * n_docs // n_terms for x in length], np.int64)
                parts = weight[term] * ((1_000_000_000 * often) // (1000 * often + 8 * m[doc]))
                name = part.column("doc_id")
                best.add(plan.scores(term, doc, parts, part.num_rows), pa.compute.fill_null(name, 0).to_numpy(),
                         name.is_null().to_numpy(zero_copy_only=False))
        item, place = np.nonzero(best.score > 0)
        none = best.none[item, place]
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in item], pa.int64()), pa.array(best.doc[item, place], mask=none),
            pa.array(best.score[item, place])], ["item_id", "doc_id", "score"])

    return held.mapInArrow(score, "item_id long, doc_id long, score long")


def lexical_search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of `docs` (doc_id, text) for each of `items` (item_id, text)."""
    scratch = Scratch(spark, "lexical")
    wanted = scratch.write(items_of(items))
    groups = -(-(wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) // GROUP_TERMS)
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for g in range(groups):
        group = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()
        if group:
            plan = Plan([[bytes(t) for t in row["terms"]] for row in group])
            out = out.unionByName(scratch.write(search_group(scratch, docs, [row["item_id"] for row in group], plan, k)))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op12_shared_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return lexical_search(spark, spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


OP12_SQL = """
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS row FROM documents)),
tf AS MATERIALIZED (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS MATERIALIZED (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
parts AS MATERIALIZED (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS part
  FROM tf JOIN lengths USING (row) JOIN weights USING (term), total),
scored AS (SELECT item_id, row, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, row, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
