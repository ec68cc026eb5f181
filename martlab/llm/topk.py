"""Exact top-k inner-product search with cover trees over queries and data.

Pivots are spread by farthest-first over a bounded sample of vectors; every vector goes to its nearest pivot, and a pivot's vectors are cut into blocks of bounded
size. A query is searched in one block of its own pivot first; its kth score there bounds the rest: other pivots are visited only if centre and radius
allow a score that is not worse. In a block, queries and vectors are each put in a cover tree: a node's points go to the nearest of its heads, added farthest
first until all are within half its radius or an eighth of the points are heads, and each child keeps its own covering radius. Then
pairs of nodes are left out when their centres and radii cannot reach the worst kth score of the query node. Only what cannot hold an answer is pruned.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part; shorter vectors count as if filled with zeros; rows may
repeat and every row is a candidate; rows with the query's own vec_id are not its candidates;
queries with one vec_id are one query, with the least of their vectors; a null vec_id takes no part; equal scores are ordered by vec_id; with
fewer candidates than k all are returned; scores are whole numbers of 64 bits without rounding, and vectors so long that a score could leave them are
refused; further columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

PIVOTS = 64
SAMPLE = 2048  # the most vectors the driver sees
BLOCK_ROWS = 4096
LEAF = 64
SLACK = 1e-3
RELATIVE = 1e-12  # bounds the rounding of sums of products in doubles, as a share of the product of the norms


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, filled with zeros to `width`."""
    out = np.zeros((len(column), width), np.int64)
    for row, x in zip(out, column.to_pylist()):
        row[:len(x)] = x
    return out


class CoverTree:
    """Nodes as arrays: a centre point, a covering radius, children or points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.x = points.astype(np.float64)
        self.centers: list[int] = []
        self.radii: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        self._build(np.arange(len(points)), 0, leaf)
        self.c = self.x[self.centers]
        self.r = np.array(self.radii)
        self.norm = np.linalg.norm(self.c, axis=1)

    def _build(self, rows: np.ndarray, center: int, leaf: int) -> int:
        away = np.linalg.norm(self.x[rows] - self.x[rows[center]], axis=1)
        me = len(self.centers)
        self.centers.append(int(rows[center]))
        self.radii.append(float(away.max()))
        self.children.append([])
        self.points.append(rows)
        if len(rows) <= leaf or self.radii[me] == 0:
            return me
        nearest, heads, reach = np.zeros(len(rows), np.int64), [center], self.radii[me] / 2
        while away.max() > reach and len(heads) <= len(rows) // 8:
            far = int(away.argmax())
            other = np.linalg.norm(self.x[rows] - self.x[rows[far]], axis=1)
            closer = other < away
            nearest[closer], away[closer] = len(heads), other[closer]
            heads.append(far)
        for i, head in enumerate(heads):
            mine = np.flatnonzero(nearest == i)
            if len(mine) == len(rows):
                return me
            if len(mine):
                self.children[me].append(self._build(rows[mine], int(np.flatnonzero(mine == head)[0]), leaf))
        return me


def bound(q: CoverTree, node: int, x: CoverTree, nodes: np.ndarray) -> np.ndarray:
    """The most any query of a node can score with any point of each of some data nodes."""
    most = x.c[nodes] @ q.c[node] + q.r[node] * x.norm[nodes] + x.r[nodes] * q.norm[node] + q.r[node] * x.r[nodes]
    return most + SLACK + RELATIVE * (q.norm[node] + q.r[node]) * (x.norm[nodes] + x.r[nodes])


def dual_search(queries: np.ndarray, data: np.ndarray, worst: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query rows, data rows, scores) of all node pairs that may hold a score of at least each query's `worst`."""
    q, x = CoverTree(queries, 16), CoverTree(data)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * data.shape[1]
    if most >= 2.0 ** 62:
        raise ArithmeticError("vectors are too long for scores of 64 bits")
    # doubles are faster, and exact up to 2 ** 53
    exact = most < 2.0 ** 53
    left, right = (queries.astype(np.float64), data.astype(np.float64)) if exact else (queries, data)

    def visit(node: int, frontier: np.ndarray):
        least = worst[q.points[node]].min()
        open_, closed = frontier, []
        while len(open_):
            open_ = open_[bound(q, node, x, open_) >= least]
            closed += [n for n in open_ if not x.children[n]]
            inner = [n for n in open_ if x.children[n]]
            if q.children[node] and inner:
                for child in q.children[node]:
                    yield from visit(child, np.array(closed + inner, np.int64))
                return
            open_ = np.array([c for n in inner for c in x.children[n]], np.int64)
        if q.children[node] and closed:
            for child in q.children[node]:
                yield from visit(child, np.array(closed, np.int64))
        elif closed:
            rows = np.concatenate([x.points[n] for n in closed])
            mine = q.points[node]
            scores = left[mine] @ right[rows].T
            yield mine, rows, np.rint(scores).astype(np.int64) if exact else scores

    if len(queries) and len(data):
        yield from visit(0, np.zeros(1, np.int64))


def best_in_block(k: int, width: int, queries: pa.Table, data: pa.Table) -> pa.Table:
    """The k best of a block for each query, leaving out what is worse than the query's `worst`."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if queries.num_rows and data.num_rows:
        qid, vid = queries.column("query_id").to_numpy(), data.column("vec_id").to_numpy()
        # a score in doubles may be rounded upwards
        worst = np.nextafter(queries.column("worst").to_numpy().astype(np.float64), -np.inf)
        for mine, rows, scores in dual_search(matrix(queries.column("q"), width), matrix(data.column("v"), width), worst):
            order = np.argsort(vid[rows], kind="stable")
            rows, scores = rows[order], scores[:, order]
            for i, line in zip(mine, scores):
                ok = np.flatnonzero((line >= worst[i]) & (vid[rows] != qid[i]))
                if len(ok) > k:
                    # stable on rows ordered by id, so ties go to the smaller one
                    ok = ok[np.argsort(-line[ok], kind="stable")[:k]]
                out["query_id"].append(np.full(len(ok), qid[i]))
                out["vec_id"].append(vid[rows[ok]])
                out["score"].append(line[ok])
    return pa.table({c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in out.items()})


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """Pivots by farthest-first."""
    chosen, away = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def whole_numbers(table: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): components times `scale`, rounded down, of the vectors that take part."""
    fine = F.forall("embedding", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return (table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")))


def exact_top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best `vectors` (vec_id, v) of each of `queries` (vec_id, v)."""
    scratch = Scratch(spark, "topk")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    if not sample:
        return empty
    width = int(max(vectors.agg(F.max(F.size("v"))).first()[0], queries.agg(F.max(F.size("v"))).first()[0] or 0))
    pivots = spread(matrix(pa.array(sample, pa.list_(pa.int64())), width).astype(np.float64), PIVOTS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), width).astype(np.float64)
            apart = np.sqrt(np.maximum(
                (x ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(1)[None], 0))
            near = apart.argmin(1)
            yield pa.RecordBatch.from_arrays([
                # the squares above may cancel, so the distance itself is taken anew
                batch.column("vec_id"), batch.column("v"), pa.array(near), pa.array(np.linalg.norm(x - pivots[near], axis=1))],
                ["vec_id", "v", "pivot", "apart"])

    schema = "vec_id long, v array<long>, pivot long, apart double"
    placed = scratch.write(vectors.select("vec_id", "v").mapInArrow(place, schema))
    about = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()
    blocks = {r["pivot"]: -(-r["n"] // BLOCK_ROWS) for r in about}
    radius = np.full(len(pivots), -1.0)
    for r in about:
        radius[r["pivot"]] = r["radius"] * (1 + RELATIVE) + SLACK
    count = F.element_at(F.create_map(*[F.lit(int(x)) for pair in blocks.items() for x in pair]), F.col("pivot").cast("int"))
    data = scratch.write(placed.withColumn("part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), count))
                         .select("pivot", "part", "vec_id", "v"))

    once = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = scratch.write(once.select("vec_id", "v").mapInArrow(place, schema).select(
        "pivot", F.lit(0).cast("long").alias("part"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
        F.lit(float("-inf")).alias("worst")))
    # a hot pivot's queries are dealt out, each lot with its own copy of the block
    lots = asked.count() // (BLOCK_ROWS * 4) + 1

    def meet(asked: DataFrame, data: DataFrame) -> DataFrame:
        keys = ["pivot", "part", "lot"]
        copies = data.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)).cast("array<long>")))
        return (asked.withColumn("lot", F.pmod(F.xxhash64("query_id"), F.lit(lots))).groupBy(*keys).cogroup(copies.groupBy(*keys))
                .applyInArrow(lambda q, x: best_in_block(k, width, q, x), "query_id long, vec_id long, score long"))

    own = scratch.write(meet(asked, data.where("part = 0")))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    worst = (own.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k)
             .select("query_id", F.col("score").cast("double").alias("kth")))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("q"), width).astype(np.float64)
            long_ = np.linalg.norm(q, axis=1)[:, None]
            most = q @ pivots.T + long_ * radius[None] + SLACK + RELATIVE * long_ * np.linalg.norm(pivots, axis=1)[None]
            worst = np.nextafter(batch.column("worst").to_numpy(zero_copy_only=False), -np.inf)
            row, pivot = np.nonzero((most >= worst[:, None]) & (radius[None] >= 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(row)) for c in ("query_id", "q", "worst", "home")), pa.array(pivot)],
                ["query_id", "q", "worst", "home", "pivot"])

    wide = (asked.join(worst, "query_id", "left")
            .select("query_id", "q", F.coalesce("kth", "worst").alias("worst"), F.col("pivot").alias("home"))
            .mapInArrow(reach, "query_id long, q array<long>, worst double, home long, pivot long")
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
            .where("NOT (pivot = home AND part = 0)").select("pivot", "part", "query_id", "q", "worst"))
    found = own.unionByName(meet(wide, data))
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_cover_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best rows for every vector whose id is divisible by 20."""
    vectors = whole_numbers(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return exact_top_k(spark, vectors, vectors.where("vec_id % 20 = 0"))


OP10_SQL = """
WITH fine AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
"""
