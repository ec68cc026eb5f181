"""Vector codes: product quantisation by exact Lloyd rounds over metric trees.

Vectors are cut into parts of equal length, and every part position has a codebook of its own. Rows stay where they
are read: a task packs them into blocks of bounded size and builds one metric tree for each block and part by the anchors
hierarchy. Some sqrt(n) anchors are placed farthest first, and each new one takes the points nearer to it, looking
only at those that the triangle inequality leaves open. Anchors are merged from the middle upwards, the pair with the
smallest joint ball first, and each anchor's points get a hierarchy of their own downwards. Every ball caches count, sum and radius.

In a round each ball gets its parent's list of entries and drops those farther than the best entry for all
points of the ball. When one entry is left the ball is wholly owned: its cached count and sum go to that entry and nothing below
is visited. Distances are whole numbers; the radius and the products with it are rounded upwards, so only a strictly
farther entry is dropped and ties stay for the points, where the lower index wins. The rounds send one codebook out and
bring back one sum for each entry; the trees are built once, in the shared folder.

Defined cases: rows whose vector is null or empty or holds a null or non-finite component are dropped; shorter vectors count as
filled with zeros up to the longest length, rounded up to a multiple of the parts; rows may repeat, and each counts;
a null vec_id comes after all others; equal vec_ids are ordered by vector; fewer rows than entries give fewer entries;
an entry equal to an earlier one owns nothing; a whole number beyond 2 ** 27 is refused, as its squares would
leave 64 bits; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
BLOCK_ROWS = 4096
LEAF = 32
LARGEST = 1 << 27


def whole_numbers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Vectors as rows of floor(scale * x), filled with zeros to `width`."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ArithmeticError(f"a component is beyond {LARGEST} after scaling")
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None] < lengths[:, None]] = flat
    return out


def apart(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all others, exact."""
    return ((points[:, None] - others[None]) ** 2).sum(2)


def anchors(points: np.ndarray, rows: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Up to `count` groups of `rows`: (rows, squared distances to the anchor), farthest first; the first row is the anchor."""
    away = apart(points[rows], points[rows[:1]])[:, 0]
    order = np.argsort(-away, kind="stable")
    groups, heads = [(rows[order], away[order])], [int(rows[0])]
    while len(groups) < count:
        widest = max(range(len(groups)), key=lambda g: groups[g][1][0])
        if groups[widest][1][0] == 0:
            break
        head = int(groups[widest][0][0])
        between = apart(points[[head]], points[heads])[0]
        won_rows, won_away = [], []
        for g, (own, far) in enumerate(groups):
            # a point nearer to its anchor than half the way to the new one cannot be nearer to the new one
            open_ = int(np.searchsorted(-far, -(between[g] / 4.0), "right"))
            if not open_:
                continue
            now = apart(points[own[:open_]], points[[head]])[:, 0]
            taken = now < far[:open_]
            if taken.any():
                won_rows.append(own[:open_][taken])
                won_away.append(now[taken])
                keep = np.ones(len(own), bool)
                keep[:open_][taken] = False
                groups[g] = own[keep], far[keep]
        own, far = np.concatenate(won_rows), np.concatenate(won_away)
        order = np.argsort(-far, kind="stable")
        groups.append((own[order], far[order]))
        heads.append(head)
    return groups


class BallTree:
    """Balls as arrays, parents before children; the points under a ball are a run of `order`."""

    FIELDS = ("order", "parent", "start", "stop", "leaf", "depth", "count", "sum", "center", "radius")

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.most = points, leaf
        parent, start, stop, ends, runs = [], [], [], [], []
        todo, at = [(("group", np.arange(len(points))), -1)] if len(points) else [], 0
        while todo:
            node, above = todo.pop()
            if node[0] == "group":
                node = self._middle_out(node[1])
            me = len(parent)
            parent.append(above)
            start.append(at)
            ends.append(node[0] == "leaf")
            if ends[me]:
                runs.append(node[1])
                at += len(node[1])
            else:
                todo += [(node[2], me), (node[1], me)]
            stop.append(at)
        for i in range(len(parent) - 1, 0, -1):
            stop[parent[i]] = max(stop[parent[i]], stop[i])
        self.parent, self.start, self.stop = (np.array(x, np.int64) for x in (parent, start, stop))
        self.leaf = np.array(ends, bool)
        self.order = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        self.depth = np.zeros(len(parent), np.int64)
        for i in range(1, len(parent)):
            self.depth[i] = self.depth[parent[i]] + 1
        placed = points[self.order]
        total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(placed, axis=0, out=total[1:])
        self.count = self.stop - self.start
        self.sum = total[self.stop] - total[self.start]
        self.center = self.sum // np.maximum(self.count, 1)[:, None]
        squares = [((placed[i:j] - c) ** 2).sum(1).max() for i, j, c in zip(self.start, self.stop, self.center, strict=True)]
        self.radius = np.sqrt(np.array(squares, np.float64)) * (1 + 1e-12)

    @classmethod
    def stored(cls, points: np.ndarray, fields: dict[str, np.ndarray]) -> BallTree:
        tree = cls.__new__(cls)
        tree.points = points
        tree.__dict__.update(fields)
        return tree

    def _middle_out(self, rows: np.ndarray):
        """("leaf", rows), or nested ("pair", left, right) over ("group", rows) still to be divided."""
        if len(rows) <= self.most:
            return "leaf", rows
        groups = [own for own, _ in anchors(self.points, rows, int(np.ceil(np.sqrt(len(rows)))))]
        if len(groups) == 1:
            return "leaf", rows
        nodes = [("group", own) for own in groups]
        size = np.array([len(own) for own in groups], np.float64)
        center = np.array([self.points[own].mean(0) for own in groups])
        radius = np.array([np.sqrt(((self.points[own] - c) ** 2).sum(1).max()) for own, c in zip(groups, center, strict=True)])
        gap = np.sqrt(((center[:, None] - center[None]) ** 2).sum(2))
        cost = np.maximum((gap + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(groups) - 1):
            a, b = divmod(int(cost.argmin()), len(cost))
            nodes[a] = ("pair", nodes[a], nodes[b])
            joint = (center[a] * size[a] + center[b] * size[b]) / (size[a] + size[b])
            radius[a] = max(np.linalg.norm(joint - center[a]) + radius[a], np.linalg.norm(joint - center[b]) + radius[b])
            center[a], size[a] = joint, size[a] + size[b]
            gap = np.sqrt(((center - joint) ** 2).sum(1))
            line = np.maximum((gap + radius + radius[a]) / 2, np.maximum(radius, radius[a]))
            line[np.isinf(cost[a]) & (np.arange(len(cost)) != a)] = np.inf
            line[[a, b]] = np.inf
            cost[a], cost[:, a], cost[b], cost[:, b] = line, line, np.inf, np.inf
            last = a
        return nodes[last]

    def owners(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, visited, open entries) of every ball; an owner of -1 is none, and what is under an owned ball is not visited."""
        balls, k = len(self.parent), len(entries)
        owner, visited, open_ = np.full(balls, -1), np.zeros(balls, bool), np.zeros((balls, k), bool)
        between = apart(entries, entries)
        reach = np.sqrt(between.astype(np.float64)) * (1 + 1e-12)
        first = ~(np.tril(between == 0, -1)).any(1)  # an entry equal to an earlier one never wins
        for depth in range(int(self.depth.max(initial=-1)) + 1):
            at = np.flatnonzero(self.depth == depth)
            at = at[visited[self.parent[at]] & (owner[self.parent[at]] < 0)] if depth else at
            visited[at] = True
            own = open_[self.parent[at]] if depth else np.broadcast_to(first, (len(at), k)).copy()
            away = apart(self.center[at], entries)
            best = np.where(own, away, np.iinfo(np.int64).max).argmin(1)
            lead = away - away[np.arange(len(at)), best][:, None]
            own &= lead <= 2 * self.radius[at][:, None] * reach[best] * (1 + 1e-12) + 1
            own[self.radius[at] == 0] = False
            own[np.arange(len(at)), best] = True
            open_[at] = own
            owner[at] = np.where(own.sum(1) == 1, best, -1)
        return owner, visited, open_

    def points_left(self, entries: np.ndarray, owner: np.ndarray, visited: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their entry) of the points in leaves that no entry owns whole."""
        leaves = np.flatnonzero(self.leaf & visited & (owner < 0))
        if not len(leaves):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = np.concatenate([self.order[self.start[i]:self.stop[i]] for i in leaves])
        allowed = np.repeat(open_[leaves], self.count[leaves], axis=0)
        return rows, np.where(allowed, apart(self.points[rows], entries), np.iinfo(np.int64).max).argmin(1)

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, sums) of the points of each entry."""
        owner, visited, open_ = self.owners(entries)
        counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        whole = np.flatnonzero(owner >= 0)
        np.add.at(counts, owner[whole], self.count[whole])
        np.add.at(sums, owner[whole], self.sum[whole])
        rows, mine = self.points_left(entries, owner, visited, open_)
        np.add.at(counts, mine, 1)
        np.add.at(sums, mine, self.points[rows])
        return counts, sums

    def codes(self, entries: np.ndarray) -> np.ndarray:
        """The entry of every point."""
        owner, visited, open_ = self.owners(entries)
        out = np.zeros(len(self.points), np.int64)
        for ball in np.flatnonzero(owner >= 0):
            out[self.order[self.start[ball]:self.stop[ball]]] = owner[ball]
        rows, mine = self.points_left(entries, owner, visited, open_)
        out[rows] = mine
        return out


def pack(points: np.ndarray, parts: int) -> bytes:
    """A block's points and the trees of its parts."""
    held, step = {"points": points}, points.shape[1] // parts
    for p in range(parts):
        tree = BallTree(np.ascontiguousarray(points[:, p * step:(p + 1) * step]))
        held |= {f"{name}{p}": getattr(tree, name) for name in BallTree.FIELDS}
    # a component fits in 32 bits, as do rows of a block; sums and radii stay wide
    held = {k: v.astype(np.int32) if v.dtype == np.int64 and not k.startswith("sum") else v for k, v in held.items()}
    out = BytesIO()
    np.savez(out, **held)
    return out.getvalue()


def unpack(cell: bytes, parts: int) -> list[BallTree]:
    with np.load(BytesIO(cell)) as held:
        wide = {k: v.astype(np.int64) if v.dtype == np.int32 else v for k, v in held.items()}
    step = wide["points"].shape[1] // parts
    return [BallTree.stored(wide["points"][:, p * step:(p + 1) * step], {name: wide[f"{name}{p}"] for name in BallTree.FIELDS})
            for p in range(parts)]


def finite(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


class VectorCodes:
    """Codebooks trained on all rows of `table` (vec_id, embedding, label), and the codes of the rows."""

    def __init__(self, spark: SparkSession, table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE):
        self.parts, self.scratch = parts, Scratch(spark, "codes")
        kept = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label").where(finite(F.col("embedding")))
        longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
        width = -(-longest // parts) * parts
        seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
        self.label_type = table.schema["label"].dataType.simpleString()
        books = whole_numbers(pa.array([r[0] for r in seeds], pa.list_(pa.float64())), width, scale)
        # one codebook a part: entries x places
        self.books = [np.ascontiguousarray(b) for b in np.split(books, parts, axis=1)] if len(books) else []
        if not self.books:
            return

        def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in cut(batches, BLOCK_ROWS):
                points = whole_numbers(block.column("embedding").combine_chunks(), width, scale)
                offsets = pa.array([0, block.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(offsets, block.column("vec_id").combine_chunks()),
                    pa.ListArray.from_arrays(offsets, block.column("label").combine_chunks()),
                    pa.array([pack(points, parts)], pa.binary())], ["ids", "labels", "trees"])

        self.blocks = self.scratch.write(kept.mapInArrow(plant, f"ids array<bigint>, labels array<{self.label_type}>, trees binary"))
        for _ in range(rounds):
            self.books = self._moved()

    def _moved(self) -> list[np.ndarray]:
        """The codebooks after one round: floor(sum / count) of what each entry owns; an entry that owns nothing stays."""
        books, parts = self.books, self.parts

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(len(b), np.int64) for b in books]
            sums = [np.zeros(b.shape, np.int64) for b in books]
            for batch in batches:
                for cell in batch.column("trees"):
                    for p, tree in enumerate(unpack(cell.as_py(), parts)):
                        n, total = tree.totals(books[p])
                        counts[p] += n
                        sums[p] += total
            part, entry, place = np.indices((parts, *books[0].shape)).reshape(3, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (part, entry, place, np.repeat(np.ravel(counts), books[0].shape[1]), np.ravel(sums))],
                ["part", "entry", "place", "n", "total"])

        wide = "decimal(38,0)"
        rows = (self.blocks.select("trees").mapInArrow(add, "part long, entry long, place long, n long, total long")
                .groupBy("part", "entry", "place").agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("total").cast(wide)).alias("total"))
                .where("n > 0").collect())
        moved = [b.copy() for b in books]
        for r in rows:
            moved[r["part"]][r["entry"], r["place"]] = int(r["total"]) // int(r["n"])
        return moved

    def digest(self) -> str:
        """sha256 of all entries' components by part, entry and place."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()

    def rows(self) -> DataFrame:
        """(vec_id, label, code, error) of every row that takes part."""
        books, parts = self.books, self.parts
        schema = f"vec_id bigint, label {self.label_type}, code string, error bigint"
        if not books:
            return self.scratch.spark.createDataFrame([], schema)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    text, error = None, 0
                    for p, tree in enumerate(unpack(batch.column("trees")[i].as_py(), parts)):
                        mine = tree.codes(books[p])
                        hexes = np.array([f"{e:02x}" for e in range(len(books[p]))])[mine]
                        text = hexes if text is None else np.char.add(text, hexes)
                        error = error + ((tree.points - books[p][mine]) ** 2).sum(1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(text.tolist(), pa.string()), pa.array(error)],
                        ["vec_id", "label", "code", "error"])

        return self.blocks.mapInArrow(assign, schema)


def cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The same rows in tables of `most` rows; only the last may be shorter."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            head = batch.slice(0, most - n)
            held.append(head)
            n, batch = n + head.num_rows, batch.slice(head.num_rows)
            if n == most:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def op13_anchors_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes and errors of all embeddings."""
    codes = VectorCodes(spark, spark.read.parquet(f"{folder}/embeddings.parquet"))
    rows = codes.scratch.write(codes.rows())
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256")))


def _op13_sql() -> str:
    """The rounds written out one after the other."""
    nearest = """
  SELECT vec_id, label, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT p.vec_id, p.label, p.part, e.entry, list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(p.v, e.v)])::BIGINT AS far
    FROM parts p JOIN book{0} e USING (part)) GROUP BY ALL"""
    steps = [f"""
fine AS MATERIALIZED (
  SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
parts AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS v FROM fine, range({PARTS}) AS r(part)),
book0 AS MATERIALIZED (
  SELECT part, entry, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM fine ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id))"""]
    for r in range(ROUNDS):
        steps.append(f"""
near{r} AS MATERIALIZED ({nearest.format(r)}),
sums{r} AS (
  SELECT part, entry, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM (
    SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{r} JOIN parts USING (vec_id, part)) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT part, entry, list(x ORDER BY place) AS v FROM sums{r} GROUP BY ALL) m USING (part, entry))""")
    return f"""WITH {','.join(steps)},
last AS MATERIALIZED ({nearest.format(ROUNDS)}),
coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM last GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS}) AS codebooks_sha256 FROM coded"""


OP13_SQL = _op13_sql()
