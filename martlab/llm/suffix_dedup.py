"""Exact removal of long byte strings that an earlier document holds, with a logarithmic family of suffix arrays.

Only some suffixes are indexed. Each window of `WINDOW` bytes has one anchor, the leftmost position with the least hash of
`GRAM` bytes in it, so equal windows have equal anchors at equal distances. The suffix array of a batch is the sorted list of
hashed prefixes at its anchors. A task holds one range of hashes of all batches as a family of such arrays: each new batch is a level, and levels of
like size are merged, so every entry is merged a logarithmic number of times. Then each batch is scanned against the levels.

Four scans narrow the work, none of which drops a match:

1. Anchors with a string of 33 bytes to the left or right that another document has too; a shared window implies one.
2. For those, the whole stretch that the anchor's windows cover: if an earlier document holds it, all of them repeat.
3. For the rest, the first question again: the first document that holds a window is among them, so both sides are.
4. For what is left, every window of 50 bytes by itself.

Documents are a bucketed table of blocks and never shuffled; a block sends each distinct hash once, with its least doc_id,
so a passage that many documents share weighs no more than the number of blocks. Hashes that decide a removal have 64 bits.

Defined cases: null and empty texts have no bytes; texts under 50 bytes lose nothing; rows with one id do not affect each other; rows
without an id lose nothing and take nothing from others; further columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Blocks, Scratch
from .shingles import buffers, mix, prefix_hash, span_hash

WINDOW, GRAM = 50, 16
REACH = WINDOW - GRAM  # a window's anchor lies at most so far behind its start
SIDE = REACH // 2
PIECE = 1 << 20
NO_ID = np.iinfo(np.int64).max
NEAR, STRETCH, REST, SINGLE, HELD = range(5)
SHORT = (NEAR, REST)  # scans that only ask whether another document has a string, with keys of 32 bits


class Level:
    """A sorted suffix array: distinct hashes, the least document, and in how many batches each stands (up to two)."""

    def __init__(self, keys: np.ndarray, docs: np.ndarray, batches: np.ndarray | None = None):
        order = np.argsort(keys)
        keys, docs = keys[order], docs[order]
        batches = np.ones(len(keys), np.int8) if batches is None else batches[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys = keys[at]
        self.docs = np.minimum.reduceat(docs, at) if len(at) else docs
        self.batches = np.minimum(np.add.reduceat(batches, at), 2).astype(np.int8) if len(at) else batches


class Family:
    """Levels of geometrically falling size."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, level: Level) -> None:
        while self.levels and len(self.levels[-1].keys) <= 2 * len(level.keys):
            last = self.levels.pop()
            level = Level(*(np.concatenate([getattr(last, x), getattr(level, x)]) for x in ("keys", "docs", "batches")))
        self.levels.append(level)

    def scan(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least document over all levels and number of batches (up to two) of each sorted key."""
        docs, batches = np.full(len(keys), NO_ID), np.zeros(len(keys), np.int64)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            same = level.keys[at] == keys
            docs[same] = np.minimum(docs[same], level.docs[at[same]])
            batches[same] += level.batches[at[same]]
        return docs, batches


def scan_batches(table: pa.Table) -> pa.Table:
    """One range of hashes: index all batches, then tell each which of its hashes others have, and the least document."""
    out = {"block": [], "kind": [], "shard": [], "at": [], "docs": []}
    shards, kinds = table.column("shard").to_numpy(), table.column("kind").to_numpy()
    for shard in np.unique(shards):
        mine = table.filter(pa.array(shards == shard))
        kind = int(kinds[shards == shard][0])
        wide = np.uint32 if kind in SHORT else np.uint64
        keys = [np.frombuffer(x, wide) for x in mine.column("keys").to_pylist()]
        docs = [np.zeros(len(k), np.int64) if kind in SHORT else np.frombuffer(d, np.int64)
                for k, d in zip(keys, mine.column("docs").to_pylist())]
        family = Family()
        for k, d in zip(keys, docs):
            family.add(Level(k, d))
        for block, k, d in zip(mine.column("block").to_pylist(), keys, docs):
            least, batches = family.scan(k)
            at = np.flatnonzero(batches > 1 if kind in SHORT else least < d)
            if len(at):
                out["block"].append(block)
                out["kind"].append(kind)
                out["shard"].append(int(shard))
                out["at"].append(at.astype(np.uint32).tobytes())
                out["docs"].append(b"" if kind in SHORT else least[at].tobytes())
    return pa.table(out, pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int64()),
                                    ("at", pa.binary()), ("docs", pa.binary())]))


class Piece:
    """Some whole documents and anchors in them: position, first and last window, and document of each."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, base: int):
        self.ids, self.base = ids, base
        self.data, self.bounds = buffers(texts)
        self.keep(*[np.zeros(0, np.int64)] * 3)

    def keep(self, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        self.at, self.first, self.last = at, first, last
        self.doc = np.searchsorted(self.bounds, first, "right") - 1

    def find_anchors(self) -> None:
        if len(self.data) < WINDOW:
            return
        prefix = prefix_hash(self.data)
        place = np.arange(len(self.data) - GRAM + 1)
        least = span_hash(prefix, place, place + GRAM) & np.uint64(0xFFFFFFFF00000000)
        least |= place.astype(np.uint64)
        # least of 35 neighbours, by doubling
        width = 1
        while width * 2 <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width <= REACH:
            rest = REACH + 1 - width
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.bounds))[:len(anchor)]
        inside = np.flatnonzero((np.arange(len(anchor)) + WINDOW <= self.bounds[1:][doc]) & (self.ids[doc] != NO_ID))
        if len(inside):
            of, doc = anchor[inside], doc[inside]
            new = np.ones(len(inside), bool)
            new[1:] = (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])
            start = np.flatnonzero(new)
            self.keep(of[start], inside[start], inside[np.append(start[1:], len(inside)) - 1])

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor numbers and hashes of the 33 bytes that end or begin with the anchor's gram."""
        prefix = prefix_hash(self.data)
        left = np.flatnonzero(self.at - SIDE >= self.bounds[:-1][self.doc])
        right = np.flatnonzero(self.at + GRAM + SIDE <= self.bounds[1:][self.doc])
        a = span_hash(prefix, self.at[left] - SIDE, self.at[left] + GRAM)
        b = span_hash(prefix, self.at[right], self.at[right] + GRAM + SIDE)
        return np.concatenate([left, right]), np.concatenate([a, mix(b + np.uint64(1))])

    def stretches(self) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(self.at)), span_hash(prefix_hash(self.data), self.first, self.last + WINDOW)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Start of every window of the anchors."""
        count = self.last - self.first + 1
        return np.repeat(self.first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)

    def singles(self) -> tuple[np.ndarray, np.ndarray]:
        start = self.windows()
        return np.repeat(np.arange(len(self.at)), self.last - self.first + 1), span_hash(prefix_hash(self.data), start, start + WINDOW)


class Block:
    """All documents of a block, ordered by id and text, and what the scans have told about them so far."""

    def __init__(self, docs: pa.Table, shards: int, told: pa.Table | None = None):
        self.shards = shards
        self.number = docs.column("block")[0].as_py() if docs.num_rows else 0
        docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        self.ids = docs.column("doc_id").to_pylist()
        texts = pc.fill_null(docs.column("text"), "").combine_chunks() if docs.num_rows else pa.array([], pa.string())
        known = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        size = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())]).astype(np.int64)
        self.pieces, start = [], 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(size, size[start] + PIECE, "right")) - 1)
            self.pieces.append(Piece(known[start:stop], texts.slice(start, stop - start), int(size[start])))
            start = stop
        self.told: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        if told is not None:
            for kind, shard, at, doc in zip(*(told.column(c).to_pylist() for c in ("kind", "shard", "at", "docs"))):
                self.told[kind, shard] = np.frombuffer(at, np.uint32), np.frombuffer(doc, np.int64)

    # Anchors that a later scan needs are held as a row of the block itself.

    def hold(self, kind: int) -> pa.Table:
        rows = [np.concatenate([np.zeros(0, np.int64), *(getattr(p, x) + p.base for p in self.pieces)]).astype(np.uint32)
                for x in ("at", "first", "last")]
        return self._rows([-1], kind, [np.concatenate(rows).tobytes()], [b""])

    def take(self, kind: int) -> None:
        at, first, last = np.split(self.told[HELD, -1 - kind][0].astype(np.int64), 3) if (HELD, -1 - kind) in self.told else [np.zeros(0, np.int64)] * 3
        bases = np.array([p.base for p in self.pieces] + [NO_ID])
        edges = np.searchsorted(first, bases)
        for p, i, j in zip(self.pieces, edges[:-1], edges[1:]):
            p.keep(at[i:j] - p.base, first[i:j] - p.base, last[i:j] - p.base)

    def gather(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and documents of (anchor numbers, hashes) by piece."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in parts)])
        return hashes, np.concatenate([np.zeros(0, np.int64), *(p.ids[p.doc[w]] for p, (w, _) in zip(self.pieces, parts))])

    def sorted_keys(self, kind: int, hashes: np.ndarray, docs: np.ndarray):
        """In order of the distinct hashes: shard, key, least and greatest document; and which of them each hash is.

        Shards are ranges of hashes, so one sort by hash gives the order of all shards.
        """
        order = np.argsort(hashes)
        sorted_, docs = hashes[order], docs[order]
        new = np.ones(len(sorted_), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        group = np.empty(len(sorted_), np.int64)
        group[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        least, most = (np.minimum.reduceat(docs, at), np.maximum.reduceat(docs, at)) if len(at) else (docs, docs)
        keys = sorted_[at]
        count = np.uint64(self.shards)
        shard = (((keys >> np.uint64(32)) * count) >> np.uint64(32)).astype(np.int64)
        if kind in SHORT:
            keys = (keys * count) >> np.uint64(32)
        return shard, keys, least, most, group

    def _rows(self, shards: list[int], kind: int, keys: list[bytes], docs: list[bytes]) -> pa.Table:
        n = len(shards)
        return pa.table({"shard": pa.array(shards, pa.int64()), "block": pa.array([self.number] * n, pa.int64()),
                         "kind": pa.array([kind] * n, pa.int32()), "keys": pa.array(keys, pa.binary()),
                         "docs": pa.array(docs, pa.binary())})

    def send(self, kind: int, hashes: np.ndarray, docs: np.ndarray) -> pa.Table:
        shard, keys, least, _, _ = self.sorted_keys(kind, hashes, docs)
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        rows = [s for s in range(self.shards) if edges[s] < edges[s + 1]]
        wide = np.uint32 if kind in SHORT else np.uint64
        return self._rows(rows, kind, [keys[edges[s]:edges[s + 1]].astype(wide).tobytes() for s in rows],
                          [b"" if kind in SHORT else least[edges[s]:edges[s + 1]].tobytes() for s in rows])

    def answers(self, kind: int, hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each hash: whether another document has it (short kinds), or an earlier one (the others)."""
        shard, keys, least, most, group = self.sorted_keys(kind, hashes, docs)
        found = least != most
        edges = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in range(self.shards):
            if (kind, s) in self.told:
                at, doc = self.told[kind, s]
                at = at.astype(np.int64) + edges[s]
                if kind in SHORT:
                    found[at] = True
                else:
                    least[at] = np.minimum(least[at], doc)
        return found[group] if kind in SHORT else least[group] < docs

    def narrow(self, kind: int, parts: list[tuple[np.ndarray, np.ndarray]], wanted: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Keep only the anchors for which some answer is `wanted`; returns first and last windows of the others, by piece."""
        yes = self.answers(kind, *self.gather(parts))
        others, start = [], 0
        for piece, (which, hashes) in zip(self.pieces, parts):
            stay = np.zeros(len(piece.at), bool)
            stay[which[yes[start:start + len(hashes)] == wanted]] = True
            start += len(hashes)
            others.append((piece.first[~stay], piece.last[~stay]))
            piece.keep(piece.at[stay], piece.first[stay], piece.last[stay])
        return others


def ask_near(block: Block) -> pa.Table:
    for piece in block.pieces:
        piece.find_anchors()
    return block.send(NEAR, *block.gather([p.near() for p in block.pieces]))


def ask_stretches(block: Block) -> pa.Table:
    for piece in block.pieces:
        piece.find_anchors()
    block.narrow(NEAR, [p.near() for p in block.pieces], True)
    return pa.concat_tables([block.hold(STRETCH), block.send(STRETCH, *block.gather([p.stretches() for p in block.pieces]))])


def ask_rest(block: Block) -> pa.Table:
    block.take(STRETCH)
    block.narrow(STRETCH, [p.stretches() for p in block.pieces], False)
    return pa.concat_tables([block.hold(REST), block.send(REST, *block.gather([p.near() for p in block.pieces]))])


def ask_singles(block: Block) -> pa.Table:
    block.take(REST)
    block.narrow(REST, [p.near() for p in block.pieces], True)
    return pa.concat_tables([block.hold(SINGLE), block.send(SINGLE, *block.gather([p.singles() for p in block.pieces]))])


def covered(block: Block) -> Iterator[tuple[Piece, np.ndarray]]:
    """For each piece, which bytes repeat."""
    block.take(STRETCH)
    whole = block.narrow(STRETCH, [p.stretches() for p in block.pieces], False)
    block.take(SINGLE)
    yes = block.answers(SINGLE, *block.gather([p.singles() for p in block.pieces]))
    used = 0
    for piece, (first, last) in zip(block.pieces, whole):
        start = piece.windows()
        start, used = start[yes[used:used + len(start)]], used + len(start)
        change = np.zeros(len(piece.data) + 1, np.int32)
        np.add.at(change, first, 1)
        np.add.at(change, last + WINDOW, -1)
        np.add.at(change, start, 1)
        np.add.at(change, start + WINDOW, -1)
        yield piece, np.cumsum(change[:-1]) > 0


SENT = "shard long, block long, kind int, keys binary, docs binary"
TOLD = "block long, kind int, shard long, at binary, docs binary"


def removed_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (start and end of each run of removed bytes), kept."""
    scratch = Scratch(spark, "suffixes")
    blocks = Blocks(spark, docs, F.col("doc_id").cast("long"), F.col("text").cast("string"))
    count = blocks.count
    parts = lambda: blocks.read().groupBy("block")
    def alone(ask):
        return lambda docs: ask(Block(docs, count))

    def informed(ask):
        return lambda docs, told: ask(Block(docs, count, told))

    def scan(kind, ask, *known):
        """Ask one question of all blocks; the answers, and the anchors that the blocks hold for later."""
        if known:
            sent = parts().cogroup(reduce(DataFrame.unionByName, known).groupBy("block")).applyInArrow(informed(ask), SENT)
        else:
            sent = parts().applyInArrow(alone(ask), SENT)
        sent = scratch.write(sent)
        found = scratch.write(sent.where("shard >= 0").groupBy("shard").applyInArrow(scan_batches, TOLD))
        held = scratch.write(sent.where("shard < 0").select(
            "block", F.lit(HELD).alias("kind"), F.lit(-1 - kind).cast("long").alias("shard"), F.col("keys").alias("at"), "docs"))
        scratch.drop(sent)
        return found, held

    near = scan(NEAR, ask_near)
    stretches = scan(STRETCH, ask_stretches, near[0])
    rest = scan(REST, ask_rest, *stretches)
    singles = scan(SINGLE, ask_singles, *rest)
    scratch.drop(*near, *rest)

    def last(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs, count, told)
        out = {"n_bytes": [], "starts": [], "ends": [], "kept": []}
        for piece, gone in covered(block):
            for i, j in zip(piece.bounds[:-1], piece.bounds[1:]):
                mine = gone[i:j]
                out["n_bytes"].append(j - i)
                turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                out["starts"].append(turns[::2])
                out["ends"].append(turns[1::2])
                out["kept"].append(piece.data[i:j][~mine].tobytes())
        return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                         "starts": pa.array(out["starts"], pa.list_(pa.int64())),
                         "ends": pa.array(out["ends"], pa.list_(pa.int64())), "kept": pa.array(out["kept"], pa.binary())})

    return parts().cogroup(reduce(DataFrame.unionByName, stretches + singles).groupBy("block")).applyInArrow(
        last, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses to documents of smaller id, and a digest of what it keeps."""
    out = removed_spans(spark, spark.read.parquet(f"{folder}/documents.parquet"))
    lost = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    return out.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
