"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of byte n-grams.

The model is trained on trusted text, the documents labelled good and not toxic. Documents are cut into blocks (a bucketed
table), and each block lists its distinct n-grams with their counts in trusted text: one row for each shard, with sorted numbers packed
as bytes, so that a listed n-gram takes two or three bytes and not a row. An n-gram's shard goes by the two bytes before its last, so counts, continuation counts
and context totals of three bytes or more are found within a shard; the shorter n-grams, 65,536 at most, are summed over all shards and known to each.
Discounts come from counts of counts. The log probabilities of a block's n-grams come
back to the block, in the order of its list, where each document's perplexity is summed. A document is rejected when its perplexity exceeds its language's threshold:
a high quantile of the language's trusted documents, times a margin. The perplexity of n bytes is uncertain by a factor of about exp(noise / sqrt(n)), the
noise being measured on the trusted documents; quantiles are taken of lower bounds and thresholds are raised by the same factor, `DEVIATIONS`
times, so that a few very short texts do not set the level for all, and are not rejected for their length either. For the quantiles each trusted document is scored by a model without its fold
(texts are dealt into `FOLDS` by their hash, so copies share one), as documents without a label are scored by a model that has not seen them.

Every document is scored in full, and counts, quantiles and thresholds cover all rows.

Defined cases: a null or empty text has no perplexity and is rejected; a document counts as trusted if all its labels say so; a language
without trusted documents, null included, takes the threshold of all; without any trusted document nothing with text is
rejected and every byte has probability 1/256; rows with one id are scored each by its own text and trusted together; rows without an id are scored and never trusted;
further columns are kept by the filter; empty input gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Blocks, Scratch, partitions
from .shingles import buffers

ORDER = 5
QUANTILE = 0.98
MARGIN = 1.1
DEVIATIONS = 2
FOLDS = 8
WHOLE = -1  # stands in `fold` for the model of all trusted text
PIECE = 1 << 20
SCORED = 1 << 18  # bytes of text scored at once
SHORT = 2  # n-grams of so many bytes or fewer are known to every shard
FOLD_AT = 8 * ORDER  # a fold's n-gram is one number, with the fold above the n-gram's bytes
GRAM = (1 << FOLD_AT) - 1
MERGE = 4 << 20  # numbers that wait before they are merged
LISTED = "block long, shard long, n long, m long, grams binary, held binary, lost binary"
TALLIES = "k long, fold long, gram long, n1 long, n2 long, n3 long, n4 long"
LOGS = "block long, shard long, n long, m long, held binary, logp binary, unseen binary"


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, packed into one number, and bounds by text; zero bytes stand before a text."""
    lead = "\0" * (ORDER - 1)
    padded = pc.binary_join_element_wise(pa.scalar(lead), pc.fill_null(texts.cast(pa.string()), ""), "")
    data, at = buffers(padded)
    if not len(data):
        return np.zeros(0, np.int64), at
    packed = data.astype(np.int64)
    for back in range(1, ORDER):
        packed[back:] |= data[:-back].astype(np.int64) << (8 * back)
    own = np.ones(len(data), bool)
    for i in range(ORDER - 1):
        own[at[:-1] + i] = False
    bounds = at - (ORDER - 1) * np.arange(len(at))
    return packed[own], bounds


def pieces_of(table: pa.Table, limit: int = PIECE):
    """Slices of a block of at most `limit` bytes of text, unless one text is longer."""
    size = np.cumsum(pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy())
    start = 0
    while start < table.num_rows:
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + limit, "right")))
        part = table.slice(start, stop - start)
        yield part, part.column("text").combine_chunks()
        start = stop


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed bytes: first all lowest bytes, then all second ones and so on, most of which are alike."""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, n: int, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def summed(keys: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def by_shard(grams: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts sorted n-grams by shard, and the bounds of the shards in it."""
    pair = grams >> 8 & 0xFFFF
    shard = (pair * 40503 & 0xFFFF) % shards
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def list_grams(docs: pa.Table, trusted: pa.Table, shards: int) -> pa.Table:
    """Distinct n-grams of a block, a row for each shard, and how often each stands in the trusted text of each fold that holds it.

    `held` numbers an n-gram of a fold by its place among the row's n-grams, plus the fold times their number.
    """
    good = set(trusted.column("doc_id").to_pylist())
    none = np.zeros(0, np.int64)
    need, held, lost = none, [none], [none]
    for part, texts in pieces_of(docs):
        packed, bounds = grams(texts)
        need = np.union1d(need, pd.unique(packed))
        own = np.array([d in good for d in part.column("doc_id").to_pylist()], bool)
        sizes = np.diff(bounds)
        packed = packed[np.repeat(own, sizes)] | np.repeat(part.column("fold").to_numpy()[own], sizes[own]) << FOLD_AT
        codes, values = pd.factorize(packed)
        held.append(values)
        lost.append(np.bincount(codes, minlength=len(values)))
    held, lost = summed(held, lost)
    order, bounds = by_shard(need, shards)
    rank = np.empty(len(need), np.int64)
    rank[order] = np.arange(len(need))
    rank = rank[np.searchsorted(need, held & GRAM)]
    shard = np.searchsorted(bounds, rank, "right") - 1
    turn = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[turn], np.arange(shards + 1))
    block = docs.column("block")[0].as_py() if docs.num_rows else 0
    out = []
    for s in np.flatnonzero(np.diff(bounds)):
        own, mine = order[bounds[s]:bounds[s + 1]], turn[ends[s]:ends[s + 1]]
        at = rank[mine] - bounds[s] + (held[mine] >> FOLD_AT) * len(own)
        out.append((block, s, len(own), len(at), pack(np.diff(need[own], prepend=0)), pack(np.diff(at, prepend=0)), pack(lost[mine])))
    names = [x.split()[0] for x in LISTED.split(", ")]
    return pa.table({c: pa.array([r[i] for r in out], pa.binary() if i > 3 else pa.int64()) for i, c in enumerate(names)})


def score(docs: pa.Table, logs: pa.Table, shards: int) -> pa.Table:
    """Sum of log probabilities of each document of a block, and of each trusted one under the model without its fold."""
    need, waiting = [np.zeros(0, np.int64)], 0
    for _, texts in pieces_of(docs, SCORED):
        need.append(pd.unique(grams(texts)[0]))
        waiting += len(need[-1])
        if waiting > MERGE >> 2:
            need, waiting = [np.unique(np.concatenate(need))], 0
    need = np.unique(np.concatenate(need))
    order, starts = by_shard(need, shards)
    # the fold's values in a row, found by place: few n-grams stand in the trusted text of a fold
    whole, place, values, known = np.full(len(need), np.nan), np.zeros((FOLDS, len(need)), np.int32), [np.full(1, np.nan)], 1
    for row in logs.select(["shard", "n", "m", "held", "logp", "unseen"]).to_pylist():
        own = order[starts[row["shard"]]:starts[row["shard"] + 1]]
        whole[own] = unpack(row["logp"], row["n"], np.float64)
        fold, at = np.divmod(np.cumsum(unpack(row["held"], row["m"])), row["n"])
        place[fold, own[at]] = np.arange(known, known + row["m"])
        values.append(unpack(row["unseen"], row["m"], np.float64))
        known += row["m"]
    without, out = np.concatenate(values), []
    # a piece's n-grams are found again, as those of all pieces take several times the text
    for part, texts in pieces_of(docs, SCORED):
        packed, bounds = grams(texts)
        codes, distinct = pd.factorize(packed)
        at = np.searchsorted(need, distinct)[codes]
        sums = []
        full = np.diff(bounds) > 0
        for each in (whole[at], without[place[np.repeat(part.column("fold").to_numpy(), np.diff(bounds)), at]]):
            # each document's own sum; differences of running sums would carry what is not finite into the next documents
            total = np.zeros(len(full))
            total[full] = np.add.reduceat(each, bounds[:-1][full]) if full.any() else []
            sums.append(pa.array(total, mask=np.isnan(total)))
        out.append(pa.table({
            "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"), "lang": part.column("lang"),
            "n_bytes": pa.array(np.diff(bounds)), "logp": sums[0], "unseen": sums[1]}))
    return pa.concat_tables(out) if out else pa.table({
        "doc_id": pa.array([], pa.int64()), "text_hash": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "n_bytes": pa.array([], pa.int64()),
        "logp": pa.array([], pa.float64()), "unseen": pa.array([], pa.float64())})


def discounts(n: list[int]) -> list[float]:
    """What is taken off counts of one, two, and three or more, from how many n-grams have counts of one to four."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(i, max(0.0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 for i in (1, 2, 3)]


def shared(kept: np.ndarray, left: np.ndarray, q: np.ndarray | float, total: np.ndarray, one: np.ndarray | float) -> np.ndarray:
    """Probability from the count kept and a shorter n-gram's share of what its context's discounts left over.

    The discount of counts of two or more may be zero. Where so nothing is left over, an unseen byte gets what one discount of counts of one, which
    is above zero, would have left it: no byte may be impossible.
    """
    p = kept + left * q
    return np.where(p > 0, p, one * q) / total


class Order(NamedTuple):
    """Sorted n-grams of one length: all that are scored, those of trusted text with their counts, and those of each fold's
    trusted text with their counts with the fold (hc) and without it (hr)."""
    need: np.ndarray
    gram: np.ndarray
    c: np.ndarray
    held: np.ndarray
    hc: np.ndarray
    hr: np.ndarray


def ordered(need: np.ndarray, gram: np.ndarray, c: np.ndarray, held: np.ndarray, lost: np.ndarray) -> Order:
    whole = c[np.searchsorted(gram, held & GRAM)]
    return Order(need, gram, c, held, whole, whole - lost)


def suffixes(keys: np.ndarray, k: int) -> np.ndarray:
    """The last k bytes of n-grams, with their folds."""
    return keys & ~(GRAM ^ ((1 << 8 * k) - 1))


def shorter(o: Order, k: int) -> Order:
    """The n-grams of k bytes from those of k + 1, counted by how many different bytes stand before them."""
    gram, c = np.unique(suffixes(o.gram, k), return_counts=True)
    return ordered(np.unique(suffixes(o.need, k)), gram, c, *summed([suffixes(o.held, k)], [o.hr == 0]))


def gather(rows: list[dict]) -> Order:
    """The longest n-grams of a shard over all blocks."""
    none = np.zeros(0, np.int64)
    need, held, lost, waiting = [none], [none], [none], 0
    for r in rows:
        listed = np.cumsum(unpack(r["grams"], r["n"]))
        fold, at = np.divmod(np.cumsum(unpack(r["held"], r["m"])), r["n"])
        need.append(listed)
        held.append(listed[at] | fold << FOLD_AT)
        lost.append(unpack(r["lost"], r["m"]))
        waiting += r["n"] + r["m"]
        if waiting > MERGE:
            need, (x, y), waiting = [np.unique(np.concatenate(need))], summed(held, lost), 0
            held, lost = [x], [y]
    held, lost = summed(held, lost)
    return ordered(np.unique(np.concatenate(need)), *summed([held & GRAM], [lost]), held, lost)


def sizes(c: np.ndarray) -> list[np.ndarray]:
    return [c == 1, c == 2, c >= 3]


def tally(o: Order) -> dict[int, list[int]]:
    """How many n-grams have counts of one to four, and by how much that changes without each fold."""
    fold = o.held >> FOLD_AT
    many = lambda c: np.array([np.count_nonzero(c == i) for i in range(1, 5)])
    return {WHOLE: many(o.c).tolist()} | {f: (many(o.hr[fold == f]) - many(o.hc[fold == f])).tolist() for f in range(FOLDS)}


def cuts_of(tallies: dict[int, list[int]]) -> np.ndarray:
    """Discounts of all trusted text, then of that without each fold."""
    whole = tallies[WHOLE]
    return np.array([discounts(whole)] + [discounts([a + b for a, b in zip(whole, tallies[f])]) for f in range(FOLDS)])


def tally_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tallies of a shard's n-grams, and what it adds to the counts of the n-grams of `SHORT` bytes."""
    o, out = gather([r for b in batches for r in b.to_pylist()]), []
    for k in range(ORDER, SHORT, -1):
        out += [(k, fold, 0, *n) for fold, n in tally(o).items()]
        o = shorter(o, k - 1)
    n = np.zeros(len(o.need), np.int64)
    n[np.searchsorted(o.need, o.gram)] = o.c
    out += [(SHORT, WHOLE, g, x, 0, 0, 0) for g, x in zip(o.need.tolist(), n.tolist())]
    out += [(SHORT, h >> FOLD_AT, h & GRAM, x, 0, 0, 0) for h, x in zip(o.held.tolist(), (o.hc - o.hr).tolist())]
    names = [x.split()[0] for x in TALLIES.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names)


def read_tallies(stats: DataFrame) -> tuple[dict[int, np.ndarray], Order]:
    """Discounts by length, and the n-grams of `SHORT` bytes of all shards: 65,536 at most, and as many for each fold."""
    n = [f"n{i}" for i in range(1, 5)]
    rows = stats.groupBy("k", "fold", "gram").agg(*[F.sum(x).alias(x) for x in n]).toPandas().sort_values(["k", "fold", "gram"])
    tallies: dict[int, dict[int, list[int]]] = {k: dict.fromkeys([WHOLE, *range(FOLDS)], [0] * 4) for k in range(SHORT + 1, ORDER + 1)}
    for r in rows[rows.k > SHORT].itertuples():
        tallies[r.k][r.fold] = [getattr(r, x) for x in n]
    short = rows[rows.k == SHORT]
    need, seen = short[short.fold == WHOLE], short[(short.fold == WHOLE) & (short.n1 > 0)]
    held = short[short.fold != WHOLE]
    column = lambda x: x.to_numpy(np.int64)
    base = o = ordered(column(need.gram), column(seen.gram), column(seen.n1), column(held.fold) << FOLD_AT | column(held.gram), column(held.n1))
    cuts = {k: cuts_of(x) for k, x in tallies.items()}
    for k in range(SHORT, 0, -1):
        o = o if k == SHORT else shorter(o, k)
        cuts[k] = cuts_of(tally(o))
    return cuts, base


def probabilities(k: int, o: Order, cuts: np.ndarray, below: Order | None, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every n-gram of k bytes in `o.need` under all trusted text, and in `o.held` without its fold; p and u are those of `below`, one byte less.

    Rows of a fold hold every n-gram of the fold's text, so they are all n-grams whose counts change when the fold is left out.
    """
    context, at = np.unique(o.gram >> 8, return_inverse=True)
    total, parts = np.bincount(at, o.c, len(context)), [np.bincount(at, x, len(context)) for x in sizes(o.c)]
    left = sum(x * cut for x, cut in zip(parts, cuts[0]))
    taken = lambda c, cut: np.where(c == 0, 0.0, cut[..., 0] * (c == 1) + cut[..., 1] * (c == 2) + cut[..., 2] * (c >= 3))
    kept = np.zeros(len(o.need))
    kept[np.searchsorted(o.need, o.gram)] = o.c - taken(o.c, cuts[0])
    q = 1 / 256 if below is None else p[np.searchsorted(below.need, suffixes(o.need, k - 1))]
    if len(context):
        place = np.minimum(np.searchsorted(context, o.need >> 8), len(context) - 1)
        p = np.where(context[place] == o.need >> 8, shared(kept, left[place], q, total[place], cuts[0, 0]), q)
    else:
        p = np.full(len(o.need), q)
    # the same without a fold
    fold = o.held >> FOLD_AT
    changed, at = np.unique(fold << FOLD_AT | (o.held & GRAM) >> 8, return_inverse=True)
    place, own = np.searchsorted(context, changed & GRAM), cuts[(changed >> FOLD_AT) + 1]
    rest = total[place] - np.bincount(at, o.hc - o.hr, len(changed))
    left = sum((x[place] - np.bincount(at, a, len(changed)) + np.bincount(at, b, len(changed))) * own[:, i]
               for i, (x, a, b) in enumerate(zip(parts, sizes(o.hc), sizes(o.hr))))
    q = np.full(len(o.held), 1 / 256) if below is None else u[np.searchsorted(below.held, suffixes(o.held, k - 1))]
    kept = o.hr - taken(o.hr, cuts[fold + 1])
    with np.errstate(divide="ignore", invalid="ignore"):
        return p, np.where(rest[at] == 0, q, shared(kept, left[at], q, rest[at], own[at, 0])) if len(o.held) else q


def shard_logs(batches: Iterator[pa.RecordBatch], cuts: dict[int, np.ndarray], base: Order) -> Iterator[pa.RecordBatch]:
    """Log probabilities of a shard's n-grams for each block, in the order in which the block lists them."""
    rows = [r for b in batches for r in b.to_pylist()]
    orders = {ORDER: gather(rows), SHORT: base}
    for k in range(ORDER - 1, SHORT, -1):
        orders[k] = shorter(orders[k + 1], k)
    for k in range(SHORT - 1, 0, -1):
        orders[k] = shorter(orders[k + 1], k)
    p = u = np.zeros(0)
    for k in range(1, ORDER + 1):
        p, u = probabilities(k, orders[k], cuts[k], orders.get(k - 1), p, u)
    p, u = np.log(p), np.log(u)
    longest, kinds = orders[ORDER], [x.split() for x in LOGS.split(", ")]
    out, waiting = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.binary() if kind == "binary" else pa.int64())
                                           for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])

    for r in rows:
        listed = np.cumsum(unpack(r["grams"], r["n"]))
        fold, at = np.divmod(np.cumsum(unpack(r["held"], r["m"])), r["n"])
        logp = pack(p[np.searchsorted(longest.need, listed)])
        unseen = pack(u[np.searchsorted(longest.held, listed[at] | fold << FOLD_AT)])
        out.append((r["block"], r["shard"], r["n"], r["m"], r["held"], logp, unseen))
        waiting += len(r["held"]) + len(logp) + len(unseen)
        if waiting > MERGE:
            yield batch()
            out, waiting = [], 0
    yield batch()


def perplexities(spark: SparkSession, docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lang, n_bytes, perplexity, unseen) of every row of `docs`, the model being trained on the ids in `trusted`.

    `unseen` is the perplexity of a trusted row under the model without the row's fold.
    """
    scratch = Scratch(spark, "perplexity")
    hashed = F.xxhash64(F.col("text").cast("string"))
    fold = F.pmod(hashed, F.lit(FOLDS)).cast("long").alias("fold")
    blocks = Blocks(spark, docs, F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), fold,
                    hashed.alias("text_hash"))
    parts = blocks.read().groupBy("block")
    mine = trusted.select(blocks.of("doc_id"), "doc_id").groupBy("block")
    shards, name = partitions(spark), f"grams_{uuid.uuid4().hex}"

    def listing(docs: pa.Table, trusted: pa.Table) -> pa.Table:
        return list_grams(docs, trusted, shards)

    (parts.cogroup(mine).applyInArrow(listing, LISTED).repartition(shards, "shard")
     .write.option("compression", "none").bucketBy(shards, "shard").saveAsTable(name))
    listed = spark.table(name).groupBy("shard")
    cuts, base = read_tallies(scratch.write(listed.applyInArrow(tally_shard, TALLIES)))

    def logs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from shard_logs(batches, cuts, base)

    def scoring(docs: pa.Table, logs: pa.Table) -> pa.Table:
        return score(docs, logs, shards)

    scores = scratch.write(parts.cogroup(listed.applyInArrow(logs_of, LOGS).groupBy("block")).applyInArrow(
        scoring, "doc_id long, text_hash long, lang string, n_bytes long, logp double, unseen double"))
    spark.sql(f"DROP TABLE {name}")
    blocks.close()
    perplexity = lambda c: F.when(F.col("n_bytes") > 0, F.exp(-F.col(c) / F.col("n_bytes")))
    return (scores.join(trusted.select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
            .select("doc_id", "text_hash", "lang", "n_bytes", perplexity("logp").alias("perplexity"),
                    F.when(F.col("known"), perplexity("unseen")).alias("unseen")))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
            .where("quality = 1 AND toxic = 0").select("doc_id"))


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE,
          margin: float = MARGIN) -> DataFrame:
    """(doc_id, text_hash, lang, n_bytes, perplexity, threshold, keep) for every row of `docs`."""
    scratch = Scratch(spark, "trusted")
    scores = scratch.write(perplexities(spark, docs, scratch.write(trusted_ids(labels))))
    good = scores.where("unseen IS NOT NULL").withColumn("log", F.log("unseen"))
    middle = good.groupBy("lang").agg(F.percentile_approx("log", 0.5, 10000).alias("middle"))
    away = F.abs(F.col("log") - F.col("middle")) * F.sqrt("n_bytes")
    typical = good.join(middle, good["lang"].eqNullSafe(middle["lang"])).agg(F.percentile_approx(away, 0.5, 10000).alias("d")).first()["d"]
    # the median distance from the middle is 0.6745 standard deviations
    noise = F.exp(F.lit(DEVIATIONS * (typical or 0.0) / 0.6745) / F.sqrt("n_bytes"))
    level = F.percentile_approx(F.col("unseen") / noise, quantile, 10000)
    by_lang = good.where("lang IS NOT NULL").groupBy("lang").agg((level * margin).alias("own"))
    overall = (good.agg(level.alias("q")).first()["q"] or math.inf) * margin
    return (scores.join(by_lang, "lang", "left")
            .withColumn("threshold", F.coalesce("own", F.lit(overall)) * F.when(F.col("n_bytes") > 0, noise).otherwise(1.0))
            .select("doc_id", "text_hash", "lang", "n_bytes", "perplexity", "threshold",
                    F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("keep")))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, that are not rejected; each row goes by its own text, also without an id or with a shared one."""
    bad = Scratch(spark, "rejected").write(judge(spark, docs, labels).where("NOT keep").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    row = docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["_hash"])
    return docs.join(bad, row, "left_anti").select(docs.columns)


def op1_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity, threshold and decision for every document."""
    return judge(spark, spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).drop("text_hash")
