"""Mixing, ranked search and vector codes against brute force, SQL and edge rows."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import oracle_connection, rows_of
from martlab.llm import codes, lexical, mixing
from martlab.llm.common import Scratch

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hash_threshold_mix", "op12_shared_lexical_search", "op13_anchors_vector_codes"])
def test_sql(spark, name):
    from martlab.llm.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, FOLDER)
    answer = oracle_connection(FOLDER).execute(ORACLES[name])
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1] and got == rows_of([d[0] for d in answer.description], answer.fetchall())


# mixing

DOCS = "doc_id long, text string, source string, size string, key int, target string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", None, "y") for i, t, s in rows], DOCS)


def shares(words, weights, repeats):
    """Targets by raising the level step by step."""
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    closed = set()
    while True:
        left = sum(words.values()) - sum(repeats * words[s] for s in closed)
        total = sum(weight[s] for s in names if s not in closed)
        target = {s: repeats * words[s] if s in closed else left * weight[s] / total for s in names}
        over = {s for s in names if target[s] > repeats * words[s]}
        if not over:
            return target
        closed |= over


def test_mix_targets_and_nearness(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 30))), s) for i, s in enumerate(
        ["hot"] * 400 + ["a"] * 40 + ["Z"] * 90 + ["é"] * 3 + [None] * 50 + ["tiny"] * 2)]
    got = [r.asDict() for r in mixing.mix(spark, docs_of(spark, rows), weights=(1, 4, 2), repeats=3).collect()]
    source = {i: s for i, _, s in rows}
    size = {i: len(t.split()) for i, t, _ in rows}
    words = collections.Counter()
    taken = collections.Counter()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["taken"] in [k * r["size"] for k in range(4)]
        words[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    want = shares(words, (1, 4, 2), 3)
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(sum(words.values()))
    assert max(want[s] / words[s] for s in words) == 3
    for r in got:
        assert r["source_size"] == words[source[r["doc_id"]]] and r["target"] == pytest.approx(want[source[r["doc_id"]]])
    for s in words:
        assert abs(taken[s] - want[s]) <= 15
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mixing.mix(spark, docs_of(spark, rows[::-1]).repartition(5), (1, 4, 2), 3).collect())


def test_mix_thresholds_are_nested_and_refined(spark):
    rows = [(i, 1 + i % 7) for i in range(3000)]
    sized = (spark.createDataFrame(rows, "doc_id long, size long")
             .select("doc_id", "size", F.lit("0a").alias("key"), F.expr("xxhash64(doc_id) & 1023").alias("h")))  # all in one first bucket, with ties
    budgets = [5.0, 100.0, 101.0, 4000.0, 11000.0]
    table = spark.createDataFrame([("0a", b) for b in budgets], "key string, budget double")
    upto = {r.budget: r.upto for r in mixing.thresholds(Scratch(spark, "t"), sized, table).collect()}
    by = collections.Counter()
    for r in sized.collect():
        by[r.h] += r["size"]
    at = np.cumsum([by[h] for h in range(1024)])
    assert [upto[b] for b in budgets] == sorted(upto.values())
    for b in budgets:
        mine = 0 if upto[b] < 0 else at[upto[b]]
        assert abs(mine - b) == min(abs(x - b) for x in [0, *at])


def test_mix_edges(spark):
    rows = [(1, None, None), (None, "", "a"), (None, "x y", "a"), (2, "x\ty z\nw\x0b\x1fv", "a"), (2, "x\ty z\nw\x0b\x1fv", "a"), (3, "q " * 50000, "")]
    got = mixing.mix(spark, docs_of(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 0), (0, 2), (1, 0), (2, 4), (2, 4), (3, 50000)]
    assert len({r["taken"] for r in got if r["doc_id"] == 2}) == 1
    none = mixing.mix(spark, docs_of(spark, []))
    assert none.collect() == [] and none.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert [r["taken"] for r in mixing.mix(spark, docs_of(spark, [(1, None, "a")])).collect()] == [0]


def test_mix_is_native(spark):
    plan = mixing.op11_hash_threshold_mix(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ranked search

SPLIT = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text):
    return SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    held = [(i, collections.Counter(words_of(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(words_of(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, n string").repartition(3)
    i = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, lexical.lexical_search(spark, d, i, k).collect()), key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vocabulary = ["".join(rng.choice(list("abÉß9"), rng.integers(1, 4))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary, n) if n else [])
    docs = [(int(i), text(rng.integers(0, 30))) for i in range(300)]
    docs += [(-1, None), (-2, ""), (None, text(20)), (5, "A-a_ß.É " * 9), (7, docs[6][1]), (6, docs[6][1]), (6, docs[6][1]), (8, text(4000))]
    items = [(int(i), text(rng.integers(1, 25))) for i in range(20)]
    items += [(20, items[3][1]), (21, None), (22, "unknown!"), (3, "aa bb"), (None, "a b"), (None, "9"), (23, docs[6][1])]
    assert search(spark, docs, items) == ranked(docs, items, 10)
    # many small groups and batches give the same
    monkeypatch.setattr(lexical, "GROUP_TERMS", 40)
    monkeypatch.setattr(lexical, "CELLS", 300)
    assert search(spark, docs, items, 4) == ranked(docs, items, 4)


def test_search_empty(spark):
    assert search(spark, [], [(1, "a")]) == [] and search(spark, [(1, "a")], []) == []
    assert search(spark, [(1, None)], [(1, "a")]) == [] and search(spark, [(1, "a")], [(1, None)]) == []


def test_plan_shares_sums():
    items = [list(t.encode() for t in line.split()) for line in ("a b c d e", "a b c d f", "c d a b", "x a b", "x a b", "q")]
    items = [[bytes([b]) for w in item for b in w] for item in items]
    plan = lexical.Plan(items)
    assert plan.additions < plan.plain
    values = np.array([[3 ** plan.leaf[t]] for t in plan.terms])
    got = plan.scores(np.arange(len(plan.terms)), np.zeros(len(plan.terms), int), values[:, 0], 1)
    assert got[:, 0].tolist() == [sum(3 ** plan.leaf[t] for t in set(item)) for item in items]


# vector codes

def lloyd(rows, parts, k, rounds, scale):
    """(codes, errors by row, codebooks) by full distances."""
    x = np.floor(np.array([v for _, v, _ in rows]) * scale).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:k]
    codes_, errors, books = [], 0, []
    for part in np.split(x, parts, axis=1):
        e = part[first]
        near = lambda: ((part[:, None] - e[None]) ** 2).sum(2)  # noqa: E731, B023
        for _ in range(rounds):
            m = near().argmin(1)
            e = np.array([[int(c) // int((m == j).sum()) for c in part[m == j].sum(0)] if (m == j).any() else e[j] for j in range(len(e))])
        d = near()
        codes_.append(d.argmin(1))
        errors = errors + d.min(1)
        books.append(e)
    return ["".join(f"{c:02x}" for c in line) for line in np.array(codes_).T], errors, books


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)


@pytest.mark.parametrize("kind", ["clusters", "copies", "noise"])
def test_codes_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(11)
    x = {"clusters": rng.integers(0, 5, (500, 1)) + rng.normal(0, 0.02, (500, 12)),
         "copies": np.where(rng.random((500, 1)) < 0.6, 0.25, rng.integers(-2, 3, (500, 12)) / 8),
         "noise": rng.normal(0, 1, (500, 12))}[kind]
    rows = [(int(i // 2) if i < 490 else None, [float(c) for c in v], None if i % 3 else int(i % 7)) for i, v in enumerate(x)]
    made = codes.VectorCodes(spark, vectors(spark, rows), parts=4, entries=9, rounds=4, scale=256)
    want, errors, books = lloyd(rows, 4, 9, 4, 256)
    assert all((a == b).all() for a, b in zip(made.books, books, strict=True))
    got = collections.Counter((r.vec_id, r.label, r.code, r.error) for r in made.rows().collect())
    assert got == collections.Counter((i, label, c, int(e)) for (i, _, label), c, e in zip(rows, want, errors, strict=True))


def test_balls_hold_their_points_and_prune():
    rng = np.random.default_rng(2)
    x = (rng.integers(0, 12, (3000, 1)) * 2000 + rng.normal(0, 40, (3000, 8))).astype(np.int64)
    tree = codes.BallTree(x)
    assert sorted(tree.order) == list(range(3000))
    for i in range(len(tree.parent)):
        under = x[tree.order[tree.start[i]:tree.stop[i]]]
        assert (tree.sum[i] == under.sum(0)).all() and tree.count[i] == len(under)
        assert np.sqrt(((under - tree.center[i]) ** 2).sum(1)).max() <= tree.radius[i]
        assert i == 0 or (tree.start[tree.parent[i]] <= tree.start[i] and tree.stop[i] <= tree.stop[tree.parent[i]])
    entries = x[rng.permutation(3000)[:16]]
    owner, visited, open_ = tree.owners(entries)
    asked = visited.sum() * 16 + sum(open_[i].sum() * tree.count[i] for i in np.flatnonzero(tree.leaf & visited & (owner < 0)))
    assert asked < 0.5 * 3000 * 16
    assert (tree.codes(entries) == codes.apart(x, entries).argmin(1)).all()


def test_codes_edges(spark):
    rows = [(4, [0.5, -1.0, 0.25], 1), (4, [0.5, -1.0, 0.25], 1), (2, [1.0], None), (9, None, 1), (8, [], 1), (7, [1.0, None, 2.0], 1),
            (6, [float("nan")] * 3, 2), (5, [float("inf"), 0.0, 0.0], 2), (None, [0.0, 0.0, 0.0], 3)]
    made = codes.VectorCodes(spark, vectors(spark, rows))
    assert made.books[0].shape == (4, 1) and made.books[0][:, 0].tolist() == [4096, 2048, 2048, 0]
    got = sorted(((r.vec_id, r.label, r.code, r.error) for r in made.rows().collect()), key=repr)
    # the third entry equals the second everywhere, so it owns nothing; equal components go to the lowest index
    assert [(g[0], g[3]) for g in got] == [(2, 0), (4, 0), (4, 0), (None, 0)] and got[1] == got[2]
    assert "02" not in [got[1][2][i:i + 2] for i in range(0, 16, 2)]
    empty = codes.VectorCodes(spark, vectors(spark, []))
    assert empty.rows().collect() == []
    with pytest.raises(Exception, match="beyond"):
        codes.VectorCodes(spark, vectors(spark, [(1, [1e6] * 8, 1)]))


# short benchmark items


def test_short_items_are_found(spark):
    from martlab.llm.decontaminate import contained_items

    texts = [(1, "One two three four"), (2, "say one  two three four and go"), (3, "one two"), (4, "two one three four one two five three four"),
             (5, "x " * 3000 + "one\ntwo three four"), (6, None), (7, "one")]
    items = [(1, "one two three four"), (2, "one two"), (3, "ONE"), (4, ""), (5, None), (6, "one two three four five")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contained_items(spark, docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    lists = [(d, (t or "").lower().split()) for d, t in texts]
    want = {(d, i) for d, w in lists for i, t in items if 0 < len(q := (t or "").lower().split()) < 5 and any(w[j:j + len(q)] == q for j in range(len(w)))}
    assert got == want and len(want) == 14


# exact top-k at large norms


@pytest.mark.parametrize("size", [1, 10 ** 3, 10 ** 6, 10 ** 8])
def test_top_k_is_exact_at_any_norm(spark, size):
    from martlab.llm.topk import exact_top_k

    rng = np.random.default_rng(size % 97)
    x = np.rint(size * (rng.integers(0, 4, (400, 1)) + rng.normal(0, 1e-4, (400, 8)))).astype(np.int64)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, v array<long>")
    got = [tuple(r) for r in exact_top_k(spark, vectors, vectors.where("vec_id % 20 = 0"), 5).collect()]
    want = []
    for q in range(0, 400, 20):
        scores = sorted((-sum(a * b for a, b in zip(x[q].tolist(), x[i].tolist())), i) for i in range(400) if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(got) == want


def test_top_k_refuses_what_64_bits_cannot_hold(spark):
    from martlab.llm.topk import exact_top_k

    vectors = spark.createDataFrame([(i, [4 * 10 ** 9] * 4) for i in range(3)], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="too long"):
        exact_top_k(spark, vectors, vectors, 2).collect()
