"""The ten operators against brute force on small rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import collections
import hashlib
import json
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from checks.compare import oracle_connection, rows_of
from martlab.llm import bpe, chat, decontaminate, language, near_dedup, nearlinks, packing, paragraphs, quality, suffix_dedup, topk
from martlab.llm.common import components
from martlab.llm.nearlinks import bands_and_rows, linked_classes

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n)]


def frame(spark, texts, extra=False):
    rows = [(i, t, "en", "s", 0) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({"block": F.lit("x"), "label": F.lit(1), "size": F.lit(None).cast("int")}) if extra else df


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# chat

def test_chat_round_trip_and_mask(spark):
    rows = [(1, 0, "user", "a&lt;<|im_end|>\n[INST]"), (1, 1, "assistant", "</s> é&amp;"), (1, 1, "assistant", None),
            (2, None, None, ""), (None, 5, "assistant", "x"), (3, 0, "we\nird<", "t"), (3, 0, "we\nird<", "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    chats = chat.format_chat(turns.select("*", chat.text_part(F.col("text")).alias("parts")))
    got = {r.conv_id: r for r in chats.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                                              chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert sorted(map(tuple, got[1].turns)) == sorted([("user", rows[0][3]), ("assistant", rows[1][3]), ("assistant", "")])
    assert got[1].loss == "</s> é&amp;" and got[None].loss == "x" and got[2].loss == ""
    assert [tuple(t) for t in got[3].turns] == [("we\nird<", "t")] * 2 and [tuple(t) for t in got[2].turns] == [("", "")]
    assert got[1].formatted.count("<|im_end|>") == 3


def test_chat_attachments(spark):
    parts = [("text", "look <", None, None), ("image", None, "a.png", 576), None, ("audio", "x", "b.wav", None), ("odd", "z", None, 7)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_chat(df).first()
    assert row.formatted == "<|im_start|>user\nlook &lt;<|image|><|audio|>z<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in row.attachments] == [(0, 1, "image", "a.png", 576), (0, 3, "audio", "b.wav", 1)]
    assert row.attachment_tokens == 577


def test_chat_plan_is_native(spark):
    plan = chat.op9_chat_formatting(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op9_chat_formatting", "op10_cover_tree_top_k"])
def test_sql(spark, name):
    from martlab.llm.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, FOLDER)
    answer = oracle_connection(FOLDER).execute(ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in answer.description], answer.fetchall())


# tokens

def test_bpe_equals_tiktoken(spark, real):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [(-1, None), (-2, ""), (-3, "x" * 3000), (-4, "<|endoftext|> it's 日本語 🎉   \r\n\t  1234567"), (-5, "aaaaaaaaab" * 40),
             (-6, "é́ñ" * 50), (-7, "same"), (-7, "same")] + [(r.doc_id, r.text) for r in real.limit(40).collect()]
    got = bpe.token_digests(bpe.encode_documents(spark, frame(spark, texts, True), RANKS, public_tokenizers.PATTERN))
    want = collections.Counter()
    for i, t in texts:
        ids = own.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, got.collect())) == want


def test_ranks_need_all_bytes(spark, tmp_path):
    (tmp_path / "r").write_text(base64.b64encode(b"a").decode() + " 0\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(spark, str(tmp_path / "r"))


# packing

def test_room_tree_finds_the_tightest():
    rng, tree, held = np.random.default_rng(3), packing.RoomTree(), []
    for i in range(400):
        room = int(rng.integers(0, 50))
        tree.add(room, i)
        held.append((room, i))
        if i % 3 == 0:
            size = int(rng.integers(0, 60))
            fits = [x for x in held if x[0] >= size]
            assert tree.take_tightest(size) == (min(fits) if fits else None)
            if fits:
                held.remove(min(fits))


def test_best_fit_decreasing():
    assert packing.best_fit_decreasing([5, 4, 3, 3, 3, 2], 10) == [0, 0, 1, 1, 1, 2]
    assert packing.best_fit_decreasing([11], 10) is None
    sizes = [int(x) for x in np.random.default_rng(1).integers(1, 900, 300)]
    bins = packing.pack_into(sizes, 8)
    loads = np.bincount(bins, sizes, 8)
    assert loads.max() - loads.min() < 0.001 * loads.mean() and packing.pack_into([], 8) == []


def test_shards(spark):
    texts = [(i, f"text {i} " * (1 + i % 17)) for i in range(300)] + [(1000 + i, "hot " * 30) for i in range(900)]
    texts += [(5000, None), (5001, ""), (None, "no id"), (5002, "twice"), (5002, "twice")]
    rows = packing.shard_documents(spark, frame(spark, texts, True), grains=64).collect()
    assert len(rows) == len(texts)
    loads = collections.Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert set(loads) == set(range(8)) and max(loads.values()) < 1.15 * min(loads.values())
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    small = collections.defaultdict(set)
    for r in rows:
        if r.size != len("hot " * 30) + 1:
            small[r.group].add(r.shard)
    assert all(len(v) == 1 for v in small.values())
    assert packing.shard_documents(spark, frame(spark, [])).count() == 0


# language

def test_codewords_separate():
    for n in (2, 4, 6, 9, 30):
        w = language.codewords(n)
        assert all((w[i] != w[j]).any() for i in range(n) for j in range(i))


def test_language(spark, real):
    model = language.train(real)
    out = language.predict(frame(spark, [(1, None), (2, ""), (3, "123 !!"), (None, "der die das"), (4, "x" * 50000)]), model)
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert got[4].lang_pred in model.languages and got[None].lang_pred in model.languages
    joined = language.op4_ecoc_language(spark, FOLDER).join(real.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = joined.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right / n > 0.95
    assert joined.where("score < 0 OR score > 1").count() == 0
    nothing = language.predict(frame(spark, [(1, "abc")]), language.train(frame(spark, [])))
    assert [r.lang_pred for r in nothing.collect()] == ["und"]


# containment

def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_containment_is_exact(spark, real):
    item = words(1, 40)
    texts = [(r.doc_id, r.text) for r in real.collect()]
    filler = words(2, 4000)
    cut = item[:38] + ["other", "end"]
    texts += [(9001, " ".join(filler[:2000] + item + filler[2000:])), (9002, " ".join(filler[:500] + cut)), (9003, " ".join(item[:20])),
              (9004, None), (9005, ""), (None, " ".join(item)), (9001, "again")]
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text")
    items = [(r.item_id, r.text) for r in benchmark.collect()] + [(900, " ".join(item)), (901, "too short item"), (902, None), (None, "a b c d e f")]
    held = {i: shingles(t) for i, t in items if i is not None}
    want = set()
    for d, t in texts:
        have = shingles(t)
        want |= {(d, i) for i, s in held.items() if s and d is not None and len(s & have) * 5 >= 4 * len(s)}
    docs = frame(spark, texts, True)
    item_df = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit(1))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(spark, docs, item_df).collect()}
    assert got == want and (9001, 900) in want and (9002, 900) in want and (9003, 900) not in want
    kept = decontaminate.remove_contaminated(spark, docs, item_df)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - {d for d, _ in want}
    assert decontaminate.contained_items(spark, docs, item_df.limit(0)).count() == 0
    assert decontaminate.contained_items(spark, docs.limit(0), item_df).count() == 0


# suffixes

def test_long_matches(spark):
    a, b = " ".join(words(3, 60)), " ".join(words(4, 60))
    texts = [(5, a), (3, b), (7, a[:100] + b[30:120] + a[200:]), (9, a), (9, a), (8, a[10:59] + "Q" + a[59:]), (1, None), (2, ""),
             (None, a), (11, "x" * 49), (12, "y" * 400), (13, "y" * 120), (14, b[:49]), (15, b[:50]), (16, "é" * 30), (17, "é" * 30)]
    seen, want = {}, collections.Counter()
    for d, t in sorted(((d, t) for d, t in texts if d is not None), key=lambda x: x[0]):
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            seen.setdefault(raw[i:i + 50], d)
    for d, t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if d is not None and seen[raw[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        want[d, len(raw), int(gone.sum()), spans, kept] += 1
    got = suffix_dedup.removed_spans(spark, frame(spark, texts, True)).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in got) == want
    assert suffix_dedup.removed_spans(spark, frame(spark, [])).count() == 0


def test_family_merges_geometrically():
    family, rng = suffix_dedup.Family(), np.random.default_rng(5)
    held = collections.defaultdict(list)
    for batch in range(40):
        keys = np.unique(rng.integers(0, 500, 60)).astype(np.uint64)
        docs = rng.integers(0, 10 ** 6, len(keys))
        for k, d in zip(keys, docs):
            held[int(k)].append(int(d))
        family.add(suffix_dedup.Level(keys, docs))
        sizes = [len(level.keys) for level in family.levels]
        assert all(x > 2 * y for x, y in zip(sizes, sizes[1:]))
    keys = np.arange(500, dtype=np.uint64)
    docs, batches = family.scan(keys)
    assert all((docs[k] == min(held[k]) and batches[k] >= min(2, len(held[k]))) if k in held else batches[k] == 0 for k in range(500))


# near duplicates

def test_probability_jaccard_estimate_and_value():
    a, b = (np.sort(np.random.default_rng(i).integers(0, 300, 250).astype(np.uint64)) for i in (1, 2))
    sets = [np.unique(near_dedup.mix(x), return_counts=True) for x in (a, b)]
    p, q = ({k: c / s[1].sum() for k, c in zip(*s)} for s in sets)
    every = set(p) | set(q)
    want = sum(1 / sum(max(p.get(y, 0) / p[x], q.get(y, 0) / q[x]) for y in every) for x in set(p) & set(q))
    assert near_dedup.probability_jaccard(*sets) == pytest.approx(want)
    rounds = []
    for salt in range(12):
        hashes = np.concatenate([near_dedup.mix(s[0] + np.uint64(salt * 977)) for s in sets])
        owner = np.repeat([0, 1], [len(s[0]) for s in sets])
        held = near_dedup.registers(owner, hashes, np.concatenate([s[1] for s in sets]).astype(float), 2)
        rounds.append((held[0] == held[1]).mean())
    assert np.mean(rounds) == pytest.approx(want, abs=0.05)


def test_bands_reach_recall():
    for s, recall in ((0.8, 0.999), (0.7, 0.99)):
        b, r = bands_and_rows(s, recall)
        assert 1 - (1 - s ** r) ** b >= recall


def test_near_classes(spark):
    base = words(6, 200)
    near = lambda *at: " ".join("zz" + w if i in at else w for i, w in enumerate(base))
    texts = [(1, " ".join(words(7, 90))), (2, near()), (4, near(3)), (3, near(3, 90)), (5, near()), (6, None), (7, ""), (8, "  "), (9, "one two"),
             (10, "ONE  two"), (11, near(*range(0, 200, 3))), (12, near()), (12, near()), (None, near()), (13, "one"), (14, " ".join(words(7, 90)) * 60)]
    got = {r.doc_id: r for r in near_dedup.classify(spark, frame(spark, texts, True)).collect()}
    assert {d: r.class_id for d, r in got.items()} == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 6, 7: 7, 8: 8, 9: 9, 10: 9, 11: 11, 12: 2, 13: 13, 14: 1}
    # 14 repeats the text of 1, so its shingles are distributed alike
    assert got[2].links == 2 and got[1].links == 1 and got[11].links == 0
    docs = frame(spark, texts, True)
    kept = near_dedup.keep_one_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 6, 7, 8, 9, 11, 13, None], key=str)
    assert near_dedup.classify(spark, frame(spark, [])).count() == 0


def test_near_dedup_returns_class_ids_only(spark):
    assert near_dedup.op7_probminhash_near_dedup(spark, FOLDER).columns == ["doc_id", "class_id"]


def test_links_reach_across_a_bucket(spark, monkeypatch):
    # 1 and 2 share a bucket with 0 but are like each other only; 3-4 chain through another bucket
    monkeypatch.setattr(nearlinks, "TILE", 2)
    buckets = {0: [1, 91], 1: [1, 92], 2: [1, 2], 3: [3, 2], 4: [3, 94], 9: [95, 96]}
    like = {(1, 2), (2, 3), (3, 4)}
    things = spark.createDataFrame([(i, b"same", np.array(b, np.int64).tobytes()) for i, b in buckets.items()], "id long, sketch binary, bands binary")
    classes, links = linked_classes(spark, things, lambda ids: ids.select("id", F.col("id").cast("string").cast("binary").alias("content")),
                                    lambda a, b: tuple(sorted((int(a), int(b)))) in like, 0.5)
    assert dict(map(tuple, classes.collect())) == {1: 1, 2: 1, 3: 1, 4: 1} and links.count() == 3


def test_tiles_find_the_links_of_all_pairs():
    import pyarrow as pa

    rng = np.random.default_rng(7)
    key = np.sort(rng.integers(0, 6, 80))
    ids, labels, sketch = np.arange(80), rng.integers(0, 4, 80), rng.integers(0, 2, (80, 8)).astype(np.uint8)
    bands = np.stack([rng.integers(0, 9, 80), key + 100], 1)  # band 1 is the bucket at hand
    rows = pa.table({"key": key, "band": np.ones(80, np.int64), "id": ids, "label": labels, "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()),
                     "bands": pa.array([x.tobytes() for x in bands], pa.binary()), "content": pa.array([bytes([i]) for i in ids], pa.binary())})
    got = nearlinks.compare_tiles(0.6, lambda a, b: (a[0] + b[0]) % 3 > 0)(rows.take(rng.permutation(80)))
    want = [(i, j) for i in range(80) for j in range(i + 1, 80) if key[i] == key[j] and labels[i] != labels[j] and (i + j) % 3
            and (sketch[i] == sketch[j]).mean() >= 0.6 and bands[i, 0] != bands[j, 0]]
    assert sorted(zip(got["u"].to_pylist(), got["v"].to_pylist())) == want and want


def test_components(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (1, 2), (2, 1)]
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark, spark.createDataFrame(edges, "u long, v long"))
    assert dict(map(tuple, got.collect())) == {x: find(x) for x in parent}


# paragraphs

def test_passages(spark):
    shared, other = " ".join(words(11, 60)), " ".join(words(12, 80))
    changed = " ".join("zz" + w if i == 30 else w for i, w in enumerate(shared.split()))
    inside = " ".join(words(13, 25)) + " " + other + " " + " ".join(words(14, 25))
    own = [" ".join(words(20 + i, 20)) for i in range(8)]
    texts = [(2, own[0] + "\n" + shared + "\n" + own[1]), (5, shared + "\n" + own[2]), (1, own[3]), (7, own[4] + "\n" + changed + "\n\n" + own[5]),
             (3, other), (8, inside), (9, None), (10, ""), (11, "yes.\n" + own[6]), (12, "yes.\n" + own[7]), (None, shared), (13, shared + "\n" + shared), (14, "\n \n")]
    docs = frame(spark, texts, True)
    out = paragraphs.remove_repeats(spark, docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    given = dict(texts)
    assert got[5] == own[2] and got[7] == own[4] + "\n\n" + own[5] and got[13] == ""
    assert len(got[8].split()) <= 50 + 30 and got[8].startswith(" ".join(words(13, 25)))
    for same in (2, 1, 3, 9, 10, 11, 12, None, 14):
        assert got[same] == given[same]
    assert paragraphs.remove_repeats(spark, frame(spark, [])).count() == 0


def repeated_words(texts, least):
    """For each text the words inside a run of `least` words that also stands in a text of smaller id."""
    seen, gone = {}, {}
    for i, text in sorted(texts):
        parts = text.lower().split()
        runs_ = [tuple(parts[j:j + least]) for j in range(len(parts) - least + 1)]
        gone[i] = {j + x for j, r in enumerate(runs_) if seen.get(r, i) < i for x in range(least)}
        for r in runs_:
            seen.setdefault(r, i)
    return gone


def test_passages_inside_lines_equal_brute_force(spark):
    rng = np.random.default_rng(17)
    pool = words(30, 400)
    own = lambda n: list(rng.choice(pool, n))
    shared = [own(int(n)) for n in rng.integers(50, 100, 12)]
    texts = []
    for i in range(40):
        parts = own(int(rng.integers(5, 60)))
        for k in rng.choice(12, 2, replace=False):
            parts += shared[k] + own(int(rng.integers(1, 60)))
        breaks = rng.random(len(parts)) < 0.03  # line feeds anywhere, also inside a passage
        texts.append((i, "".join(w + ("\n" if b else " ") for w, b in zip(parts, breaks))))
    want = repeated_words(texts, paragraphs.RUN)
    got = {r.doc_id: {w for s in r.spans for w in range(s["first"], s["last"])} for r in paragraphs.passages(paragraphs.repeats(spark, frame(spark, texts))).collect()}
    assert sum(map(len, want.values())) > 1500
    shingles = lambda line: {tuple(line[j:j + 5]) for j in range(max(len(line) - 4, 1))}
    like = lambda a, b: a == b or (min(len(a), len(b)) >= paragraphs.LINE_WORDS and
                                   len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)))
    for i, text in texts:
        assert want[i] <= got.get(i, set())
        # beyond the runs only whole lines that an earlier document has, or has a similar one of
        place, lined = 0, set()
        for line in (x.split() for x in text.split("\n")):
            if any(like(line, other.split()) for j, t in texts[:i] for other in t.split("\n")):
                lined |= set(range(place, place + len(line)))
            place += len(line)
        assert got.get(i, set()) <= want[i] | lined


def test_rows_that_share_an_id_lose_their_own_words(spark):
    passage, a, b = " ".join(words(50, 60)), " ".join(words(51, 70)), " ".join(words(52, 70))
    texts = [(1, passage), (2, passage + " " + a), (2, b + " " + passage), (2, b)]
    got = sorted(r.text for r in paragraphs.remove_repeats(spark, frame(spark, texts)).collect())
    assert got == sorted([passage, a, b, b])


# quality

def kneser_ney(trusted, texts):
    order = quality.ORDER
    pad = lambda t: b"\0" * (order - 1) + (t or "").encode()
    counts = {order: collections.Counter(pad(t)[i:i + order] for t in trusted for i in range(len((t or "").encode())))}
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    cut, contexts = {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        cut[k] = [min(i, max(0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 for i in (1, 2, 3)]
        contexts[k] = collections.defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            contexts[k][g[:-1]][0] += v
            contexts[k][g[:-1]][1] += cut[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        if g[:-1] not in contexts[k]:
            return p(g[1:])
        total, left = contexts[k][g[:-1]]
        v = counts[k][g]
        return (max(v - (cut[k][min(v, 3) - 1] if v else 0), 0) + left * p(g[1:])) / total
    return [np.exp(-np.mean([np.log(p(pad(t)[i:i + order])) for i in range(len(t.encode()))])) if t else None for t in texts]


def test_perplexity_is_kneser_ney(spark, real):
    rows = [(r.doc_id, r.text[:600]) for r in real.limit(30).collect()] + [(900, None), (901, ""), (902, "ß\0日"), (None, "no id"), (3000, "x" * 40), (3000, "y")]
    trusted = spark.createDataFrame([(i,) for i, _ in rows[:12]], "doc_id long")
    want = kneser_ney([t for _, t in rows[:12]], [t for _, t in rows])
    got = quality.perplexities(spark, frame(spark, rows, True), trusted).collect()
    key = lambda d, n: (str(d), n)
    found = {key(r.doc_id, r.n_bytes): r.perplexity for r in got}
    assert len(got) == len(rows)
    for (d, t), w in zip(rows, want):
        value = found[key(d, len((t or "").encode()))]
        assert value == pytest.approx(w) if w is not None else value is None


def test_quality_decisions(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = quality.judge(spark, docs, labels).join(labels, "doc_id")
    share = {r.quality: r.kept for r in judged.where("quality = 0 OR toxic = 0").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.9 and share[0] < 0.3
    kept = quality.keep_good(spark, frame(spark, [(1, None), (2, ""), (3, "some text"), (None, "x")], True), labels.limit(0))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, None], key=str)
    assert quality.judge(spark, docs.limit(0), labels).count() == 0
    # each row by its own text: an empty one does not take a good one of its id along, and goes without an id as well
    rows = quality.keep_good(spark, frame(spark, [(7, "good text"), (7, ""), (None, None), (None, "x")], True), labels.limit(0))
    assert sorted(((r.doc_id, r.text) for r in rows.collect()), key=str) == sorted([(7, "good text"), (None, "x")], key=str)


def test_thresholds_are_out_of_sample(spark, real):
    rows = [(r.doc_id, r.text[:400]) for r in real.limit(24).collect()]
    docs, trusted = frame(spark, rows), spark.createDataFrame([(i,) for i, _ in rows[:20]], "doc_id long")
    folds = [r.fold for r in docs.select(F.expr(f"pmod(xxhash64(text), {quality.FOLDS})").alias("fold")).collect()]
    got = {r.doc_id: r.unseen for r in quality.perplexities(spark, docs, trusted).collect()}
    for fold in set(folds[:20]):
        mine = [i for i in range(20) if folds[i] == fold]
        want = kneser_ney([t for i, (_, t) in enumerate(rows[:20]) if folds[i] != fold], [rows[i][1] for i in mine])
        assert [got[rows[i][0]] for i in mine] == pytest.approx(want)
    assert all(got[d] is None for d, _ in rows[20:])


def test_clean_documents_kept_out_of_training_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    clean = quality.trusted_ids(labels)
    out = clean.where("pmod(xxhash64(doc_id, 5), 5) = 0")
    judged = quality.judge(spark, docs, labels.join(out, "doc_id", "left_anti"))
    rejected = judged.join(out, "doc_id").agg(F.avg(F.expr("int(NOT keep)"))).first()[0]
    bad = judged.join(labels.where("quality = 0"), "doc_id").agg(F.avg(F.expr("int(NOT keep)"))).first()[0]
    assert rejected < 0.08 and bad > 0.7


def test_every_byte_has_a_probability(spark):
    """Where counts of two are rarer than counts of three nothing is taken off them; a byte never seen after a context of counts of two still has a chance."""
    assert quality.discounts([625, 55, 149, 85])[1] == 0
    rng = np.random.default_rng(6)
    text = lambda n, letters: "".join(rng.choice(list(letters), n))
    thrice, twice = text(400, "abcd"), text(12, "wxyz")
    good = [thrice] * 3 + [twice] * 2 + [text(50, "abcdefgh") for _ in range(20)]
    rows = list(enumerate(good)) + [(100 + i, twice[:6 + i % 3] + "#" + text(30, "#%&")) for i in range(20)] + [(200 + i, text(60, "abcd")) for i in range(60)]
    trusted = spark.createDataFrame([(i,) for i in range(len(good))], "doc_id long")
    together = {r.doc_id: (r.perplexity, r.unseen) for r in quality.perplexities(spark, frame(spark, rows).coalesce(1), trusted).collect()}
    assert all(np.isfinite(x) and x > 1 for pair in together.values() for x in pair if x is not None)
    assert len([u for _, u in together.values() if u is not None]) == len(good)


def test_sums_stay_with_their_document():
    """A document without a probability takes nothing from the documents scored after it."""
    texts = ["abab", "", "zz", "ab", "zz", "abab", None]
    docs = pa.table({"block": [0] * 7, "doc_id": list(range(7)), "text": texts, "lang": ["en"] * 7, "fold": [0] * 7, "text_hash": [0] * 7})
    listed = quality.list_grams(docs, pa.table({"doc_id": [0]}), 1).to_pylist()[0]
    grams = np.cumsum(quality.unpack(listed["grams"], listed["n"]))
    logs = np.where(grams & 255 == ord("z"), -np.inf, -1.0)
    held = np.cumsum(quality.unpack(listed["held"], listed["m"]))
    row = {"block": 0, "shard": 0, "n": listed["n"], "m": listed["m"], "held": listed["held"], "logp": quality.pack(logs), "unseen": quality.pack(logs[held % listed["n"]])}
    scored = quality.score(docs, pa.Table.from_pylist([row]), 1)
    assert scored.column("logp").to_pylist() == [-4, 0, -np.inf, -2, -np.inf, -4, 0]
    assert scored.column("unseen").to_pylist()[0] == -4


def test_listed_ngrams_are_packed(real):
    """A listed n-gram takes a few bytes on disk, not a row, and a block is scored without temporary arrays of several times its size."""
    rows = [(r.doc_id, r.text or "") for r in real.collect()]
    while sum(len(t.encode()) for _, t in rows) < 6 << 20:
        rows += [(i + 10**6, t[::-1]) for i, t in rows]
    docs = pa.table({"block": [3] * len(rows), "doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "lang": ["en"] * len(rows),
                     "fold": [i % quality.FOLDS for i in range(len(rows))], "text_hash": [0] * len(rows)})
    trusted = pa.table({"doc_id": [i for i, _ in rows[::2]]})
    listed = quality.list_grams(docs, trusted, 5)
    assert sorted(listed.column("shard").to_pylist()) == list(range(5))
    want, lost = set(), collections.Counter()
    for n, (_, t) in enumerate(rows[:40]):
        data = b"\0" * 4 + t.encode()
        for i in range(len(data) - 4):
            want.add(int.from_bytes(data[i:i + 5], "big"))
            if n % 2 == 0:
                lost[n % quality.FOLDS, int.from_bytes(data[i:i + 5], "big")] += 1
    few = quality.gather(quality.list_grams(docs.slice(0, 40), trusted, 5).to_pylist())
    assert few.need.tolist() == sorted(want)
    got = dict(zip(zip((few.held >> 40).tolist(), (few.held & quality.GRAM).tolist()), (few.hc - few.hr).tolist()))
    assert got == lost
    entries = sum(listed.column("n").to_pylist()) + sum(listed.column("m").to_pylist())
    assert sum(listed.column(c).nbytes for c in ("grams", "held", "lost")) < 5 * entries
    logs = pa.Table.from_batches(quality.shard_logs(iter(listed.to_batches()), *_flat(quality.gather(listed.to_pylist()))))
    tracemalloc.start()
    scored = quality.score(docs, logs, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scored.num_rows == len(rows) and scored.column("logp").null_count == 0
    assert scored.filter(pc.is_in(scored["doc_id"], trusted["doc_id"].combine_chunks())).column("unseen").null_count == 0
    assert peak < 256 << 20


def test_scoring_a_block_takes_little_memory():
    """Scoring holds less than three times the text of a block; numbers for each byte of a block alone would take four times."""
    rng = np.random.default_rng(9)
    heap = words(10, 3000)
    texts = [" ".join(rng.choice(heap, 400)) for _ in range(6000)]
    docs = pa.table({"block": [0] * 6000, "doc_id": list(range(6000)), "text": texts, "lang": ["en"] * 6000, "fold": [i % 8 for i in range(6000)], "text_hash": [0] * 6000})
    listed = quality.list_grams(docs, pa.table({"doc_id": [0, 1, 2]}), 3).to_pylist()
    logs = pa.Table.from_pylist([{**{k: r[k] for k in ("block", "shard", "n", "m", "held")}, "logp": quality.pack(np.full(r["n"], -1.0)),
                                  "unseen": quality.pack(np.full(r["m"], -2.0))} for r in listed])
    tracemalloc.start()
    scored = quality.score(docs, logs, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = np.array([len(t) for t in texts])
    assert scored.column("logp").to_pylist() == (-size).tolist() and scored.column("unseen").to_pylist()[:3] == (-2 * size[:3]).tolist()
    assert scored.column("unseen").null_count == 5997 and peak < 3 * size.sum()


def _flat(longest):
    """Discounts by length and the short n-grams, as if all shards were one."""
    orders = {quality.ORDER: longest}
    for k in range(quality.ORDER - 1, 0, -1):
        orders[k] = quality.shorter(orders[k + 1], k)
    return {k: quality.cuts_of(quality.tally(o)) for k, o in orders.items()}, orders[quality.SHORT]


# top k

def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(700)] + [(i, [0.5] * 8) for i in range(700, 900)]
    rows += [(1000, None), (1020, [float("nan")] * 8), (1040, [1.0, None]), (1060, [float("inf")]), (None, [1.0] * 8), (1080, []), (1100, [2.0]), (900, [0.5] * 8), (900, [0.5] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("pivot", F.lit("x"))
    vectors = topk.whole_numbers(table)
    got = sorted(map(tuple, topk.exact_top_k(spark, vectors, vectors.where("vec_id % 20 = 0"), 20).collect()))
    fine = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in {i: v for i, v in fine if i % 20 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i)[:20]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.exact_top_k(spark, vectors.limit(0), vectors.limit(0)).count() == 0


def test_pruning_loses_nothing():
    rng = np.random.default_rng(4)
    heads = rng.integers(-4000, 4000, (12, 6))
    data = heads[rng.integers(0, 12, 900)] + rng.integers(-40, 40, (900, 6))
    queries = heads[rng.integers(0, 12, 60)] + rng.integers(-40, 40, (60, 6))
    scores = queries @ data.T
    worst = np.sort(scores, 1)[:, -10].astype(float)
    seen = np.zeros(scores.shape, bool)
    for mine, rows, block in topk.dual_search(queries, data, worst):
        seen[np.ix_(mine, rows)] = True
        assert (block == scores[np.ix_(mine, rows)]).all()
    assert seen[scores >= worst[:, None]].all() and seen.mean() < 0.9


# pipeline

def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] >= counts[4]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == counts[4] and json.dumps(last.columns)
    assert corpus_pipeline.run(spark, FOLDER).count() == counts[4]
