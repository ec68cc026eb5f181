"""The pipeline over rows with nulls, empty and very long texts, repeats and shared ids, and over empty tables."""

import hashlib

import numpy as np

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    pool = ["".join(np.random.default_rng(i).choice(list("abcdefghijklmnop"), 2 + i % 7)) for i in range(300)]
    return " ".join(rng.choice(pool, n))


def folder_of(spark, path, docs, labels, items):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_edge_rows(spark, tmp_path):
    item, passage = prose(900, 20), prose(901, 70)
    texts = [(i, prose(i, 120)) for i in range(12)]
    texts += [(20, None), (21, ""), (22, " \n\t "), (None, prose(50, 80)), (23, texts[0][1]), (24, texts[1][1] + " one more"), (25, prose(60, 6000)),
              (26, prose(61, 60) + " " + passage), (27, passage + "\n" + prose(62, 60)), (28, prose(63, 50) + " " + item + " " + prose(64, 50)),
              (29, prose(65, 90)), (29, prose(66, 90)), (29, prose(66, 90))]
    docs = [(i, t, "en" if i != 3 else None, None if i == 4 else "s", 0) for i, t in texts]
    labels = [(i, 1, 0) for i in range(12)] + [(None, 1, 0), (5, None, None)]
    folder = folder_of(spark, tmp_path, docs, labels, [(1, item), (2, None), (3, "")])
    stages, held = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, folder)
        assert held.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        stages[name] = [(r.doc_id, r.text) for r in held.collect()]
    kept = stages["quality classifier"]
    assert not {20, 21}.intersection(i for i, _ in kept) and {i for i, _ in kept} >= {None, 0, 11, 23, 29}
    near = [i for i, _ in stages["MinHash near-dedup"]]
    assert 0 in near and 23 not in near and 24 not in near and None in near
    repeats = dict(stages["substring dedup"])
    assert passage in repeats[26] and passage.split()[5] + " " + passage.split()[6] not in repeats[27] and prose(62, 60) in repeats[27]
    assert 28 not in [i for i, _ in stages["benchmark decontamination"]]
    final = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.decoded_sha256 for r in final) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in stages["benchmark decontamination"])


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, [], [], [])).count() == 0
