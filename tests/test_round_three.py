"""Positions, narrowed comparison, stored edits, versioned tables, run claims, facets, checks and postings."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from martlab.operators import changes, freshness, narrow, quality, record_filters, stored, text_index
from martlab.operators.membership import key_parity
from martlab.operators.positions import Ordered
from martlab.session import shared_folder
from martlab.sources.tables import write_table
from martlab.sources.versioned import VersionedTable

from .conftest import plan_of, rows


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture
def database(spark):
    name = f"db_{random.getrandbits(48):x}"
    folder = f"{shared_folder(spark)}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/database'")
    yield name, folder
    spark.sql(f"DROP DATABASE {name} CASCADE")


# --- positions ---


def test_positions_and_pages(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(20)]), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, i int").repartition(6)
    ordered = Ordered(df, F.col("k").desc_nulls_last(), "i", ranges=7)
    want = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = {r.position: (r.k, r.i) for r in ordered.rows().collect()}
    assert [got[n] for n in range(1, 501)] == want and ordered.total == 500
    for first, size in [(1, 10), (95, 130), (500, 5), (501, 5), (3, 0)]:
        page = {r.place: (r.k, r.i) for r in ordered.page(first, size, "place").collect()}
        assert page == dict(enumerate(want[first - 1:first - 1 + size], first))
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(_slot" in final_plan(ordered.page(95, 130)) or "GreaterThanOrEqual(_slot" in final_plan(ordered.page(95, 130))
    assert "Window" not in plan_of(ordered.rows())
    empty = Ordered(df.limit(0), "i")
    assert empty.rows().collect() == [] and empty.page(1, 5).collect() == []
    with pytest.raises(ValueError):
        ordered.page(0, 5)


# --- narrowed comparison ---


def test_equal_tables_are_not_joined(spark, tmp_path):
    spark.range(20000).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    diff = narrow.narrowed_diff(a, a.repartition(3), "id")
    plan = final_plan(diff)
    assert diff.collect() == [] and "Join" not in plan and "Sort" not in plan.replace("SortAggregate", "")
    parity = narrow.narrowed_parity(a, a.repartition(3), "id", ["id", "v"], ours_name="x", theirs_name="y")
    assert parity.collect() == []


def test_narrowing_sorts_no_rows(spark):
    """A task holds one table of digests for both sides and the buckets wanted of it, no sorted rows, however little may be broadcast."""
    a = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("t"))
    b = spark.createDataFrame([(i, i % 7 + (i == 5), "x" if i == 9 else None) for i in range(3000) if i != 40] + [(8, 1, None)], "id long, v long, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = narrow.narrowed(a, b, ["id"], ["v", "t"])
        plans = [plan_of(x) for x in few]
        assert all("Sort" not in p and "ShuffledHashJoin" in p for p in plans)
        digests = plan_of(narrow.differing_buckets(a, b, ["id"], ["v", "t"], 1))
        assert digests.count("HashAggregate") == 2 and digests.count("Exchange") == 1  # per task and over tasks
        assert [{r.id for r in x.collect()} for x in few] == [{5, 8, 9, 40}, {5, 8, 9}]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_narrowed_rows_equal_whole_comparison(spark):
    rng = random.Random(2)
    a = [(i, rng.randrange(3), None) for i in range(3000)] + [(None, 1, "n")]
    b = [(i, v + (i in (17, 900)), "new" if i == 5 else None) for i, v, _ in a[:-1] if i not in (3, 44)] + [(5000, 1, "x"), (None, 1, "n")]
    x, y = (spark.createDataFrame(r, "id int, v int, t string") for r in (a, b))
    with_keys = [df.where("id IS NOT NULL") for df in (x, y)]
    assert rows(narrow.narrowed_diff(*with_keys, "id")) == rows(changes.dataset_diff(*with_keys, "id")) != []
    names = {"ours_name": "a", "theirs_name": "b"}
    assert rows(narrow.narrowed_parity(x, y, "id", ["id", "v"], **names)) == rows(key_parity(x, y, "id", ["id", "v"], **names))
    left, right = narrow.narrowed(*with_keys, ["id"], ["v", "t"])
    assert left.count() < 30 and right.count() < 30
    # a row that comes twice on one side, and a null that becomes a text, are differences
    twice = narrow.narrowed(x.unionByName(x.where("id = 9")), x, ["id"], ["v"])
    assert twice[0].where("id = 9").count() == 2


# --- stored edits ---

RECORD = "id long, category string, month int, item string, value double, accepted int"


def test_edits_touch_their_partitions_only(spark, database):
    name = f"{database[0]}.records"
    records = spark.createDataFrame([(i, "a", 1, "x", 1.0, 0) for i in range(100)], RECORD)
    assert stored.store_records(records, name, rows_per_part=10) == 100
    edits = spark.createDataFrame([(3, "month", "12", 1), (3, "month", "13", 2), (3, "accepted", "7", 3), (42, "item", " ", 4), (47, "item", "y", 5),
                                   (999, "item", "z", 6), (None, "item", "z", 7), (48, "nothing", "z", 8)], "id long, field string, new_value string, seq int")
    with pytest.raises(Exception, match="Invalid field"):
        stored.edit_records(spark, name, edits)
    edits = edits.where("field <> 'nothing'")
    others = stored.file_digest(spark, name, but=[0, 4])
    mine = stored.file_digest(spark, name, but=[1, 2, 3, 5, 6, 7, 8, 9])
    touched, refused = stored.edit_records(spark, name, edits)
    assert touched == [0, 4] and sorted(r.seq for r in refused.collect()) == [2, 3, 4]
    assert stored.file_digest(spark, name, but=[0, 4]) == others and stored.file_digest(spark, name, but=[1, 2, 3, 5, 6, 7, 8, 9]) != mine
    got = {r.id: r for r in spark.table(name).collect()}
    assert len(got) == 100 and got[3].month == 12 and got[3].accepted == 0 and got[42].item == "x" and got[47].item == "y"
    assert stored.edit_records(spark, name, edits.limit(0))[0] == []
    with pytest.raises(ValueError, match="rewrite"):
        stored.edit_records(spark, name, edits, most_parts=1)


# --- versioned tables ---


def test_readers_never_miss_a_versioned_table(spark, database):
    table = VersionedTable(spark, f"{database[0]}.t", database[1])
    assert table.current() is None and table.versions() == []
    table.replace(spark.range(10))
    stop, seen, failed = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(table.read().count())
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(11, 16):
        assert table.replace(spark.range(n)) == n
    stop.set()
    reader.join()
    assert not failed and seen <= set(range(10, 16))
    with pytest.raises(Exception):
        table.replace(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")))
    assert table.read().count() == 15 and len(table.versions()) == 6
    assert len(table.expire(keep=2)) == 4 and table.read().count() == 15
    assert table.replace(spark.range(0).withColumn("b", F.lit(1))) == 0 and table.read().columns == ["id", "b"]


# --- run claims ---


def test_two_schedulers_run_once(spark, database):
    name, day = f"{database[0]}.log", "2026-01-05"
    write_table(spark.createDataFrame([], freshness.LOG_SCHEMA), name)
    fresh = spark.createDataFrame([("s", dt.date(2026, 1, 5))], "n string, d date")
    both, ran, status = threading.Barrier(2), [], []

    def ready():
        both.wait(60)  # both have passed the look at the log
        return freshness.source_freshness({"s": (fresh, "d")}, day)

    def run():
        claim = freshness.RunClaim(spark, database[1], "refresh", day)
        status.append(freshness.gated_run(spark, name, ready, lambda: ran.append(1), today=day, now=f"{day} 08:00:00", claim=claim))

    threads = [threading.Thread(target=run) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(status) == ["SKIPPED_ALREADY_RAN", "SUCCESS"] and ran == [1]
    # a failed run gives its claim back
    def broken():
        raise RuntimeError("no")

    later = freshness.RunClaim(spark, database[1], "refresh", "2026-01-06")
    fresh2 = lambda: freshness.source_freshness({"s": (fresh, "d")}, day)
    assert freshness.gated_run(spark, name, fresh2, broken, today="2026-01-06", now="2026-01-06 08:00:00", claim=later) == "ERROR"
    assert later.take() and not later.take()


# --- facets, checks, search ---


def test_all_facets_equal_one_query_each(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice(["a", "B", None]), rng.choice(["1", "2,000", "x", None]), rng.choice([1, 2, 3])) for _ in range(60)],
                               "c string, n string, m int")
    filters = {"c": {"mode": "set", "allowed": ["a", "None"]}, "n": {"mode": "range", "min": 1, "max": 1999}, "m": {"mode": "set", "allowed": ["1", "3"]}}
    for active in (filters, {"c": filters["c"], "m": None}, {}):
        got = record_filters.all_facets(df, active, ["c", "n", "m"])
        want = [(c, r.value) for c in ("c", "m", "n") for r in record_filters.facet_values(df, active, c).collect()]
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_checks_take_one_pass(spark, tmp_path):
    data = [(1, "a", 0.0), (1, None, -0.0), (2, "a", None), (None, "b", 3.0)]
    spark.createDataFrame(data, "k int, s string, d double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.run_checks(df, not_null=["k"], unique=["k", "s", "d"], accepted={"s": ["a"]}, rules={"low": "k < 2", "all": F.lit(True)})
    plan = final_plan(report)
    assert plan.count("FileScan") == 1
    assert rows(report) == sorted([("not_null:k", 1, False), ("accepted:s", 1, False), ("rule:low", 1, False), ("rule:all", 0, True),
                                   ("unique:k", 1, False), ("unique:s", 1, False), ("unique:d", 1, False)], key=repr)
    assert {r.failures for r in quality.run_checks(df.limit(0), not_null=["k"], unique=["k"]).collect()} == {0}


def test_search_by_postings(spark, database):
    words = ["Furniture", "BUILDING", "büro", "a_b", "10%", "", None, "xy", "aaa aaa", "c\\d e"]
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.choice(words), rng.choice(words)) for i in range(200)], "id long, category string, item string")
    name = f"{database[0]}.pieces"
    text_index.build_index(df, name, ["category", "item"], buckets=8)
    for term in ("furn", "URNIT", "BÜRO", "a_b", "%ild%ng", "10%", "xy", "x", "aaaa", "a a", "c\\d", "nothing at all", "%"):
        pattern = "%" + term.replace("\\", "\\\\") + "%"
        want = df.where(F.col("category").ilike(pattern) | F.col("item").ilike(pattern))
        assert rows(text_index.indexed_search(df, name, ["category", "item"], term)) == rows(want), term
    # only the bucket of the piece is read; the plan tells so when it keeps the buckets as partitions
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 8" in plan_of(text_index.candidates(spark, name, ["fur"]), whole=True)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
