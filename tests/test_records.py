import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from martlab.operators import changes, freshness, quality, record_filters
from martlab.sources.tables import write_table

from .conftest import rows

RECORDS = [(1, "North", 1, "Item 1", 10.0, 0), (2, "South", 2, "item 2", 20.0, 1), (12, "north-east", 2, "Other", 5.0, 0)]
SCHEMA = "id long, category string, month int, item string, value double, accepted int"


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(RECORDS, SCHEMA)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_wildcards(records):
    assert len(ids(record_filters.filter_records(records))) == 3
    assert ids(record_filters.filter_records(records, "South", "2")) == [2]
    assert [r[0] for r in record_filters.distinct_values(records, "month").collect()] == [1, 2]


def test_column_filters_and_facets(spark):
    df = spark.createDataFrame([(1, "1,200.5", "b"), (2, "x", "A"), (3, None, None), (4, "30", "c"), (5, "30d", "a")], "id int, v string, t string")
    found = record_filters.apply_column_filters
    assert sorted(ids(found(df, {"v": {"mode": "range", "min": 31, "max": None}}))) == [1]
    assert sorted(ids(found(df, {"v": {"mode": "range"}, "t": None}))) == [1, 4]
    assert sorted(ids(found(df, {"t": {"mode": "set", "allowed": ["None", "c"]}, "id": {"mode": "set", "allowed": [3, 4]}}))) == [3, 4]
    assert ids(found(df, {"t": {"mode": "set", "allowed": []}})) == []
    filters = {"t": {"mode": "set", "allowed": ["b"]}, "id": {"mode": "range", "min": 1, "max": 4}}
    assert [r[0] for r in record_filters.facet_values(df, filters, "t").collect()] == ["A", "b", "c", "None"]


def test_typed_sort(spark):
    df = spark.createDataFrame([(1, "100"), (2, "9"), (3, "n/a"), (4, "9"), (5, None)], "id int, v string").coalesce(1)
    sort = record_filters.typed_sort
    assert ids(sort(df, "v", kind="num")) == [2, 4, 1, 3, 5]
    assert ids(sort(df, "v", kind="num", ascending=False)) == [3, 5, 1, 2, 4]
    assert ids(sort(df.withColumn("v", F.upper("v")), "v")) == [1, 2, 4, 3, 5]


def test_search(records):
    search = record_filters.search_records
    assert search(records, " ").count() == 0 and search(records, None).count() == 0
    assert ids(search(records, "12")) == [12]
    assert ids(search(records, "NORTH")) == [1, 12]
    assert ids(search(records, "item", limit=1)) == [1]
    first = search(records, "north").withColumn("back", record_filters.suggestion_id("suggestion")).first()
    assert first["suggestion"] == "1 | North | Item 1 | m=1" and first["back"] == 1
    assert ids(record_filters.get_record(records, 2)) == [2]


@pytest.mark.parametrize("value, expected", [("7 | x", 7), ("x | 7", None), ("", None), (" 8 ", 8), ("7x", None)])
def test_suggestion_id(spark, value, expected):
    assert spark.range(1).select(record_filters.suggestion_id(F.lit(value)).alias("x")).first()["x"] == expected


def test_changes(spark, records):
    edits = spark.createDataFrame([
        (1, "month", "5", 1), (1, "month", "6", 3), (1, "month", "4", 2), (1, "item", "New", 1), (2, "value", "7.5", 1), (99, "month", "1", 1),
    ], "id long, field string, new_value string, seq long")
    got = changes.apply_changes(records, edits)
    assert rows(got)[:2] == sorted([(1, "North", 6, "New", 10.0, 0), (12, "north-east", 2, "Other", 5.0, 0)], key=repr)[:2]
    assert got.count() == 3 and got.schema == records.schema
    wrong = spark.createDataFrame([(1, "id", "5", 1)], edits.schema)
    with pytest.raises(Exception, match="Invalid field"):
        changes.apply_changes(records, wrong).collect()
    bad = spark.createDataFrame([
        (1, "month", "13", 1), (2, "month", "x", 2), (3, "accepted", "2", 3), (4, "item", " ", 4), (5, "value", "?", 5), (6, "id", "1", 6),
        (7, None, "1", 7), (8, "month", "12", 8), (9, "item", "ok", 9), (10, "category", None, 10),
    ], edits.schema)
    assert sorted(ids(changes.rejected_changes(bad))) == [1, 2, 3, 4, 5, 6, 7, 10]
    chosen = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long")
    assert {r["id"]: r["accepted"] for r in changes.toggle_flag(records, chosen).collect()} == {1: 1, 2: 0, 12: 0}


def test_checks(spark, records):
    broken = records.unionByName(spark.createDataFrame([(1, " ", 13, None, 1.0, 2), (None, "x", None, "y", 1.0, 0)], SCHEMA))
    assert quality.check_not_null(broken, "id").count() == 1
    assert rows(quality.check_unique(broken, "id")) == [(1, 2)]
    assert rows(quality.check_accepted(broken, "accepted", [0, 1])) == [(2, 1)]
    assert quality.check_predicate(broken, F.expr(quality.RECORD_RULES["month_in_range"])).count() == 1  # NULL passes
    report = quality.run_checks(broken, not_null=["id", "item"], unique=["id", "month"], accepted={"accepted": [0, 1]}, rules=quality.RECORD_RULES)
    assert {r["check"]: r["failures"] for r in report.collect()} == {
        "not_null:id": 1, "not_null:item": 1, "unique:id": 1, "unique:month": 1, "accepted:accepted": 1, "rule:month_in_range": 1,
        "rule:accepted_is_flag": 1, "rule:category_not_blank": 1, "rule:item_not_blank": 0}
    with pytest.raises(ValueError):
        quality.run_checks(broken)


@pytest.mark.parametrize("hits, fails", [(98, False), (97, True)])
def test_rate(spark, hits, fails):
    found = quality.check_rate(spark.range(100).select((F.col("id") < hits).alias("ok")), "ok").collect()
    assert bool(found) == fails
    if fails:
        assert found[0]["failure_reason"] == "Collateral match rate 97.0% is below 98% threshold"
    assert quality.check_rate(spark.range(0).select((F.col("id") < hits).alias("ok")), "ok").count() == 0


DAY = "2026-04-21"


def sources(spark, *days):
    return {f"s{i}": (spark.createDataFrame([(d,)] if d else [], "d string").select(F.col("d").cast("date")), "d") for i, d in enumerate(days)}


def run_log(spark, *runs):
    parse = dt.datetime.fromisoformat
    return spark.createDataFrame([(i, parse(t), s, None, None, None, None) for i, (t, s) in enumerate(runs, 1)], freshness.LOG_SCHEMA)


@pytest.mark.parametrize("days, runs, status, ready", [
    ((DAY, DAY), (), "SUCCESS", True),
    ((DAY, "2026-04-20"), (), "SKIPPED_SOURCES", False),
    ((DAY, None), (), "SKIPPED_SOURCES", False),
    ((DAY,), ((DAY + " 01:00:00", "SUCCESS"),), "SKIPPED_ALREADY_RAN", None),
    ((DAY,), ((DAY + " 01:00:00", "ERROR"),), "SUCCESS", True),
    ((DAY,), (("2026-04-20 23:00:00", "SUCCESS"),), "SUCCESS", True),
])
def test_decision(spark, days, runs, status, ready):
    fresh = freshness.source_freshness(sources(spark, *days), DAY)
    row = freshness.run_decision(run_log(spark, *runs), fresh, DAY, DAY + " 12:00:00").first()
    assert (row["status"], row["sources_ready"], row["log_id"]) == (status, ready, len(runs) + 1)


def test_no_sources_are_not_ready(spark):
    none = spark.createDataFrame([], "source_name string, is_current boolean")
    assert tuple(freshness.sources_ready(none).first()) == (0, 0, False)
    assert freshness.all_true(none, "is_current").first()[0] is False


def test_gated_run(spark):
    name = f"gate_{uuid.uuid4().hex[:8]}.runs"
    write_table(run_log(spark), name)
    done = []

    def go(days, job):
        return freshness.gated_run(spark, name, lambda: freshness.source_freshness(sources(spark, *days), DAY), job, today=DAY, now=DAY + " 12:00:00")

    def broken():
        raise RuntimeError("no disk")

    def no_view():
        raise RuntimeError("view is broken")

    assert go((DAY, "2026-04-20"), lambda: done.append(1)) == "SKIPPED_SOURCES"
    assert freshness.gated_run(spark, name, no_view, lambda: done.append(1), today=DAY, now=DAY + " 12:00:00") == "ERROR"
    assert go((DAY,), broken) == "ERROR" and done == []
    assert go((DAY,), lambda: done.append(1)) == "SUCCESS"
    assert go((DAY,), lambda: done.append(1)) == "SKIPPED_ALREADY_RAN"
    assert done == [1]
    log = {r["log_id"]: (r["status"], r["error_detail"]) for r in spark.table(name).collect()}
    assert log == {1: ("SKIPPED_SOURCES", None), 2: ("ERROR", "view is broken"), 3: ("ERROR", "no disk"), 4: ("SUCCESS", None), 5: ("SKIPPED_ALREADY_RAN", None)}
    assert [r["log_id"] for r in freshness.last_runs(spark.table(name), 2).collect()] == [5, 4]


def test_control_flag(spark):
    control = spark.createDataFrame([("a", False, None), ("b", True, None), ("c", False, None)], "task_name string, has_run boolean, ran_at timestamp")
    for task, expected in (("a", [True, True, False]), ("b", [False, True, False])):
        got = freshness.set_control_flag(control, task, DAY + " 12:00:00").orderBy("task_name").collect()
        assert [r["has_run"] for r in got] == expected
        assert [r["ran_at"] is not None for r in got] == [task == "a", False, False]
