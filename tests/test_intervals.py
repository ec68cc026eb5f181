import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlab.operators import intervals as iv
from martlab.plans import workforce

from .conftest import plan_of, rows

BASE = dt.datetime(2026, 4, 21)


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


keys = st.sampled_from(["a", "b", None])
minutes = st.integers(0, 3000)
spans = st.lists(st.tuples(keys, minutes, st.integers(-50, 400)), max_size=25)


def frame(spark, items, names):
    return spark.createDataFrame([(k, at(s), at(s + n)) for k, s, n in items], f"k string, {names[0]} timestamp_ntz, {names[1]} timestamp_ntz")


def shared(left, right):
    """Minutes shared with every interval of the same key, pair by pair."""
    total = 0
    for k, s, n in right:
        if k is not None and k == left[0]:
            total += max(0, min(left[1] + left[2], s + n) - max(left[1], s))
    return total


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(spans, spans)
def test_overlap_sums_agree_with_pairs(spark, left, right):
    right = right + right[:3]  # copies count again
    a, b = frame(spark, left, ("s", "e")), frame(spark, right, ("f", "t"))
    expected = Counter((k, at(s), at(s + n), 60_000_000 * shared((k, s, n), right)) for k, s, n in left)
    how = {"start": "s", "end": "e", "right_start": "f", "right_end": "t"}
    got = iv.overlap_micros(a, b, ["k"], **how).collect()
    assert Counter(tuple(r) for r in got) == expected


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, st.integers(0, 2900), st.sampled_from("xyz")), max_size=40), st.sampled_from([1, 10, 600]))
def test_event_intervals_agree_with_a_sorted_scan(spark, events, slot):
    events = events + events[:4] + events[:2]  # repeated log lines
    log = spark.createDataFrame([(k, at(m), v) for k, m, v in events], "k string, ts timestamp_ntz, v string")
    days = defaultdict(list)
    for k, m, v in events:
        days[k, at(m).date()].append((at(m), v))
    expected = Counter()
    for (k, day), found in days.items():
        found.sort()
        for (start, v), (end, _) in zip(found, found[1:]):
            expected[k, day, start, end, v] += 1
    got = iv.close_events(log, ["k"], "ts", then_by=["v"], slot_minutes=slot).select("k", iv.DAY, iv.START, iv.END, "v")
    assert Counter(tuple(r) for r in got.collect()) == expected
    merged = iv.close_events(log, ["k"], "ts", then_by=["v"], slot_minutes=slot, merge_copies=True)
    long = Counter({e: n for e, n in expected.items() if e[3] > e[2]})
    got = [tuple(r) for r in merged.select("k", iv.DAY, iv.START, iv.END, "v").collect()]
    assert Counter(r for r in got if r[3] > r[2]) == long


def test_many_copies_come_back(spark):
    log = spark.range(2500).selectExpr("'a' AS k", "TIMESTAMP_NTZ'2026-04-21 08:00:00' AS ts", "'x' AS v").unionByName(
        spark.range(1).selectExpr("'a' AS k", "TIMESTAMP_NTZ'2026-04-21 09:00:00' AS ts", "'y' AS v")
    )
    closed = iv.close_events(log, ["k"], "ts", then_by=["v"])
    lengths = Counter((r[iv.END] - r[iv.START]).seconds for r in closed.collect())
    assert lengths == {0: 2499, 3600: 1}


def test_clip(spark):
    a = frame(spark, [("a", 0, 60), ("a", 60, 60), ("a", 300, 10), ("b", 0, 60)], ("s", "e"))
    w = frame(spark, [("a", 30, 60), ("a", 100, 100)], ("window_start", "window_end"))
    got = iv.clip_to_window(a, w, ["k"], start="s", end="e").select("clipped_start", "clipped_end")
    assert rows(got) == sorted([(at(30), at(60)), (at(60), at(90)), (at(100), at(120))], key=repr)


def test_touching_and_covering_breaks(spark):
    a = frame(spark, [("a", 60, 60)], ("s", "e"))
    how = {"start": "s", "end": "e", "right_start": "f", "right_end": "t"}
    for right, expected in [([("a", 0, 60)], 0), ([("a", 120, 10)], 0), ([("a", 0, 500)], 60), ([("a", 70, 10), ("a", 75, 10)], 20)]:
        got = iv.overlap_micros(a, frame(spark, right, ("f", "t")), ["k"], **how).first()["overlap_us"]
        assert got == expected * 60_000_000


def test_no_pairs_in_the_plans(spark):
    a = frame(spark, [("a", 0, 1)], ("s", "e"))
    how = {"start": "s", "end": "e", "right_start": "s", "right_end": "e"}
    plan = plan_of(iv.overlap_micros(a, a, ["k"], **how))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- the workforce marts on hand-made rows ---


def tables(spark, log=(), roster=(), breaks=(), leave=(), partial=(), people=()):
    parse = dt.datetime.fromisoformat
    made = {
        "log": spark.createDataFrame([(parse(t), p, None, s) for t, p, s in log], "tstamp timestamp_ntz, payroll string, oldstatus string, newstatus string"),
        "roster": spark.createDataFrame(
            [(k, p, parse("1899-12-30 " + s), parse("1899-12-30 " + f), float(h), parse(d)) for k, p, s, f, h, d in roster],
            "roster_key long, payroll string, start timestamp_ntz, finish timestamp_ntz, hours double, rdate timestamp_ntz"),
        "breaks": spark.createDataFrame(
            [(k, p, parse(f), parse(t), b, "", "") for k, p, f, t, b in breaks],
            "roster_key long, person string, `from` timestamp_ntz, `to` timestamp_ntz, break int, label string, notes string"),
        "leave": spark.createDataFrame([(p, parse(f), parse(t), 1, 8.0, k) for p, f, t, k in leave],
                                       "payroll string, start timestamp_ntz, stop timestamp_ntz, days int, hours double, type string"),
        "partial": spark.createDataFrame([(p, parse(f), parse(t), k) for p, f, t, k in partial],
                                         "payroll string, leavestart timestamp_ntz, leavefinish timestamp_ntz, leavetype string"),
        "people": spark.createDataFrame(list(people), "payroll string, surname string, firstname string, team string, lob string"),
    }
    return made


ROSTER = [(89183, "ABAL", "08:00:00", "17:00:00", 8, "2026-04-21")]
BREAKS = [
    (89183, "ABAL", "2026-04-21 14:45:00", "2026-04-21 15:00:00", 1), (89183, "ABAL", "2026-04-21 09:45:00", "2026-04-21 10:00:00", 1),
    (89183, "ABAL", "2026-04-21 10:00:00", "2026-04-21 11:00:00", 0), (89183, "ABAL", "2026-04-21 11:45:00", "2026-04-21 12:45:00", 1),
]


def test_adherence(spark):
    log = [("2026-04-21 07:00:00", "ABAL", "Waiting"), ("2026-04-21 09:30:00", "ABAL", "Connected"), ("2026-04-21 11:00:00", "ABAL", "(Logged Out)"),
           ("2026-04-21 11:15:00", "ABAL", "Waiting"), ("2026-04-21 18:00:00", "ABAL", "Waiting")]
    t = tables(spark, log, ROSTER, BREAKS, people=[("ABAL", "Smith", "Jo", "T", "BNA")])
    row = workforce.adherence_daily(t["log"], t["roster"], t["breaks"], t["people"]).first()
    # productive: 8:00-9:30, then 9:30-11:00 less 75 minutes, then 11:15-17:00 less 75; other: 15 minutes
    assert (row["adherent_seconds"], row["non_adherent_seconds"]) == ((90 + 15 + 270) * 60, 15 * 60)
    assert row["adherence_pct"] == round(375 / 390, 4)
    assert (row["rostered_time"], row["rostered_activity_time"], row["scheduled_productive_time"]) == ("08:00:00", "02:30:00", "05:30:00")
    assert (row["firstname"], row["lob"]) == ("Jo", "BNA")


def test_adherence_without_log_and_with_two_rosters(spark):
    log = [("2026-04-21 08:00:00", "ABAL", "Waiting"), ("2026-04-21 09:00:00", "ABAL", "Break"), ("2026-04-21 10:00:00", "ABAL", "Waiting"),
           ("2026-04-22 08:00:00", "ABAL", "Waiting")]
    roster = ROSTER + [(2, "ABAL", "08:30:00", "09:30:00", 1, "2026-04-21"), (3, "ABAL", "08:00:00", "17:00:00", 8, "2026-04-22"),
                       (4, "NITE", "22:00:00", "06:00:00", 8, "2026-04-21")]
    t = tables(spark, log, roster)
    got = workforce.adherence_daily(t["log"], t["roster"], t["breaks"], t["people"])
    found = rows(got.select("payroll", "work_date", "rostered_seconds", "adherent_seconds", "non_adherent_seconds", "adherence_pct"))
    day, next_day = dt.date(2026, 4, 21), dt.date(2026, 4, 22)
    assert found == sorted([
        # both rosters show the intervals clipped to each of them
        ("ABAL", day, 28800, 5400, 5400, 0.5), ("ABAL", day, 3600, 5400, 5400, 0.5),
        ("ABAL", next_day, 28800, 0, 0, None),  # a single event has no end
        ("NITE", day, 28800, 0, 0, None),  # overnight shifts are lost
    ], key=repr)


def test_absenteeism(spark):
    leave = [("ABAL", "2026-04-21 09:00:00", "2026-04-21 12:00:00", "PTO - Vacation"), ("NOBODY", "2026-04-21 09:00:00", "2026-04-21 12:00:00", "PTO")]
    partial = [("ABAL", "2026-04-21 15:00:00", "2026-04-17 17:00:00", "Late Arrival"),  # ends before it starts
               ("ABAL", "2026-04-21 14:30:00", "2026-04-21 15:30:00", "Late Arrival"), ("ABAL", "2026-04-21 16:00:00", "2026-04-21 16:30:00", None)]
    t = tables(spark, (), ROSTER, BREAKS, leave, partial)
    args = (t["roster"], t["breaks"], t["leave"], t["partial"], t["people"])
    row = workforce.absenteeism_daily(*args).first()
    # vacation 3 h less two breaks of 15 minutes, late arrival 1 h less 15 minutes, half an hour without a type
    assert (row["break_lunch_hours"], row["scheduled_hours"], row["absenteeism_hours"]) == (1.5, 6.5, 3.75)
    assert row["absenteeism_pct"] == round(3.75 / 6.5, 4)
    assert row["leave_types"] == "PTO - Vacation | Late Arrival | Late Arrival"
    by_type = rows(workforce.absenteeism_by_type(*args).select("payroll", "leave_type", "absenteeism_hours"))
    assert by_type == sorted([("ABAL", "PTO - Vacation", 2.5), ("ABAL", "Late Arrival", 0.75), ("ABAL", None, 0.5)], key=repr)


def test_breaks_of_another_day_do_not_count(spark):
    t = tables(spark, (), [(89183, "ABAL", "08:00:00", "17:00:00", 8, "2026-04-16")], BREAKS)
    row = workforce.absenteeism_daily(t["roster"], t["breaks"], t["leave"], t["partial"], t["people"]).first()
    assert (row["scheduled_hours"], row["absenteeism_hours"], row["leave_types"], row["absenteeism_pct"]) == (8.0, 0.0, "", 0.0)


def _final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_log_is_read_and_dealt_once(spark):
    from checks.queries import QUERIES

    plan = _final_plan(QUERIES["event_intervals"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


def test_left_side_of_an_overlap_sum_is_read_once(spark):
    from checks.queries import QUERIES

    # one scan for each side, and four shuffles beside the two that make the breaks and sum their end points
    plan = _final_plan(QUERIES["overlap_seconds"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") == 1
    assert plan.count(" Exchange hashpartitioning") <= 6


def test_overlap_with_missing_times_and_keys(spark):
    a = spark.createDataFrame([("a", None, at(5)), ("a", at(5), None), (None, at(0), at(60)), ("a", at(9), at(3)), ("a", at(0), at(60))] * 2,
                              "k string, s timestamp_ntz, e timestamp_ntz")
    b = frame(spark, [("a", 10, 5), (None, 0, 60)], ("f", "t"))
    got = iv.overlap_micros(a, b, ["k"], start="s", end="e", right_start="f", right_end="t").collect()
    assert Counter(tuple(r) for r in got) == Counter((tuple(r) + (300_000_000 if i == 4 else 0,)) for i, r in enumerate(a.limit(5).collect()) for _ in range(2))
