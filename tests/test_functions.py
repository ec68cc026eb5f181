import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlab.functions import calendar, coerce, dates, numbers, terms, text
from martlab.functions.sqlfuncs import register_sql_functions

from .conftest import rows

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def day(value):
    return F.lit(value).cast("date")


@pytest.mark.parametrize("a, b, expected", [
    ("2025-12-31", "2026-01-01", 1), ("2025-12-01", "2025-12-31", 0), ("2025-12-31", "2025-11-30", -1), (None, "2025-01-01", None),
])
def test_month_boundaries(spark, a, b, expected):
    assert one(spark, dates.month_diff(day(a), day(b))) == expected


@pytest.mark.parametrize("seconds, expected", [
    (0.0, "00:00:00"), (59.5, "00:01:00"), (360062.0, "100:01:02"), (-3661.0, "-1:-1:-1"), (None, None),
])
def test_clock_text(spark, seconds, expected):
    assert one(spark, dates.hhmmss(F.lit(seconds).cast("double"))) == expected
    register_sql_functions(spark)
    assert one(spark, F.call_function("hhmmss", F.lit(seconds).cast("double"))) == expected


def test_time_of_day_and_staleness(spark):
    clock = F.lit("1899-12-30 08:15:30.9").cast("timestamp_ntz")
    assert one(spark, dates.at_time_of_day(day("2026-04-16"), clock)) == dt.datetime(2026, 4, 16, 8, 15, 30)
    assert one(spark, dates.is_stale(day("2023-12-30"), day("2025-12-31"))) is True
    assert one(spark, dates.is_stale(day("2023-12-31"), day("2025-12-31"))) is False
    assert one(spark, dates.is_stale(day(None), day("2025-12-31"))) is False
    assert one(spark, dates.hours_between(F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"),
                                          F.lit("2026-01-01 00:15:00").cast("timestamp_ntz"))) == 0.25


TERM_ROWS = [
    # maturity, origination, amortization, io end -> raw, floored, matured, elapsed, amortization left, io left, io expired
    (("2026-03-15", "2021-03-15", 300, None), (3, 3, False, 57, 243, None, False)),
    (("2025-09-01", "2020-09-01", 240, None), (-3, 0, True, 63, 177, None, False)),
    (("2025-12-31", "2025-12-01", 12, "2025-12-31"), (0, 0, True, 0, 12, 0, True)),
    (("2027-06-01", "2022-06-01", 360, "2026-06-01"), (18, 18, False, 42, 360, 6, False)),
    (("2027-06-01", "2012-06-01", 360, "2014-06-01"), (18, 18, False, 162, 222, 0, True)),
    ((None, "2012-06-01", None, None), (None, 0, False, 162, None, None, False)),
    (("2030-01-01", "2000-01-01", 12, None), (49, 49, False, 311, 0, None, False)),
]


@pytest.mark.parametrize("given, expected", TERM_ROWS)
def test_remaining_terms(spark, given, expected):
    df = spark.createDataFrame([given], "m string, o string, a int, io string").select(
        *[F.col(c).cast("date").alias(c) for c in ("m", "o", "io")], "a"
    )
    columns = terms.remaining_terms("2025-12-31", "m", "o", "a", "io")
    assert tuple(df.select(*[c.alias(n) for n, c in columns.items()]).first()) == expected


def test_effective_origination(spark):
    df = spark.createDataFrame([(True, D(2024, 1, 1)), (True, None), (False, D(2024, 1, 1)), (None, D(2024, 1, 1))], "arc boolean, c date")
    got = df.select(terms.effective_origination("arc", "c", F.lit("2020-01-01").cast("date")).alias("x")).collect()
    assert [r["x"].year for r in got] == [2024, 2020, 2020, 2020]


ADDRESSES = {
    # street: (null, box, number, valid) in basic, then in extended
    None: ((True, False, False, False), (True, False, False, False)),
    "   ": ((True, False, False, False), (True, False, False, False)),
    "PO BOX 12": ((False, True, False, False), (False, True, False, False)),
    "  po box 12": ((False, False, False, False), (False, True, False, False)),
    "Post Office Box 9": ((False, False, False, False), (False, True, False, False)),
    "p.o. 7": ((False, True, False, False), (False, True, False, False)),
    "123 Main St": ((False, False, True, True), (False, False, True, True)),
    "123 MAIN ST": ((False, False, True, False), (False, False, True, False)),
    "12a Oak Ave. Suite 4": ((False, False, True, True), (False, False, True, True)),
    "12 King's Rd": ((False, False, True, False), (False, False, True, True)),
    "12 Long Cove": ((False, False, True, False), (False, False, True, True)),
    "12Main": ((False, False, True, False), (False, False, False, False)),
    "7 Elm": ((False, False, True, False), (False, False, True, False)),
}


@pytest.mark.parametrize("street", list(ADDRESSES))
def test_address_flags(spark, street):
    df = spark.createDataFrame([(street, "33601")], "s string, z string")
    for profile, expected in zip(("basic", "extended"), ADDRESSES[street]):
        flags = text.address_flags("s", "z", profile=profile)
        assert tuple(df.select(*[c.alias(n) for n, c in flags.items()]).first()) == (*expected, True), profile


def test_address_options(spark):
    df = spark.createDataFrame([("123 MAIN ST", " 33601-1234 ", "pr"), ("1 abc", "3360", "XX"), (None, None, None)], "s string, z string, st string")
    folded = df.select(text.address_flags("s", "z", ignore_case=True)["is_valid_street_address"].alias("x")).collect()
    assert [r["x"] for r in folded] == [True, False, False]
    loose = text.address_flags("s", "z", profile="loose", state="st")
    got = df.select(*[loose[c].alias(c) for c in ("is_valid_street_address", "is_valid_zip", "is_valid_state")]).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (True, False, False), (False, False, False)]
    with pytest.raises(ValueError):
        text.address_flags("s", "z", profile="other")


def test_states(spark):
    df = spark.createDataFrame([(v,) for v in ["FL", " fl ", "Florida", "NEW york", "XX", "", "  ", None]], "s string")
    assert [r[0] for r in df.select(text.normalize_state("s")).collect()] == ["FL", "FL", "FL", "NY", None, None, None, None]
    assert len(text.US_STATES) == 56
    own = text.normalize_state("s", {"Xanadu": "xx"})
    assert [r[0] for r in df.select(own).collect()].count("XX") == 1


@pytest.mark.parametrize("share, n, expected", [
    (None, 0, numbers.SIGNAL_NONE), (0.0, 5, numbers.SIGNAL_NONE), (49.99, 5, numbers.SIGNAL_WEAK), (50.0, 5, numbers.SIGNAL_MEDIUM),
    (90.0, 5, numbers.SIGNAL_HIGH), (100.0, 5, numbers.SIGNAL_STRONG), (100.0, 0, numbers.SIGNAL_HIGH),
])
def test_signal(spark, share, n, expected):
    assert one(spark, numbers.signal_strength(F.lit(share).cast("double"), F.lit(n))) == expected


def test_ratios(spark):
    assert one(spark, numbers.pct(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, numbers.pct(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.number_from_text(F.lit(" 1,234.5 "), strip_commas=True)) == 1234.5
    assert one(spark, numbers.number_from_text(F.lit("1d"))) is None


# --- coercion ---


def coerced(spark, value, target, kind="string", **how):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return coerce.coerce_columns(df, {"v": target}, **how).first()["v"]


@pytest.mark.parametrize("value, kind, expected", [
    ("47521", "string", D(2030, 2, 7)), ("47521.5", "string", D(2030, 2, 7)), (47521, "int", D(2030, 2, 7)), (47521.9, "double", D(2030, 2, 7)),
    ("0", "string", None), ("1", "string", D(1899, 12, 31)), ("80000", "string", D(2119, 1, 11)), ("80001", "string", None),
    (" ", "string", None), (None, "string", None), (float("nan"), "double", None), ("junk", "string", None),
    ("2025-03-31", "string", D(2025, 3, 31)), ("2025-03-31 10:00:00", "string", D(2025, 3, 31)), ("3/31/2025", "string", D(2025, 3, 31)),
    ("20250331", "string", D(2025, 3, 31)), ("Mar 31, 2025", "string", D(2025, 3, 31)), (D(2025, 1, 2), "date", D(2025, 1, 2)),
])
def test_dates(spark, value, kind, expected):
    assert coerced(spark, value, "date", kind) == expected


def test_timestamps(spark):
    assert coerced(spark, "47521.5", "datetime") == dt.datetime(2030, 2, 7, 12)
    assert coerced(spark, "3/31/2025 4:05 PM", "timestamp") == dt.datetime(2025, 3, 31, 16, 5)
    assert coerced(spark, "March 3, 2025", "timestamp") == dt.datetime(2025, 3, 3)
    assert coerced(spark, "2025/3/31 4:05", "timestamp") == dt.datetime(2025, 3, 31, 4, 5)
    assert coerced(spark, "13/31/2025", "timestamp") is None
    for text, want in {
        "12/31/25": dt.datetime(2025, 12, 31), "1/2/70": dt.datetime(1970, 1, 2), "1-2-68": dt.datetime(2068, 1, 2), "31-Dec-25": dt.datetime(2025, 12, 31),
        "31 DEC 25": dt.datetime(2025, 12, 31), "Sept 5, 2025": dt.datetime(2025, 9, 5), "Sept. 5 2025": dt.datetime(2025, 9, 5),
        "Dec 31, 2025 10:00": dt.datetime(2025, 12, 31, 10), "5 September 2025 11:05:06 pm": dt.datetime(2025, 9, 5, 23, 5, 6),
        "12/31/25 12:30 AM": dt.datetime(2025, 12, 31, 0, 30), "3/1/2025 4:05:06.25": dt.datetime(2025, 3, 1, 4, 5, 6, 250000),
        "3/1/2025 13:00 PM": None, "3/1/2025 24:00": None, "3/1/2025 4:60": None, "2/30/2025": None, "Marching 5, 2025": None, "May": None,
        "5/5": None, "12/31/25x": None,
    }.items():
        assert coerced(spark, text, "timestamp") == want, text
    assert coerced(spark, "2025-03-31T04:05:06.5", "datetime64") == dt.datetime(2025, 3, 31, 4, 5, 6, 500000)


@pytest.mark.parametrize("serial, expected", [
    ("45000.5", "2023-03-15 16:00:00"),  # summer time
    (45361.1041666667, None),  # 2024-03-10 02:30 does not exist
    (45599.0625, None),  # 2024-11-03 01:30 happens twice
])
def test_serial_with_time_zone(spark, serial, expected):
    stamp = coerce.serial_to_timestamp(F.lit(serial), tz="America/New_York")
    assert one(spark, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")) == expected


def test_numbers_and_flags(spark):
    assert coerced(spark, " 12 ", int) == 12
    assert coerced(spark, "9007199254740993", "int") == 9007199254740993
    assert coerced(spark, "x", "Int64") is None
    assert coerced(spark, "1.5", "int", fractional="null") is None
    with pytest.raises(Exception, match="fractional"):
        coerced(spark, "1.5", "int")
    assert coerced(spark, "1e3", float) == 1000.0
    assert coerced(spark, "1f", "float") is None
    assert [coerced(spark, v, bool) for v in (" YES ", "t", "0", "off", None)] == [True, True, False, None, None]
    assert coerced(spark, 1, "bool", "int") is True
    assert coerced(spark, 5, str, "int") == "5"
    assert coerced(spark, 5, "decimal(9,2)", "int") == 5
    with pytest.raises(TypeError):
        coerced(spark, 5, "no such type", "int")


def test_missing_columns(spark):
    df = spark.range(1)
    assert coerce.coerce_columns(df, {"nope": "int"}) is df
    with pytest.raises(KeyError):
        coerce.coerce_columns(df, {"nope": "int"}, on_missing="raise")


# --- calendar ---

# The observed federal holidays of two years.
GOLDEN_HOLIDAYS = """
2026-01-01 New Year's Day
2026-01-19 MLK Jr. Day
2026-02-16 Washington's Birthday
2026-05-25 Memorial Day
2026-06-19 Juneteenth
2026-07-03 Independence Day (Observed)
2026-09-07 Labor Day
2026-10-12 Columbus Day
2026-11-11 Veterans Day
2026-11-26 Thanksgiving
2026-12-25 Christmas Day
2027-01-01 New Year's Day
2027-01-18 MLK Jr. Day
2027-02-15 Washington's Birthday
2027-05-31 Memorial Day
2027-06-18 Juneteenth (Observed)
2027-07-05 Independence Day (Observed)
2027-09-06 Labor Day
2027-10-11 Columbus Day
2027-11-11 Veterans Day
2027-11-25 Thanksgiving
2027-12-24 Christmas Day (Observed)
"""


def test_holidays(spark):
    years = spark.createDataFrame([(2026,), (2027,), (2026,), (None,)], "Year int")
    got = {(str(r["Date"]), r["Holiday"]) for r in calendar.federal_holidays(years).collect()}
    assert got == {tuple(line.split(" ", 1)) for line in GOLDEN_HOLIDAYS.strip().splitlines()}


def test_weekdays(spark):
    df = spark.createDataFrame([(D(2026, 7, 3),), (D(2026, 7, 4),), (D(2026, 7, 5),), (D(2026, 7, 6),)], "d date")
    got = df.select(*[c.alias(n) for n, c in calendar.calendar_flags("d").items()])
    assert rows(got) == sorted([
        ("Friday", True, False, False), ("Saturday", True, False, True), ("Sunday", False, False, False), ("Monday", True, True, False),
    ], key=repr)
