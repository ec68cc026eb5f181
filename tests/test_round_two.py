"""Inputs that ordinary fixtures lack: large doubles, booleans, backslashes, NULL edits, halves, open-ended dates, line breaks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlab.functions.coerce import coerce_columns
from martlab.functions.numbers import decimals_text
from martlab.functions.text import normalize_state
from martlab.operators.changes import apply_changes
from martlab.operators.filter_tree import filter_tree
from martlab.operators.record_filters import apply_column_filters, facet_values, search_records
from martlab.sources.files import read_seed
from martlab.sources.guard import sql_literal
from martlab.sources.tables import export_files, read_table, write_table


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame([(1, 12345678.0, True), (2, 0.5, False), (3, 1e20, None), (4, None, True)], "id int, x double, b boolean")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_text_rules_see_shown_values(mixed):
    assert ids(filter_tree(mixed, {"col": "x", "op": "contains", "value": "12345678.0"})) == [1]
    assert ids(filter_tree(mixed, {"col": "b", "op": "startswith", "value": "T"})) == [1, 4]


def test_value_sets_and_facets_of_doubles_and_booleans(mixed):
    assert ids(apply_column_filters(mixed, {"x": {"mode": "set", "allowed": [12345678.0, None]}})) == [1, 4]
    assert ids(apply_column_filters(mixed, {"b": {"mode": "set", "allowed": [True]}})) == [1, 4]
    assert {r.value for r in facet_values(mixed, {}, "x").collect()} == {"12345678.0", "0.5", "1.0E20", "None"}
    assert {r.value for r in facet_values(mixed, {}, "b").collect()} == {"True", "False", "None"}


@pytest.mark.parametrize("term,hits", [("a\\b", [1]), ("a\\", [1]), ("a_b", [1, 2]), ("%", [1, 2])])
def test_search_takes_backslashes_as_they_are(spark, term, hits):
    df = spark.createDataFrame([(1, "a\\b", "x", 1), (2, "aXb", "y", 2)], "id int, category string, item string, month int")
    assert ids(search_records(df, term)) == hits


def test_null_edit_leaves_the_edit_before_it(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, value double")
    edits = spark.createDataFrame([(1, "value", "5", 1), (1, "value", None, 2)], "id int, field string, new_value string, seq int")
    assert apply_changes(df, edits).first().value == 5.0


def test_halves_round_as_the_binary_value(spark):
    rows = [(0.125, "0.12"), (2.675, "2.67"), (1.005, "1.00"), (-3.456, "-3.46"), (12345678.9, "12345678.90"), (None, None)]
    df = spark.createDataFrame(rows, "x double, want string")
    assert df.where(~decimals_text("x").eqNullSafe(F.col("want"))).count() == 0


def test_open_ended_and_spelled_dates(spark):
    rows = [("9999-12-31", dt.date(9999, 12, 31)), ("1500-01-01", dt.date(1500, 1, 1)), ("31-Dec-2025", dt.date(2025, 12, 31)),
            ("31 December 2025", dt.date(2025, 12, 31)), ("Dec 31 2025", dt.date(2025, 12, 31)), ("12.31.2025", dt.date(2025, 12, 31)),
            ("12/31/2025 10:00:00.250", dt.date(2025, 12, 31)), ("2025-13-01", None)]
    df = coerce_columns(spark.createDataFrame(rows, "d string, want date"), {"d": "date"})
    assert [(r.d, r.want) for r in df.where(~F.col("d").eqNullSafe(F.col("want"))).collect()] == []


def test_snowflake_literal_stays_inside_its_quotes():
    assert sql_literal("\\' OR 1=1 --", "snowflake") == "'\\\\'' OR 1=1 --'"
    assert sql_literal("a\\b'", "postgres") == "'a\\b'''" and sql_literal("a\\b", "sqlserver") == "N'a\\b'"


def test_state_keys_may_hold_backslashes(spark):
    row = spark.createDataFrame([("a\\b",)], "s string").select(normalize_state("s", {"a\\b": "zz"}).alias("x")).first()
    assert row.x == "ZZ"


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    rows = [(1, 'he said "no"\nand, left'), (2, "back\\slash"), (3, 'ends with "')]
    export_files(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "out"), "csv")
    assert sorted(map(tuple, read_seed(spark, str(tmp_path / "out"), "id int, t string").collect())) == rows


def test_replace_leaves_no_table_behind(spark):
    name = "replaced_in_place"
    for n in (3, 2):
        write_table(spark.range(n), name, if_exists="replace")
    assert read_table(spark, name).count() == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    spark.sql(f"DROP TABLE {name}")
