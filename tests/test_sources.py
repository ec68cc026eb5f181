import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from checks.workbooks import workbook_bytes
from martlab.session import shared_folder
from martlab.sources import files, guard, jdbc, tables, workbook

from .conftest import rows


@pytest.mark.parametrize("query, dialect, ok", [
    (" SELECT 1 ; ", "postgres", "SELECT 1"),
    ("with a as (select 1) select * from a", "postgres", "with a as (select 1) select * from a"),
    ("", "postgres", None), ("   ", "sqlserver", None), ("SELECT 1; SELECT 2", "postgres", None), ("DELETE FROM t", "postgres", None),
    ("select 'drop' from t", "postgres", None),  # words inside literals are refused too
    ("select comment from t", "postgres", None), ("select comment from t", "sqlserver", "select comment from t"),
    ("select 1 /* exec */", "sqlserver", None), ("select updated_at from t", "postgres", "select updated_at from t"),
    ("with a as (select 1) select 1", "snowflake", None), ("select 1", "snowflake", "select 1"),
    ("select 1; drop table x", "snowflake", None), ("select ';', \"a;b\" from t;", "snowflake", "select ';', \"a;b\" from t"),
])
def test_select_guard(query, dialect, ok):
    if ok is None:
        with pytest.raises(guard.RefusedQuery):
            guard.check_select(query, dialect)
    else:
        assert guard.check_select(query, dialect) == ok


def test_parameters():
    bound = guard.bind_parameters(
        "select * from t where a = :a and b >= :day and c in :list and d = ':a' and e::text = :e and f = :f",
        {"a": "O'Hara", "day": dt.date(2026, 1, 1), "list": [1, 2.5, None], "e": dt.datetime(2026, 1, 1, 2), "f": True},
    )
    assert bound == ("select * from t where a = 'O''Hara' and b >= DATE '2026-01-01' and c in (1, 2.5, NULL) and d = ':a' and "
                     "e::text = TIMESTAMP '2026-01-01 02:00:00' and f = TRUE")
    with pytest.raises(ValueError):
        guard.bind_parameters("select :a", {})
    with pytest.raises(ValueError):
        guard.bind_parameters("select 1", {"a": 1})
    with pytest.raises(TypeError):
        guard.bind_parameters("select :a", {"a": object()})


def test_reader_options():
    source = jdbc.Source("postgres", "jdbc:postgresql://host/db", {"user": "u", "password": "secret"})
    assert "secret" not in repr(source)
    kind, options = jdbc.reader_options(source, "select id from t where d > :d;", {"d": 5}, chunk_size=500)
    assert kind == "jdbc" and options["query"] == "select id from t where d > 5" and options["fetchsize"] == "500"
    _, options = jdbc.reader_options(source, "select id from t", split=jdbc.Split("id", 1, 10**9, 400))
    assert options["dbtable"] == "(select id from t) AS pushed_query" and options["numPartitions"] == "400" and "query" not in options
    with pytest.raises(ValueError):
        jdbc.reader_options(source, "select 1", chunk_size=0)
    with pytest.raises(ValueError, match="sfURL"):
        jdbc.reader_options(jdbc.Source("snowflake"), "select 1")
    full = jdbc.Source("snowflake", options={k: "x" for k in jdbc.SNOWFLAKE_REQUIRED})
    assert jdbc.reader_options(full, "select 1")[0] == "snowflake"


def test_sql_server_dialect():
    source = jdbc.Source("sqlserver", "jdbc:sqlserver://host")
    query = "WITH a AS (SELECT '(' AS x FROM t WHERE d >= :d), b AS (SELECT * FROM a) SELECT * FROM b WHERE n = :n AND k = :k"
    _, options = jdbc.reader_options(source, query, {"d": dt.date(2026, 1, 1), "n": "x", "k": True})
    assert options["prepareQuery"] == "WITH a AS (SELECT '(' AS x FROM t WHERE d >= CAST('2026-01-01' AS DATE)), b AS (SELECT * FROM a)"
    assert options["query"] == "SELECT * FROM b WHERE n = N'x' AND k = 1"
    assert "prepareQuery" not in jdbc.reader_options(source, "select 1")[1]
    with pytest.raises(guard.RefusedQuery):
        guard.split_with("with a as (select 1)")


def test_arguments_are_checked_before_connecting(spark):
    source = jdbc.Source("sqlserver", "jdbc:sqlserver://nowhere")
    with pytest.raises(ValueError, match="if_exists"):
        jdbc.load_query(spark, source, "select 1", "t", if_exists="other")
    with pytest.raises(ValueError, match="identifier"):
        jdbc.load_query(spark, source, "select 1", "1t")
    with pytest.raises(guard.RefusedQuery):
        jdbc.load_query(spark, source, "exec x", "t")


def test_catalog_query(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert jdbc.read_catalog_query(spark, "select id from ten where id >= :low;", {"low": 7}).count() == 3


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def ids(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


def test_write_modes(spark, database):
    name = f"{database}.t"
    two, empty = spark.range(2), spark.range(0)
    assert tables.write_table(two, name, if_exists="append") == 2  # created when absent
    assert tables.write_table(two, name, if_exists="append") == 2
    assert ids(spark, name) == [0, 0, 1, 1]
    with pytest.raises(ValueError, match="already exists"):
        tables.write_table(two, name.upper(), if_exists="fail")
    assert tables.write_table(empty, name, if_exists="append") == 0
    assert tables.write_table(spark.range(3), name, if_exists="replace") == 3
    assert ids(spark, name) == [0, 1, 2]
    assert tables.write_table(empty, name, if_exists="replace") == 0
    assert ids(spark, name) == [] and spark.table(name).columns == ["id"]
    assert tables.write_table(two, "fresh", database=database, if_exists="fail") == 2
    with pytest.raises(ValueError):
        tables.write_table(two, name, if_exists="other")
    with pytest.raises(ValueError):
        tables.write_table(two, "a-b")


def test_append_by_position_and_by_name(spark, database):
    name = f"{database}.pair"
    tables.write_table(spark.sql("SELECT 1 AS a, 2 AS b"), name)
    tables.write_table(spark.sql("SELECT 3 AS b, 4 AS a"), name, if_exists="append")
    tables.write_table(spark.sql("SELECT 5 AS b, 6 AS a"), name, if_exists="append", by_name=True)
    assert rows(spark.table(name)) == [(1, 2), (3, 4), (6, 5)]
    with pytest.raises(ValueError):
        tables.write_table(spark.sql("SELECT 1 AS a"), name, if_exists="append")


def test_failed_replace_keeps_the_old_table(spark, database):
    name = f"{database}.kept"
    tables.write_table(spark.range(2), name)
    with pytest.raises(Exception):
        tables.write_table(spark.range(2).select((F.lit(1) / F.col("id")).alias("id")), name)
    assert ids(spark, name) == [0, 1]
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["kept"]


def test_materialize_and_export(spark, database):
    tables.materialize(spark.range(3), "as_view")
    assert spark.table("as_view").count() == 3
    assert tables.materialize(spark.range(3), "as_table", "table", database).count() == 3
    written = tables.write_table(spark.range(4).withColumn("d", F.col("id") % 2), "cut", database=database, partition_by=("d",), bucket_by=(2, "id"))
    assert written == 4
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    tables.export_files(spark.sql("SELECT '007' AS zip, 1.5D AS v"), folder, "csv")
    assert rows(files.read_seed(spark, folder, "zip string, v double")) == [("007", 1.5)]
    with pytest.raises(Exception):
        files.read_seed(spark, folder, "other string, v double").collect()
    with pytest.raises(Exception):
        tables.export_files(spark.range(1), folder)


# --- workbooks ---

HEAD = ["Loan-ID", " Open Date", "Rate", "Active", None, "Note"]


def save(folder, name, *rows, extra=None):
    path = folder / name
    path.write_bytes(workbook_bytes({"First": [HEAD, *rows], "Second": extra or [["x"], [1]]}))
    return str(path)


def test_workbooks(spark, tmp_path):
    when = dt.datetime(2025, 3, 31, 12, 30)
    save(tmp_path, "a.xlsx", [1, when, 5, True, None, "a < b"], [], [2, None, 5.25, False, None, None])
    save(tmp_path, "b.xlsx", [3, when, 7, None, None, 8])
    df = workbook.read_workbooks(spark, str(tmp_path))
    assert [t for _, t in df.dtypes] == ["bigint", "timestamp_ntz", "double", "boolean", "double", "string"]
    assert df.columns == ["loan_id", "open_date", "rate", "active", "unnamed:_4", "note"]
    assert rows(df) == [(1, when, 5.0, True, None, "a < b"), (2, None, 5.25, False, None, None), (3, when, 7.0, None, None, "8")]
    by_name = workbook.read_workbooks(spark, str(tmp_path / "a.xlsx"), "Second", with_source=True).first()
    assert by_name["x"] == 1 and by_name["row_number"] == 1 and by_name["source_file"].endswith("a.xlsx")
    assert workbook.read_workbooks(spark, str(tmp_path), "1").count() == 2
    declared = workbook.read_workbooks(spark, str(tmp_path), schema="`Loan-ID` string, other int")
    assert rows(declared)[0] == ("1", None)
    with pytest.raises(Exception, match="Worksheet"):
        workbook.read_workbooks(spark, str(tmp_path), "Third").collect()


def test_workbook_load(spark, tmp_path, database):
    save(tmp_path, "a.xlsx", [1, None, 5, True, None, "n"])
    assert workbook.load_workbooks(spark, str(tmp_path), "book", sheet=1, database=database) == 1
    assert rows(spark.table(f"{database}.book")) == [(1,)]


def test_names(spark):
    assert workbook.normalize_name("  Total Amount-USD ") == "total_amount_usd"
    assert workbook.normalize_columns(spark.sql("SELECT 1 AS `A b`, 2 AS `C-d`")).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        workbook.normalize_columns(spark.sql("SELECT 1 AS `A b`, 2 AS `a-B`"))
    assert [workbook.sheet_argument(s) for s in ("2", "Main", 1, None)] == [2, "Main", 1, 0]
