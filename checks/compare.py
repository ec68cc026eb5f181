"""Compare every query with its oracle on one folder: python -m checks.compare [folder] [names...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from martlab.session import build_session

from .oracles import ORACLES
from .queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return repr(value) if isinstance(value, float) else str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_text(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> tuple[str, float]:
    """Empty text when rows and columns agree, otherwise what differs; and the seconds Spark took."""
    began = time.time()
    df = QUERIES[name](spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    if name not in ORACLES:
        return f"no oracle, {len(got)} rows", took
    answer = con.execute(ORACLES[name])
    want_columns, want = rows_of([d[0] for d in answer.description], answer.fetchall())
    if got_columns != want_columns:
        return f"columns {sorted(set(got_columns) ^ set(want_columns))}", took
    if got != want:
        extra, lacking = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows against {len(want)}\n  only Spark  {extra}\n  only oracle {lacking}", took
    return "" if got else "agrees, but has no rows", took


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, wrong = oracle_connection(folder), 0
    for name in sys.argv[2:] or QUERIES:
        try:
            problem, took = compare(spark, con, folder, name)
        except Exception as error:
            problem, took = f"{type(error).__name__}: {str(error)[:600]}", 0.0
        wrong += bool(problem)
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {took:.2f}s {problem}", flush=True)
    print(f"{wrong} of {len(sys.argv[2:] or QUERIES)} differ; without query: {sorted(set(ORACLES) - set(QUERIES))}")


if __name__ == "__main__":
    main()
