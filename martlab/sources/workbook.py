"""Excel workbooks as a Spark source: each task opens whole workbooks and returns their rows.

Two passes: one finds columns and value kinds (one small row per workbook and column), one reads the rows. A folder of
many workbooks is spread over the cluster by file.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import write_table

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or time.
DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(45, 48)])
MAX_COLUMNS = 16_384  # the widest sheet the format allows
SPARK_TYPES = {"int": "bigint", "float": "double", "bool": "boolean", "date": "timestamp_ntz", "text": "string"}


def normalize_name(name: object) -> str:
    """Trimmed, lower case, with `_` for blanks and hyphens."""
    return str(name).strip().replace(" ", "_").replace("-", "_").lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [normalize_name(c) for c in df.columns]
    return df.toDF(*_distinct(names))


def _distinct(names: list[str]) -> list[str]:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"Column names collide after normalisation: {repeated}")
    return names


def sheet_argument(sheet: str | int | None) -> str | int:
    """Sheet by name or index; digits given as text are an index and None is the first sheet."""
    if sheet is None:
        return 0
    return int(sheet) if isinstance(sheet, str) and sheet.isdigit() else sheet


def sheet_rows(content: bytes, sheet: str | int) -> Iterator[list[tuple[str, str] | None]]:
    """Cells of each sheet row as (kind, text), None for an empty cell."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        dates = _date_styles(book)
        with book.open(_sheet_path(book, sheet)) as part:
            for _, element in ElementTree.iterparse(part):
                if element.tag == MAIN + "row":
                    yield _cells(element, shared, dates)
                    element.clear()


def _sheet_path(book: zipfile.ZipFile, sheet: str | int) -> str:
    listed = ElementTree.fromstring(book.read("xl/workbook.xml")).find(MAIN + "sheets")
    sheets = [(s.get("name"), s.get(REL)) for s in listed]
    try:
        rel = sheets[sheet][1] if isinstance(sheet, int) else dict(sheets)[sheet]
    except (IndexError, KeyError):
        raise ValueError(f"Worksheet {sheet!r} not found among {[s[0] for s in sheets]}") from None
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == rel:
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise ValueError(f"Worksheet {sheet!r} has no part in the workbook")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    items = ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(MAIN + "si")
    return [_rich_text(i) for i in items]


def _rich_text(element: ElementTree.Element) -> str:
    direct = element.findall(MAIN + "t") + element.findall(f"{MAIN}r/{MAIN}t")
    return "".join(t.text or "" for t in direct)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode") for f in styles.iter(MAIN + "numFmt")}

    def shows_date(number: int) -> bool:
        if number in DATE_FORMAT_IDS:
            return True
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(number, ""))
        return bool(re.search(r"[ymdhs]", code, re.IGNORECASE))

    formats = styles.find(MAIN + "cellXfs")
    used = [] if formats is None else formats.findall(MAIN + "xf")
    return {i for i, f in enumerate(used) if shows_date(int(f.get("numFmtId", 0)))}


def _cells(row: ElementTree.Element, shared: list[str], dates: set[int]) -> list[tuple[str, str] | None]:
    cells: list[tuple[str, str] | None] = []
    for cell in row.findall(MAIN + "c"):
        place = _column_index(cell.get("r")) if cell.get("r") else len(cells)
        cells.extend([None] * (place - len(cells)))
        cells.append(_value(cell, shared, dates))
    return cells


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group(0):
        index = index * 26 + ord(letter) - 64
    return index - 1


def _value(cell: ElementTree.Element, shared: list[str], dates: set[int]) -> tuple[str, str] | None:
    kind, raw = cell.get("t", "n"), cell.findtext(MAIN + "v")
    if kind == "inlineStr":
        text = _rich_text(cell.find(MAIN + "is"))
        return ("text", text) if text else None
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return ("text", shared[int(raw)]) if shared[int(raw)] else None
    if kind == "b":
        return ("bool", "true" if raw == "1" else "false")
    if kind == "str":
        return ("text", raw) if raw else None
    if kind == "d":
        return ("date", raw.replace("T", " "))
    number = float(raw)
    if int(cell.get("s", 0)) in dates:
        moment = dt.datetime(1899, 12, 30) + dt.timedelta(microseconds=round(number * 86_400_000_000))
        return ("date", moment.isoformat(sep=" "))
    if number.is_integer() and abs(number) < 2**53:
        return ("int", str(int(number)))
    return ("float", repr(number))


def _table(content: bytes, sheet: str | int) -> tuple[list[str], Iterator[list]]:
    """Normalised header (unnamed columns by position) and the rows below it."""
    rows = sheet_rows(content, sheet)
    header = next(rows, [])
    names = [normalize_name(c[1]) if c else f"unnamed:_{i}" for i, c in enumerate(header)]
    return _distinct(names), (r for r in rows if any(r))


def _column_kinds(sheet: str | int):
    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                names, rows = _table(content, sheet)
                kinds = [set() for _ in names]
                for row in rows:
                    for seen, cell in zip(kinds, row):
                        if cell:
                            seen.add(cell[0])
                found = [(i, n, k) for i, (n, seen) in enumerate(zip(names, kinds)) for k in seen or {"none"}]
                yield pd.DataFrame(found, columns=["position", "name", "kind"])

    return scan


def _row_values(sheet: str | int, chunk: int = 10_000):
    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                names, rows = _table(content, sheet)
                out: list[dict] = []
                for number, row in enumerate(rows, start=1):
                    values = {n: c[1] for n, c in zip(names, row) if c}
                    out.append({"source_file": path, "row_number": number, "cells": values})
                    if len(out) == chunk:
                        yield pd.DataFrame(out)
                        out = []
                if out:
                    yield pd.DataFrame(out)

    return scan


def _merged_kind(kinds: set[str]) -> str:
    kinds = kinds - {"none"}
    if not kinds:
        return "float"  # an empty column reads as numbers without values
    if kinds <= {"int", "float"}:
        return "float" if "float" in kinds else "int"
    return next(iter(kinds)) if len(kinds) == 1 else "text"


def read_workbooks(
    spark: SparkSession, path: str, sheet: str | int | None = 0, *, schema: str | None = None, with_source: bool = False
) -> DataFrame:
    """One sheet of every workbook under `path` (a file, folder or glob), see `workbook_rows`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return workbook_rows(files, sheet, schema=schema, with_source=with_source)


def workbook_rows(
    files: DataFrame, sheet: str | int | None = 0, *, schema: str | None = None, with_source: bool = False
) -> DataFrame:
    """Rows of one sheet of every workbook in `files` (path, content), aligned by normalised column name.

    Without `schema`, types come from the cells of all workbooks: whole numbers, numbers, flags, dates, text, or text
    when kinds are mixed. `with_source` adds source_file and row_number.
    """
    sheet = sheet_argument(sheet)
    if schema is None:
        kinds = files.select("content").mapInPandas(_column_kinds(sheet), "position int, name string, kind string")
        # One row per distinct column of the sheet, whatever the number of workbooks.
        columns = kinds.groupBy("name").agg(F.min("position").alias("p"), F.collect_set("kind").alias("k"))
        found = columns.orderBy("p", "name").limit(MAX_COLUMNS + 1).collect()
        if not found:
            raise FileNotFoundError("No workbook with a header found")
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"The workbooks have more than {MAX_COLUMNS} different columns; declare a schema")
        types = {r["name"]: SPARK_TYPES[_merged_kind(set(r["k"]))] for r in found}
    else:
        types = {normalize_name(f.name): f.dataType.simpleString() for f in StructType.fromDDL(schema).fields}
    rows = files.mapInPandas(_row_values(sheet), "source_file string, row_number long, cells map<string,string>")
    values = [F.try_element_at(F.col("cells"), F.lit(n)).cast(t).alias(n) for n, t in types.items()]
    return rows.select(*(["source_file", "row_number"] if with_source else []), *values)


def load_workbooks(spark: SparkSession, path: str, target_table: str, *, sheet: str | int | None = 0,
                   database: str = "raw", if_exists: str = "replace", schema: str | None = None) -> int:
    """Workbooks into a catalog table; returns the number of rows."""
    return write_table(
        read_workbooks(spark, path, sheet, schema=schema), target_table, database=database, if_exists=if_exists
    )
