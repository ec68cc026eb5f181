"""Smallest possible .xlsx writer, for tests of the workbook source."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _cell(value) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.datetime):
        serial = (value - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
        return f'<c s="1"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook_bytes(sheets: dict[str, Sequence[Sequence]]) -> bytes:
    """A workbook with the given sheets; date-times take cell style 1, which shows a date."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{OFFICE}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{NS}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join("<row>" + "".join(map(_cell, row)) + "</row>" for row in rows)
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{NS}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()
