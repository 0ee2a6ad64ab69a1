"""Workbooks in Office Open XML (S9, S20, S21, K5, K6), with the standard library alone.

A workbook is a small report: writing takes rows that the caller has bounded
with a limit; reading takes landed bytes.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.shipping import ship

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
MAX_ROWS = 100_000


def column_name(i: int) -> str:
    """A for 0, Z for 25, AA for 26."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(ref: str, value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    text = escape(_CONTROL.sub("", str(value)))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def workbook_bytes(sheets: dict[str, tuple[Sequence[str], Iterable[Sequence[object]]]]) -> bytes:
    """A workbook of sheets, each a header and rows."""
    out = io.BytesIO()
    names = list(sheets)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        linked = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{linked}</Relationships>')
        for i, name in enumerate(names, 1):
            header, rows = sheets[name]
            lines = [f'<row r="{r}">' + "".join(_cell(f"{column_name(k)}{r}", v) for k, v in enumerate(row)) + "</row>" for r, row in enumerate([header, *rows], 1)]
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0"?><worksheet xmlns="{_MAIN[1:-1]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def sheet_rows(data: bytes, sheet: int = 1) -> list[list[str | None]]:
    """The cells of a sheet as text, gaps as null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for row in root.iter(f"{_MAIN}row"):
        cells: list[str | None] = []
        for c in row.iter(f"{_MAIN}c"):
            letters = re.match("[A-Z]+", c.get("r", "")) or None
            at = len(cells)
            if letters:
                at = 0
                for ch in letters[0]:
                    at = at * 26 + ord(ch) - 64
                at -= 1
            cells += [None] * (at - len(cells))
            v = c.find(f"{_MAIN}v")
            if c.get("t") == "inlineStr":
                cells.append("".join(t.text or "" for t in c.iter(f"{_MAIN}t")))
            elif v is None:
                cells.append(None)
            else:
                cells.append(shared[int(v.text)] if c.get("t") == "s" else v.text)
        out.append(cells)
    return out


def read_workbooks(spark: SparkSession, path: str, required: Sequence[str], search: int = 30) -> DataFrame:
    """path and cells (a map from header to text) of each data row of the workbooks below path.

    The header is the first of the first rows that has all required names.
    """
    ship(spark)
    wanted = {r.strip().lower() for r in required}

    @F.pandas_udf("array<map<string,string>>")
    def rows(contents: pd.Series) -> pd.Series:
        out = []
        for data in contents:
            cells = sheet_rows(bytes(data))
            at = next((i for i, r in enumerate(cells[:search]) if wanted <= {(c or "").strip().lower() for c in r}), None)
            if at is None:
                out.append([])
                continue
            names = [(c or "").strip() for c in cells[at]]
            out.append([{n: v for n, v in zip(names, r, strict=False) if n} for r in cells[at + 1 :]])
        return pd.Series(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", F.explode(rows("content")).alias("cells"))


def report(sheets: dict[str, DataFrame], max_rows: int = MAX_ROWS) -> bytes:
    """K5, K6: a workbook of frames; one of more than max_rows rows is an error, as a report is read by people."""
    out = {}
    for name, df in sheets.items():
        rows = df.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"{name} has more than {max_rows} rows")
        out[name] = (df.columns, [tuple(r) for r in rows])
    return workbook_bytes(out)
