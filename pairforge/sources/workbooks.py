"""Workbooks (Office Open XML) without a library: each is a zip of small XML files.

Reading is distributed: files come in as rows of Spark's binary source, and each is taken apart where it
lies; a broken file gives no rows.  Writing is for views that a person opens: their rows are counted
first and must be few.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers may have no copy of this package

#: Most rows of a written view: more than a person reads, less than a sheet can hold.
MOST_ROWS = 100_000
#: How a decision's cell is filled, and the name spaces of the format.
FILLS = {"High Fit": "FFC6EFCE", "Good Fit": "FFE2F0D9", "Partner Fit": "FFDDEBF7", "Review Needed": "FFFFEB9C", "Low Fit": "FFF8CBAD"}
_MAIN, _REL, _PKG = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"


def _column(ref: str) -> int:
    """The 0-based column of a cell reference such as AB12."""
    n = 0
    for c in re.match("[A-Z]*", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _letters(k: int) -> str:
    out, k = "", k + 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def sheets(content: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """(name, rows of texts) of each sheet; empty cells are empty texts."""
    q = f"{{{_MAIN}}}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        text = lambda e: "".join(t.text or "" for t in e.iter(f"{q}t"))
        shared = [text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{q}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{q}sheet"):
            target = targets[s.get(f"{{{_REL}}}id")].lstrip("/")
            rows: list[list[str]] = []
            for row in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{q}row"):
                cells: list[str] = []
                for i, c in enumerate(row.iter(f"{q}c")):
                    at = _column(c.get("r")) if c.get("r") else i
                    v = c.find(f"{q}v")
                    kind = c.get("t")
                    value = text(c) if kind == "inlineStr" else "" if v is None else shared[int(v.text)] if kind == "s" else v.text or ""
                    cells += [""] * (at + 1 - len(cells))
                    cells[at] = value
                rows.append(cells)
            yield s.get("name"), rows


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row, cells): every row below the header of every sheet of a tree of workbooks, as texts by
    header; files that are no workbooks give nothing."""

    def scan(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in files:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    found = list(sheets(content))
                except (zipfile.BadZipFile, KeyError, ET.ParseError, ValueError, IndexError):
                    continue
                for sheet, rows in found:
                    head = rows[0] if rows else []
                    data = [(name, sheet, k, dict(zip(head, r, strict=False))) for k, r in enumerate(rows[1:], 1)]
                    if data:
                        yield pd.DataFrame(data, columns=["path", "sheet", "row", "cells"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(scan, "path string, sheet string, row long, cells map<string,string>")


def sheet_table(rows: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """One sheet of :func:`read_workbooks` as a table of texts."""
    return rows.filter(F.col("sheet") == sheet).select(*[F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")).alias(c) for c in columns])


def _sheet_xml(columns: list[str], rows: list[tuple], decision: str | None, styles: dict[str, int]) -> str:
    def cell(k: int, r: int, value: object, style: int) -> str:
        ref = f'r="{_letters(k)}{r}" s="{style}"'
        if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value:
            return f"<c {ref}><v>{value}</v></c>"
        text = "" if value is None else re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "", str(value))
        return f'<c {ref} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    widths = [min(60, max(12, *(len(str(r[k] or "")) + 2 for r in rows[:200]), len(c) + 2)) for k, c in enumerate(columns)] if rows else [max(12, len(c) + 2) for c in columns]
    cols = "".join(f'<col min="{k + 1}" max="{k + 1}" width="{w}" customWidth="1"/>' for k, w in enumerate(widths))
    at = columns.index(decision) if decision in columns else -1
    body = [f'<row r="1">{"".join(cell(k, 1, c, 1) for k, c in enumerate(columns))}</row>']
    body += [f'<row r="{i}">{"".join(cell(k, i, v, styles.get(str(v), 2) if k == at else 2) for k, v in enumerate(r))}</row>' for i, r in enumerate(rows, 2)]
    pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}">{pane}<cols>{cols}</cols><sheetData>{"".join(body)}</sheetData></worksheet>'


def workbook(views: dict[str, tuple[list[str], list[tuple]]], decision: str | None = None) -> bytes:
    """A workbook of (columns, rows) by sheet name: bold filled headers that stay in view, wrapped cells,
    column widths by content, and decisions in their colours."""
    fills = ['<fill><patternFill patternType="none"/></fill>', '<fill><patternFill patternType="gray125"/></fill>', *[f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in ("FF1F4E78", *FILLS.values())]]
    wrap = '<alignment vertical="top" wrapText="1"/>'
    formats = ['<xf/>', f'<xf fontId="1" fillId="2" applyFont="1" applyFill="1" applyAlignment="1">{wrap}</xf>', f'<xf applyAlignment="1">{wrap}</xf>', *[f'<xf fillId="{3 + k}" applyFill="1" applyAlignment="1">{wrap}</xf>' for k in range(len(FILLS))]]
    styles = f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts><fills count="{len(fills)}">{"".join(fills)}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(formats)}">{"".join(formats)}</cellXfs></styleSheet>'
    by_decision = {d: 3 + k for k, d in enumerate(FILLS)}
    n = len(views)
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, n + 1))
    parts = {
        "[Content_Types].xml": f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>',
        "_rels/.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{"".join(f"<sheet name={quoteattr(s[:31])} sheetId={quoteattr(str(k))} r:id={quoteattr(f"rId{k}")}/>" for k, s in enumerate(views, 1))}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG}/relationships">{"".join(f"<Relationship Id={quoteattr(f"rId{k}")} Type={quoteattr(_REL + "/worksheet")} Target={quoteattr(f"worksheets/sheet{k}.xml")}/>" for k in range(1, n + 1))}<Relationship Id="rId{n + 1}" Type="{_REL}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": styles,
    }
    parts |= {f"xl/worksheets/sheet{k}.xml": _sheet_xml(columns, rows, decision, by_decision) for k, (columns, rows) in enumerate(views.values(), 1)}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def write_workbook(views: dict[str, DataFrame], path: str, decision: str | None = None, most: int = MOST_ROWS) -> None:
    """Views as one formatted workbook, written through Spark's file systems.  A view of more than ``most``
    rows is refused: it belongs in a table (:func:`pairforge.sources.stages.write_views`)."""
    held = {}
    for name, df in views.items():
        rows = [tuple(r) for r in df.limit(most + 1).collect()]
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows; write it as a table")
        held[name] = (df.columns, rows)
    spark = next(iter(views.values())).sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(workbook(held, decision)))
    finally:
        out.close()
