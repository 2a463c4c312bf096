"""Spreadsheet workbooks (xlsx), read with the standard library inside tasks, one workbook per file split."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.functions.dates import try_timestamp
from itinera.functions.text import null_tokens

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_EPOCH = dt.datetime(1899, 12, 30)
_ROWS_PER_BATCH = 5000
#: Distinct headers beyond which a table would be a mistake; the reader then asks for names instead of dropping any.
MOST_HEADERS = 5000
SCHEMA = "source_file string, source_sheet string, row_no int, cells map<string,string>"


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group(0):
        n = n * 26 + ord(ch) - 64
    return n - 1


def _texts(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in root.iter(f"{_MAIN}si")]


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{_MAIN}numFmt")
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    cells = root.find(f"{_MAIN}cellXfs")
    formats = [] if cells is None else [int(x.get("numFmtId", 0)) for x in cells]
    return {i for i, f in enumerate(formats) if f in _DATE_FORMATS or f in custom}


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels}
    book = ET.fromstring(z.read("xl/workbook.xml"))
    out = []
    for s in book.iter(f"{_MAIN}sheet"):
        path = target[s.get(f"{_REL}id")].lstrip("/")
        out.append((s.get("name"), path if path.startswith("xl/") else f"xl/{path}"))
    return out


def _cell(c: ET.Element, texts: list[str], dates: set[int]) -> str | None:
    kind, v = c.get("t"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    if v is None or v.text is None or kind == "e":
        return None
    if kind == "s":
        return texts[int(v.text)]
    if kind == "b":
        return "True" if v.text == "1" else "False"
    if kind is None or kind == "n":
        if int(c.get("s", 0)) in dates:
            stamp = _EPOCH + dt.timedelta(seconds=round(float(v.text) * 86400))
            return stamp.strftime("%Y-%m-%d %H:%M:%S")
        return re.sub(r"\.0$", "", v.text)
    return v.text


def sheet_rows(content: bytes) -> Iterator[tuple[str, int, dict[str, str | None]]]:
    """(sheet, row number, cells by header) of every non-empty row, streamed sheet by sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        texts, dates = _texts(z), _date_styles(z)
        for name, path in _sheets(z):
            header: list[str] | None = None
            number = 0
            with z.open(path) as part:
                above: list[ET.Element] = []  # open elements around the rows; they forget each row once it is read
                for event, row in ET.iterparse(part, events=("start", "end")):
                    if event == "start":
                        above.append(row)
                        continue
                    above.pop()
                    if row.tag != f"{_MAIN}row":
                        continue
                    values: dict[int, str | None] = {}
                    for at, c in enumerate(row.iter(f"{_MAIN}c")):
                        values[_column_index(c.get("r")) if c.get("r") else at] = _cell(c, texts, dates)
                    if above:
                        above[-1].remove(row)
                    if not any(v not in (None, "") for v in values.values()):
                        continue
                    if header is None:
                        header = [(values.get(i) or "").strip() or f"col_{i}" for i in range(max(values) + 1)]
                        continue
                    number += 1
                    yield name, number, {h: values.get(i) for i, h in enumerate(header)}


def read_workbook_cells(spark: SparkSession, path: str) -> DataFrame:
    """Every sheet row of every workbook as a map from header to cell text."""
    return workbook_cells(spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("name"), "content"))


def workbook_cells(files: DataFrame) -> DataFrame:
    """The same for workbooks that are rows (name, content) of a table."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source_file", "source_sheet", "row_no", "cells"]
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                out = []
                for sheet, number, cells in sheet_rows(content):
                    out.append((name, sheet, number, cells))
                    if len(out) == _ROWS_PER_BATCH:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                yield pd.DataFrame(out, columns=columns)

    return files.select("name", "content").mapInPandas(parse, SCHEMA)


def read_workbooks(
    spark: SparkSession, path: str, null_columns: Sequence[str] = (), date_columns: Sequence[str] = (),
    headers: Sequence[str] | None = None,
) -> DataFrame:
    """All sheets of all workbooks as one text table over the union of their headers.

    Empty sheets and rows vanish. ``null_columns`` turn null tokens into nulls, ``date_columns`` become timestamps.
    ``headers`` saves the pass that finds the distinct header names (as many as there are columns).
    """
    return _as_table(read_workbook_cells(spark, path), null_columns, date_columns, headers)


def workbook_table(
    files: DataFrame, null_columns: Sequence[str] = (), date_columns: Sequence[str] = (), headers: Sequence[str] | None = None
) -> DataFrame:
    """:func:`read_workbooks` for workbooks that are rows (name, content) of a table."""
    return _as_table(workbook_cells(files), null_columns, date_columns, headers)


def _as_table(cells: DataFrame, null_columns: Sequence[str], date_columns: Sequence[str], headers: Sequence[str] | None) -> DataFrame:
    if headers is None:
        found = cells.select(F.explode(F.map_keys("cells")).alias("h")).distinct()
        headers = [r["h"] for r in found.orderBy("h").limit(MOST_HEADERS + 1).collect()]
        if len(headers) > MOST_HEADERS:
            raise ValueError(f"over {MOST_HEADERS} distinct headers: name the columns wanted in headers")
    value = lambda h: F.try_element_at("cells", F.lit(h))
    columns = []
    for h in headers:
        c = null_tokens(value(h)) if h in null_columns else value(h)
        columns.append((try_timestamp(c) if h in date_columns else c).alias(h))
    return cells.select(*columns, "source_file", "source_sheet")
