"""Tables inside HTML text."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA_TAIL = "table_no int, row_no int, cells array<string>"


class _Tables(HTMLParser):
    """Collects the rows of every table; a nested table counts as a table of its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self.count = 0
        self.open: list[dict] = []

    def _end_cell(self, t: dict) -> None:
        if t["cell"] is not None:
            t["row"].append(" ".join("".join(t["cell"]).split()))
            t["cell"] = None

    def _end_row(self, t: dict) -> None:
        self._end_cell(t)
        if t["row"]:
            self.rows.append((t["no"], t["rows"], t["row"]))
            t["rows"] += 1
        t["row"] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"no": self.count, "rows": 0, "row": [], "cell": None})
            self.count += 1
        elif self.open and tag == "tr":
            self._end_row(self.open[-1])
        elif self.open and tag in ("td", "th"):
            self._end_cell(self.open[-1])
            self.open[-1]["cell"] = []

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th"):
            self._end_cell(self.open[-1])
        elif tag == "tr":
            self._end_row(self.open[-1])
        elif tag == "table":
            self._end_row(self.open.pop())

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    def finish(self) -> list[tuple[int, int, list[str]]]:
        self.close()
        while self.open:
            self._end_row(self.open.pop())
        return sorted(self.rows, key=lambda r: r[:2])


def extract_html_tables(df: DataFrame, html: str, key: str) -> DataFrame:
    """One row per table row: the key, table number, row number and the cell texts.

    Documents without a table are filtered out before any Python runs.
    """
    kind = df.schema[key].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc"], batch["html"]):
                parser = _Tables()
                parser.feed(text)
                out += [(doc, *row) for row in parser.finish()]
            yield pd.DataFrame(out, columns=["doc", "table_no", "row_no", "cells"])

    docs = df.select(F.col(key).alias("doc"), F.col(html).alias("html")).filter(F.col("html").rlike("(?i)<table"))
    return docs.mapInPandas(parse, f"doc {kind}, {SCHEMA_TAIL}").withColumnRenamed("doc", key)


def cell_columns(width: int, stem: str = "c") -> list[Column]:
    return [F.get("cells", F.lit(i)).alias(f"{stem}{i + 1}") for i in range(width)]
