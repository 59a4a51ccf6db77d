"""Tables in images by a recogniser that the caller brings; HTML tables as cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import xlsx

#: Takes an image's bytes, gives the HTML of each table in it.
Recogniser = Callable[[bytes], list[str]]


def recognised(spark: SparkSession, path: str, recogniser: Recogniser) -> DataFrame:
    """(path, html) of the images at path; a task fails if an image has no table or several. The recogniser is loaded once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tables = recogniser(content)
                if len(tables) != 1:
                    raise RuntimeError(f"{name}: {len(tables) or 'no'} extraction results; expected one table")
                out.append(tables[0])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["path", "html"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, html string")


class _Table(HTMLParser):
    """Rows of (text, colspan, rowspan)."""

    def __init__(self):
        super().__init__()
        self.rows: list[list[list]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            a = dict(attrs)
            self.rows[-1].append(["", int(a.get("colspan") or 1), int(a.get("rowspan") or 1)])
            self.open = True

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.rows[-1][-1][0] += data


def grid(html: str) -> list[list[str]]:
    """The cells of an HTML table row by row; a cell that spans several places is in all of them."""
    parser = _Table()
    parser.feed(html)
    taken: dict[tuple[int, int], str] = {}
    width = 0
    for r, row in enumerate(parser.rows):
        c = 0
        for text, cols, rows in row:
            while (r, c) in taken:
                c += 1
            for i in range(rows):
                for j in range(cols):
                    taken[r + i, c + j] = text.strip()
            c += cols
        width = max([width, *(k[1] + 1 for k in taken)])
    return [[taken.get((r, c), "") for c in range(width)] for r in range(len(parser.rows))]


def cells(tables: DataFrame) -> DataFrame:
    """(path, row, cells) of (path, html): one row for each table row, its cells an array. A null html has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, i, r) for p, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if html is not None for i, r in enumerate(grid(html))]
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.string(), pa.int32(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "row", "cells"])

    return tables.select("path", "html").mapInArrow(run, "path string, row int, cells array<string>")


def save(spark: SparkSession, html: str, stem: str | Path) -> tuple[Path, Path]:
    """One recognised table beside its image: its HTML as it is, and a workbook of its cells (stem + .html and .xlsx)."""
    page, book = (Path(f"{stem}{e}") for e in (".html", ".xlsx"))
    page.write_text(html, encoding="utf-8")
    rows = grid(html)
    names = [f"c{i}" for i in range(max(map(len, rows), default=0))] or ["c0"]
    schema = ", ".join(f"{n} string" for n in ["n", *names]).replace("n string", "n int", 1)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema).orderBy("n").drop("n")
    xlsx.write(str(book), [("Table", table)])
    return page, book
