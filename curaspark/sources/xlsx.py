"""Excel workbooks (.xlsx) by the standard library: a Python data source and a writer of several sheets."""

from __future__ import annotations

import io
import math
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Fixed value: rows of a sheet at most, by the format.
MOST_ROWS = 1_048_576


def column_number(ref: str) -> int:
    """A cell's column from 0, by its letters."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _text(node: ElementTree.Element) -> str:
    """The text of a string item, of all its runs but phonetic ones."""
    parts = [t.text or "" for t in node.findall(f"{MAIN}t")]
    parts += [t.text or "" for r in node.findall(f"{MAIN}r") for t in r.findall(f"{MAIN}t")]
    return "".join(parts)


def sheet_paths(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, path in the archive) of the sheets, in order."""
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    out = []
    for s in book.iter(f"{MAIN}sheet"):
        target = rels[s.get(f"{REL}id")].lstrip("/")
        out.append((s.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return out


def rows_of(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a sheet (the first by default) as text, numbers as they are written; empty cells null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        sheets = sheet_paths(z)
        by_name = dict(sheets)
        if sheet is not None and sheet not in by_name:
            raise ValueError(f"no sheet {sheet!r}; there are {list(by_name)}")
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{MAIN}si")]
        with z.open(by_name[sheet] if sheet else sheets[0][1]) as f:
            for _, node in ElementTree.iterparse(f):
                if node.tag != f"{MAIN}row":
                    continue
                row: list[str | None] = []
                for cell in node.findall(f"{MAIN}c"):
                    at = column_number(cell.get("r")) if cell.get("r") else len(row)
                    row += [None] * (at - len(row))
                    kind, value = cell.get("t", "n"), cell.find(f"{MAIN}v")
                    if kind == "inlineStr":
                        row.append(_text(cell.find(f"{MAIN}is")))
                    elif value is None or value.text is None:
                        row.append(None)
                    elif kind == "s":
                        row.append(shared[int(value.text)])
                    elif kind == "b":
                        row.append("True" if value.text == "1" else "False")
                    else:
                        row.append(None if kind == "e" else value.text)
                yield row
                node.clear()


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = schema.names
        self.path, self.sheet = options["path"], options.get("sheet")

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        with open(self.path, "rb") as f:
            rows = rows_of(f.read(), self.sheet)
        next(rows, None)
        n = len(self.names)
        for r in rows:
            yield tuple((r + [None] * n)[:n])


def header(names: Sequence[str | None]) -> list[str]:
    """Column names of a first row: nameless ones by their place, repeated ones with a number."""
    out: list[str] = []
    for i, n in enumerate(names):
        name, k = n or f"Unnamed: {i}", 0
        base = name
        while name in out:
            k += 1
            name = f"{base}.{k}"
        out.append(name)
    return out


class XlsxDataSource(DataSource):
    """format("xlsx"): options path (a file that driver and executors both see) and sheet. All columns are text."""

    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        with open(self.options["path"], "rb") as f:
            first = next(rows_of(f.read(), self.options.get("sheet")), [])
        return ", ".join("`" + n.replace("`", "``") + "` STRING" for n in header(first))

    def reader(self, schema):
        return _Reader(schema, self.options)


def read(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet as text columns, its first row the names."""
    if path.lower().endswith(".xls"):
        raise ValueError("the legacy .xls format is not supported; save the workbook as .xlsx")
    spark.dataSource.register(XlsxDataSource)
    r = spark.read.format("xlsx")
    return (r.option("sheet", sheet) if sheet else r).load(path)


def read_anywhere(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """As read(), for paths that only Spark can open: the file is read through binaryFile, and its rows made in one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    data = bytes(files.first()["content"])  # one workbook, at most 1,048,576 rows by its format
    names = header(next(rows_of(data, sheet), []))
    schema = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)

    def rows(batches):
        import pyarrow as pa

        for b in batches:
            for content in b.column(0).to_pylist():
                got = list(rows_of(content, sheet))[1:]
                columns = [[(r[i] if i < len(r) else None) for r in got] for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)

    return files.mapInArrow(rows, schema)


def _cell(ref: str, v) -> str:
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) and not (isinstance(v, float) and math.isinf(v)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", lambda m: f"_x{ord(m[0]):04X}_", str(v))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def _sheet(names: Sequence[str], rows: Iterator[Sequence]) -> Iterator[str]:
    yield f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{MAIN[1:-1]}"><sheetData>'
    for n, row in enumerate([list(names)], 1):
        yield f'<row r="{n}">' + "".join(_cell(f"{column_letters(i)}{n}", v) for i, v in enumerate(row)) + "</row>"
    for n, row in enumerate(rows, 2):
        if n > MOST_ROWS:
            raise ValueError(f"a sheet holds at most {MOST_ROWS} rows; write Parquet instead")
        yield f'<row r="{n}">' + "".join(_cell(f"{column_letters(i)}{n}", v) for i, v in enumerate(row)) + "</row>"
    yield "</sheetData></worksheet>"


def write(path: str, sheets: Sequence[tuple[str, DataFrame]]) -> None:
    """Write frames as the sheets of one workbook on the driver, streaming their rows; sort them first, order is kept. Workbooks
    are for people: larger results belong in Parquet."""
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    n = range(1, len(sheets) + 1)
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n)
    names = "".join(f'<sheet name={quoteattr(name[:31])} sheetId="{i}" r:id="rId{i}"/>' for i, (name, _) in zip(n, sheets))
    rels = "".join(f'<Relationship Id="rId{i}" Type="{REL[1:-1]}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
    package = "http://schemas.openxmlformats.org/package/2006"
    top = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "[Content_Types].xml",
            f'{top}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
        )
        z.writestr("_rels/.rels", f'{top}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{REL[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{top}<workbook xmlns="{MAIN[1:-1]}" xmlns:r="{REL[1:-1]}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{top}<Relationships xmlns="{package}/relationships">{rels}</Relationships>')
        for i, (_, df) in zip(n, sheets):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                for text in _sheet(df.columns, (tuple(r) for r in df.toLocalIterator())):
                    f.write(text.encode())
