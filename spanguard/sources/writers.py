"""Writers: JSON lines and CSV by all tasks; one JSON file or workbook put together from parts that tasks have made; Markdown."""

from __future__ import annotations

import json
import math
import re
import struct
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegralType, MapType, StringType, StructType

from ..scratch import Scratch
from ..session import ship

#: Rows that a table in a report may have.
DRIVER_ROWS = 100_000
#: Rows that one file may have unless the caller says more: it is copied through the driver's disk.
FILE_ROWS = 10_000_000
#: A part of a file is closed at so many rows or so many characters.
PART_ROWS, PART_CHARS = 16_384, 4_000_000


def _own(name: str) -> Column:
    """The column of this very name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record a line, characters as they are, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str, most: int = FILE_ROWS) -> int:
    """One indented JSON array in the order of ``df``, its records rendered by tasks; more than ``most`` rows are an error. Returns its rows."""
    text = df.select(F.to_json(F.struct(*map(_own, df.columns)), {"ignoreNullFields": "false"}).alias("r"))

    def render(rows: Iterator[tuple]) -> Iterator[str]:
        for (r,) in rows:
            yield ",\n  " + json.dumps(json.loads(r), ensure_ascii=False, indent=2).replace("\n", "\n  ")

    with _parts(text, render, most, deflate=False) as (parts, data), tempfile.TemporaryDirectory() as at:
        with open(f"{at}/array.json", "wb") as f:
            f.write(b"[")
            for n, d in enumerate(data):
                f.write(d if n else d[1:])  # no comma ahead of the first
            f.write(b"\n]" if parts else b"]")
        put_file(df.sparkSession, f"{at}/array.json", path)
    return sum(p.rows for p in parts)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, as a spreadsheet has no others."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    return df.select(*[F.to_json(_own(c)).alias(c) if c in nested else _own(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
#: Rows of a sheet, the names' row among them (fixed value of the format).
SHEET_ROWS = 1_048_576


def _book(sheets: int) -> dict[str, str]:
    """The parts of a workbook with so many sheets, but for the sheets."""
    ns = range(1, sheets + 1)
    types = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for n in ns)
    named = "".join(f'<sheet name="Sheet{n}" sheetId="{n}" r:id="rId{n}"/>' for n in ns)
    places = "".join(f'<Relationship Id="rId{n}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in ns)
    return {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_SHEET}" xmlns:r="{_OFFICE}"><sheets>{named}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{places}</Relationships>',
    }


_NO_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and math.isfinite(value):
        return f"<c><v>{value!r}</v></c>"
    # characters that XML can't hold are written by their numbers, as workbooks do
    text = escape(_NO_XML.sub(lambda m: f"_x{ord(m[0]):04X}_", str(value)))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _packed(text: bytes, last: bool) -> bytes:
    """``text`` deflated so that what else is deflated can follow it byte by byte, unless it is the last."""
    z = zlib.compressobj(wbits=-15)
    return z.compress(text) + z.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH)


def _product(a: int, b: int) -> int:
    """a * b of two polynomials over bits, modulo that of CRC-32; the highest bit is the constant term."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, length: int) -> int:
    """CRC-32 of two texts in a row from those of each, and the bytes of the second: the first is moved on by as many zero bytes."""
    power, step = 1 << 31, 1 << 23  # x^0 and x^8
    while length:
        if length & 1:
            power = _product(power, step)
        step, length = _product(step, step), length >> 1
    return _product(first, power) ^ second


@dataclass
class _Part:
    """What is known of a piece of a file: rows, bytes, their CRC-32, and bytes as they are stored."""

    rows: int
    size: int
    crc: int
    stored: int

    @classmethod
    def of(cls, text: bytes, stored: bytes, rows: int = 0) -> _Part:
        return cls(rows, len(text), zlib.crc32(text), len(stored))

    def then(self, more: _Part) -> _Part:
        return _Part(self.rows + more.rows, self.size + more.size, joined_crc(self.crc, more.crc, more.size), self.stored + more.stored)


@contextmanager
def _parts(df: DataFrame, render: Callable[[Iterator[tuple]], Iterator[str]], most: int, deflate: bool) -> Iterator[tuple[list[_Part], Iterator[bytes]]]:
    """What ``df``'s tasks render of its rows, in its order: parts, and their bytes one by one.

    Tasks write their parts to the shared folder, so a lost one repeats its own. The driver
    holds a line for each part, and the bytes of one partition of them at a time.
    """
    longs = ("rows", "size", "crc", "stored")
    schema = pa.schema([("task", pa.int32()), ("nth", pa.int32()), *((c, pa.int64()) for c in longs), ("data", pa.binary())])

    def close(task: int, nth: int, held: list[str]) -> pa.RecordBatch:
        text = "".join(held).encode()
        data = _packed(text, False) if deflate else text
        p = _Part.of(text, data, len(held))
        return pa.RecordBatch.from_pylist([{"task": task, "nth": nth, "rows": p.rows, "size": p.size, "crc": p.crc, "stored": p.stored, "data": data}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, held, chars = TaskContext.get().partitionId(), 0, [], 0
        for r in render(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))):
            held.append(r)
            chars += len(r)
            if len(held) == PART_ROWS or chars >= PART_CHARS:
                yield close(task, nth, held)
                nth, held, chars = nth + 1, [], 0
        if held:
            yield close(task, nth, held)

    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "parts")
    plain = df.toDF(*(f"c{n}" for n in range(len(df.columns))))  # names with dots aren't taken
    saved = scratch.save(plain.mapInArrow(run, "task int, nth int, rows long, size long, crc long, stored long, data binary"), "parts")
    try:
        n = saved.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if n > most:
            raise ValueError(f"{n} rows are more than the {most} that one file may have")
        ordered = saved.orderBy("task", "nth")
        parts = [_Part(*r) for r in ordered.select(*longs).collect()]  # a line for each of the parts of ``most`` rows
        yield parts, (bytes(r[0]) for r in ordered.select("data").toLocalIterator())
    finally:
        scratch.clear()


class _Zip:
    """A zip archive of entries that are deflated already; their sizes are known before their bytes come."""

    def __init__(self, file):
        self.file, self.directory, self.entries = file, b"", 0

    def begin(self, name: str, part: _Part) -> None:
        """The head of an entry, whose bytes are to be written to ``file`` next."""
        at, raw, far = self.file.tell(), name.encode(), 0xFFFFFFFF
        wide = max(part.size, part.stored, at) >= far
        version, day = 45 if wide else 20, 0x21  # the first day that the format knows
        sizes = (far, far) if wide else (part.stored, part.size)
        common = struct.pack("<HHHHHIIIH", version, 0x800, zipfile.ZIP_DEFLATED, 0, day, part.crc, *sizes, len(raw))
        local = struct.pack("<HHQQ", 1, 16, part.size, part.stored) if wide else b""
        self.file.write(b"PK\x03\x04" + common + struct.pack("<H", len(local)) + raw + local)
        more = struct.pack("<HHQQQ", 1, 24, part.size, part.stored, at) if wide else b""
        self.directory += b"PK\x01\x02" + struct.pack("<H", version) + common + struct.pack("<HHHHII", len(more), 0, 0, 0, 0, far if wide else at) + raw + more
        self.entries += 1

    def add(self, name: str, text: str) -> None:
        data = _packed(text.encode(), True)
        self.begin(name, _Part.of(text.encode(), data))
        self.file.write(data)

    def end(self) -> None:
        at, size, n = self.file.tell(), len(self.directory), self.entries
        self.file.write(self.directory)
        if at + size >= 0xFFFFFFFF:
            self.file.write(b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, at))
            self.file.write(b"PK\x06\x07" + struct.pack("<IQI", 0, at + size, 1))
            at = 0xFFFFFFFF
        self.file.write(b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, n, n, size, at, 0))


def _sheets(parts: list[_Part]) -> list[list[_Part]]:
    """Parts in a row that fill a sheet each, beside the row of names; there is one sheet at least."""
    out, rows = [[]], 1
    for p in parts:
        if rows + p.rows > SHEET_ROWS:
            out.append([])
            rows = 1
        out[-1].append(p)
        rows += p.rows
    return out


def _cells(df: DataFrame) -> DataFrame:
    """Columns as cells know them: numbers, booleans and texts."""
    plain = (IntegralType, DoubleType, FloatType, BooleanType, StringType)
    return df.select(*[_own(f.name) if isinstance(f.dataType, plain) else _own(f.name).cast("string").alias(f.name) for f in df.schema.fields])


def write_spreadsheet(df: DataFrame, path: str, most: int = FILE_ROWS) -> str:
    """A workbook with the sheets Sheet1, Sheet2, ...: each has the columns' names, then rows in the order of ``df``. Returns its path.

    Cells hold whole texts. Tasks render and deflate the rows; the driver copies their bytes one
    after the other and neither sees a row nor deflates one. What one sheet can't hold goes on
    in the next. More than ``most`` rows are an error. The path may be in any file system that Spark knows.
    """

    def render(rows: Iterator[tuple]) -> Iterator[str]:
        for row in rows:
            yield f"<row>{''.join(map(_cell, row))}</row>"

    head = f'{_HEAD}<worksheet xmlns="{_SHEET}"><sheetData><row>{"".join(map(_cell, df.columns))}</row>'.encode()
    tail = b"</sheetData></worksheet>"
    first, last = _packed(head, False), _packed(tail, True)
    with _parts(_cells(flat(df)), render, most, deflate=True) as (parts, data), tempfile.TemporaryDirectory() as at:
        sheets = _sheets(parts)
        with open(f"{at}/book.xlsx", "wb") as f:
            z = _Zip(f)
            for name, text in _book(len(sheets)).items():
                z.add(name, _HEAD + text)
            for n, sheet in enumerate(sheets, 1):
                whole = _Part.of(head, first)
                for p in sheet:
                    whole = whole.then(p)
                z.begin(f"xl/worksheets/sheet{n}.xml", whole.then(_Part.of(tail, last)))
                f.write(first)
                for _ in sheet:
                    f.write(next(data))
                f.write(last)
            z.end()
        put_file(df.sparkSession, f"{at}/book.xlsx", path)
    return path


def read_spreadsheet(path: str) -> list[dict]:
    """The rows of a workbook of ``write_spreadsheet``, of all its sheets, by column; texts, numbers and booleans."""

    def value(c):
        if c.get("t") == "inlineStr":
            return re.sub("_x([0-9A-F]{4})_", lambda m: chr(int(m[1], 16)), c.findtext(f"{{{_SHEET}}}is/{{{_SHEET}}}t") or "")
        v = c.findtext(f"{{{_SHEET}}}v")
        return None if v is None else bool(int(v)) if c.get("t") == "b" else float(v)

    out = []
    with zipfile.ZipFile(path) as z:
        for n in range(1, 1 + sum(name.startswith("xl/worksheets/") for name in z.namelist())):
            sheet = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{n}.xml"))
            names, *rows = [[value(c) for c in row] for row in sheet.iter(f"{{{_SHEET}}}row")]
            out += [dict(zip(names, r)) for r in rows]
    return out


def put_file(spark: SparkSession, own: str, path: str) -> None:
    """Copy a file of the driver's to where ``path`` says, in any file system that Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(f"file://{own}"), at)


def write_json(spark: SparkSession, value, path: str) -> None:
    """One small value as an indented JSON file."""
    with tempfile.TemporaryDirectory() as at:
        with open(f"{at}/value.json", "w", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=2, default=str)
        put_file(spark, f"{at}/value.json", path)


def write_markdown(df: DataFrame, title: str) -> str:
    """A small table as Markdown, for reports; one of more than ``DRIVER_ROWS`` rows is an error."""
    rows = df.limit(DRIVER_ROWS + 1).collect()
    if len(rows) > DRIVER_ROWS:
        raise ValueError(f"more than {DRIVER_ROWS} rows: no report")
    line = lambda cells: "| " + " | ".join(str(c) for c in cells) + " |"
    return "\n".join([f"## {title}", "", line(df.columns), line(["---"] * len(df.columns)), *(line(r) for r in rows), ""])
