"""Workbooks and JSON arrays put together from parts that tasks make."""

import io
import json
import random
import subprocess
import sys
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from spanguard.sources import writers


def test_joined_crc():
    r = random.Random(3)
    for _ in range(200):
        a, b = r.randbytes(r.randrange(300)), r.randbytes(r.randrange(300))
        assert writers.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_rows_in_order_over_tasks_and_sheets(spark, tmp_path, monkeypatch):
    """Sheets hold whole parts; an ordered frame of many tasks, some of them empty, keeps its order."""
    monkeypatch.setattr(writers, "PART_CHARS", 2_000)
    monkeypatch.setattr(writers, "SHEET_ROWS", 150)
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id"), F.concat(F.lit("é<&"), "id").alias("a.b"), F.expr("cast(id as decimal(9, 2))").alias("d")).where("id % 3 = 0 or id > 500").orderBy(F.desc("id"))
    writers.write_spreadsheet(df, f"{tmp_path}/s.xlsx")
    rows = writers.read_spreadsheet(f"{tmp_path}/s.xlsx")
    assert rows == [{"id": float(r.id), "a.b": r["a.b"], "d": str(r.d)} for r in df.collect()]
    with zipfile.ZipFile(f"{tmp_path}/s.xlsx") as z:
        assert z.testzip() is None
        sheets = [n for n in z.namelist() if "sheet" in n]
        assert len(sheets) > 3 and all(2 <= z.read(n).count(b"<row>") <= 150 for n in sheets)
        assert z.read("xl/workbook.xml").count(b"<sheet ") == len(sheets) == z.read("[Content_Types].xml").count(b"/xl/worksheets/")


def test_small_and_refused(spark, tmp_path):
    none = spark.range(0).withColumn("when", F.lit(None).cast("timestamp"))
    writers.write_spreadsheet(none, f"{tmp_path}/none.xlsx")
    assert writers.read_spreadsheet(f"{tmp_path}/none.xlsx") == []
    assert writers.write_json_array(none, f"{tmp_path}/none.json") == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    for write in (writers.write_spreadsheet, writers.write_json_array):
        with pytest.raises(ValueError, match="more than"):
            write(spark.range(11), f"{tmp_path}/x", most=10)
    assert not (tmp_path / "x").exists()


def test_json_array_is_what_the_module_writes(spark, tmp_path):
    df = spark.range(0, 300, numPartitions=5).select("id", F.lit(None).cast("int").alias("none"), F.array(F.lit("a\u2028b\n"), F.col("id").cast("string")).alias("list")).orderBy(F.desc("id"))
    assert writers.write_json_array(df, f"{tmp_path}/a.json") == 300
    rows = [{"id": r.id, "none": None, "list": r.list} for r in df.collect()]
    assert (tmp_path / "a.json").read_text() == json.dumps(rows, ensure_ascii=False, indent=2)


@pytest.mark.parametrize("far", [0, 2**32 + 5])
def test_archive_of_wide_entries(far):
    """Sizes and places beyond 32 bits are written as 64 bits; here the archive only claims to begin there."""

    class Sparse(io.BytesIO):
        def tell(self):
            return super().tell() + far

    f = Sparse()
    z = writers._Zip(f)
    z.add("a.txt", "first")
    z.add("b.txt", "second")
    z.end()
    if not far:
        with zipfile.ZipFile(f) as back:
            assert back.testzip() is None and back.read("b.txt") == b"second"
    else:
        with _at(f.getvalue(), far) as back:
            assert [i.header_offset for i in back.infolist()][0] == far and [i.file_size for i in back.infolist()] == [5, 6]


def _at(data, far):
    """An archive whose first ``far`` bytes are zeros that are not held."""

    class Far(io.RawIOBase):
        at = 0

        def seekable(self):
            return True

        def readable(self):
            return True

        def tell(self):
            return self.at

        def seek(self, to, how=0):
            self.at = to + (0, self.at, far + len(data))[how]
            return self.at

        def read(self, n=-1):
            begin = self.at - far
            end = len(data) if n is None or n < 0 else begin + n
            out = b"" if end <= 0 else data[max(0, begin) : end]
            out = bytes(max(0, min(end, 0) - begin)) + out if begin < 0 else out
            self.at += len(out)
            return out

    return zipfile.ZipFile(Far())


def test_a_million_rows_with_a_small_driver(tmp_path):
    """A million rows with a driver of 1 GB, in a process of its own as the setting is the JVM's."""
    code = f"""
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[4]").config("spark.driver.memory", "1g").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from spanguard.sources import writers
df = spark.range(0, 1_200_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") / 7).alias("x"))
writers.write_spreadsheet(df, "file://{tmp_path}/million.xlsx")
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    rows = 0
    with zipfile.ZipFile(tmp_path / "million.xlsx") as z:
        for n in (1, 2):
            with z.open(f"xl/worksheets/sheet{n}.xml") as f:
                held = b""
                while block := f.read(1 << 20):
                    rows += (held + block).count(b"<row>") - held.count(b"<row>")
                    held = block[-4:]
    assert rows == 1_200_002
