"""Numbers of rows over many files and splits, against the files read in a loop."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from spanguard import cli
from spanguard.sources import order, readers


@pytest.fixture(params=["16k", "128m"])
def splits(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_many_files(spark, tmp_path, splits, monkeypatch):
    r, want = random.Random(1), []
    for f in ("a", "b", "c", "d"):
        with open(f"{tmp_path}/{f}.jsonl", "w") as out:
            for i in range(r.choice([1, 300, 900])):
                want.append(f"{f}{i}")
                out.write(json.dumps({"x": want[-1], "pad": "é" * r.randint(0, 200)}) + "\n" + "\n" * (i % 7 == 0))
    df = spark.read.schema("x string, line string").json(str(tmp_path))
    for bound in (100_000, 1):
        monkeypatch.setattr(order, "BROADCAST_SPLITS", bound)
        got = order.number_rows(df, "line", start=5)
        assert got.columns == ["x", "line"] and {x.line - 5: x.x for x in got.collect()} == dict(enumerate(want))
        # a filter behind doesn't change numbers
        assert {x.x for x in order.number_rows(df).where("line % 50 = 0").collect()} == set(want[::50])


def test_parquet_and_no_rows(spark, tmp_path, splits):
    spark.range(5000).select("id", F.lit("x").alias("_file")).repartition(7).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/p")
    rows = order.number_rows(spark.read.parquet(f"{tmp_path}/p")).collect()
    assert sorted(x.line for x in rows) == list(range(5000)) and {x.id for x in rows} == set(range(5000))
    by_file = [x.id for f in sorted(os.listdir(f"{tmp_path}/p")) if f.startswith("part") for x in spark.read.parquet(f"{tmp_path}/p/{f}").coalesce(1).collect()]
    assert [x.id for x in sorted(rows, key=lambda x: x.line)] == by_file
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert order.number_rows(spark.read.parquet(f"{tmp_path}/none")).count() == 0


def test_appended_runs_follow_each_other(spark, tmp_path):
    """Spark's names carry a random id, so the order of paths says nothing about the order of runs."""
    for run in range(6):
        rows = [(i, "secure", bool(run)) if run != 3 else (i, "uncertain", True) for i in range(30)]
        spark.createDataFrame(rows, readers.STAGE1).withColumn("verdict", F.concat("verdict", F.lit(str(run)))).repartition(4).write.mode("append").json(f"{tmp_path}/s")
        time.sleep(0.05)
    last = readers.keep_last(readers.read_stage(spark, f"{tmp_path}/s", readers.STAGE1), "unique_id", "line")
    assert {x.verdict for x in last.collect()} == {"secure5"} and last.count() == 30


def test_rows_side_by_side(spark, tmp_path, splits):
    spark.range(900).select(F.concat(F.lit("l"), "id").alias("a")).coalesce(3).write.json(f"{tmp_path}/l")
    spark.range(900).select((F.col("id") * 2).alias("b")).coalesce(5).write.parquet(f"{tmp_path}/r")
    left = spark.read.schema("a string").json(f"{tmp_path}/l")
    got = order.join_in_order(left, spark.read.parquet(f"{tmp_path}/r")).collect()
    assert {(x.a, x.b) for x in got} == {(f"l{i}", 2 * i) for i in range(900)}
    with pytest.raises(ValueError):
        order.join_in_order(left, spark.read.parquet(f"{tmp_path}/r").where("b > 0"))


def test_raw_predictions_in_input_order(spark, tmp_path):
    rows = [(f"text {i} " + "x" * (i % 90), (i * 7919 % 1000) / 1000) for i in range(800)]
    for k in range(4):
        spark.createDataFrame(rows[200 * k : 200 * k + 200], "text string, p1 double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    cli.main(["guard", "--input", f"{tmp_path}/in", "--output-dir", f"{tmp_path}/out"])
    at = f"{tmp_path}/out/raw_predictions"
    lines = [json.loads(line) for f in sorted(os.listdir(at)) if f.startswith("part") for line in open(f"{at}/{f}")]
    assert [x["text"] for x in lines] == [t for t, _ in rows] and set(lines[0]) == {"text", "p1", "raw_label"}
