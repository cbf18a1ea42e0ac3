"""Exact places of rows in their files: numbers from counts of the splits, in two narrow passes.

A first pass counts the rows of each split of each file. Prefix sums over the splits, a row each, give every split the number
of its first row, and a second pass adds a row's place in its split. No row is moved, and no partition's size or packing matters.

Files are in the order of their paths. Files that Spark wrote are named by part and run, in the run's random
name: their runs are in the order of their latest file, and parts in order within a run, so appended runs follow each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Splits up to which their numbers (some 100 bytes each) are sent to all executors.
BROADCAST_SPLITS = 100_000
#: Fixed value: how Spark names what it writes.
_PART = r"^part-(\d+)-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"


def number_rows(df: DataFrame, name: str = "line", start: int = 0) -> DataFrame:
    """``df``, a scan of files that nothing has been done to yet, with the long ``name``: gapless in file and row order.

    Blank lines that the reader skips have no number. Null and repeated rows are rows like any other; no file gives no row.
    """
    place = {"_file": F.col("_metadata.file_path"), "_from": F.col("_metadata.file_block_start"), "_time": F.col("_metadata.file_modification_time"), "_mid": F.monotonically_increasing_id()}
    rows = df.select(F.struct("*").alias("_row"), *[c.alias(k) for k, c in place.items()])
    # a column is read, as a reader of text counts lines, not rows, if none is
    read = F.count_if(F.xxhash64(F.col("_row")[df.columns[0]]).isNotNull())
    splits = rows.groupBy("_file", "_from").agg(read.alias("n"), F.min("_mid").alias("_first"), F.max("_time").alias("_time"))
    file = F.element_at(F.split("_file", "/"), -1)
    run = F.regexp_extract(file, _PART, 2)
    splits = splits.withColumns({"run": run, "part": F.when(run != "", F.regexp_extract(file, _PART, 1).cast("int"))})
    splits = splits.withColumn("latest", F.when(F.col("run") != "", F.max("_time").over(Window.partitionBy("run"))))
    order = Window.orderBy(F.col("latest").asc_nulls_first(), "run", F.col("part").asc_nulls_first(), "_file", "_from")  # a row each split
    splits = splits.select("_file", "_from", "_first", (F.sum("n").over(order) - F.col("n") + start).alias("_ahead"))
    held = splits.limit(BROADCAST_SPLITS + 1).collect()  # a row each split
    known = F.broadcast(df.sparkSession.createDataFrame(held, splits.schema)) if len(held) <= BROADCAST_SPLITS else splits
    out = rows.join(known, ["_file", "_from"])
    return out.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != name], (F.col("_ahead") + F.col("_mid") - F.col("_first")).alias(name))


def join_in_order(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two scans side by side, the first with the first and so on; tables of different sizes are an error."""
    a, b = number_rows(left, "_row"), number_rows(right, "_row")
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} rows on one side, {m} on the other")
    return a.join(b, "_row").drop("_row")
