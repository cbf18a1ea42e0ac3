"""Tables in the folder that the driver and all executors share: they cut lineage between the steps of an operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a file of a scratch table holds at least, where the table's size is known before.
FILE_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Where the setting is absent a temporary folder is taken, but only if the
    executors are threads of the driver's own JVM.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"file://{tempfile.gettempdir()}/spanguard-{spark.sparkContext.applicationId}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


class Scratch:
    """Parquet tables under the shared folder.

    They are deleted by ``drop`` once no later plan reads them, else when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _new(self, name: str) -> str:
        self.made += 1
        at, fs = self._path(self.root)
        fs.deleteOnExit(at)
        return f"{self.root}/{self.made}-{name}"

    def save(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write ``df`` and return what reads it back; ``rows_of`` knows its rows then.

        With a bound of its ``rows`` it is written in as few files as they fill: a small table in
        hundreds of files costs more to open than to read, and local file systems start a process
        for each file that is made. Not for what Python has just made: the last stage gets so many tasks.
        """
        path = self._new(name)
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._spanguard_path, out._spanguard_rows = path, seen.get["n"]
        return out

    def bucketed(self, df: DataFrame, key: str) -> DataFrame:
        """A table in the shared folder, bucketed by ``key``: joins by it needn't move its rows again."""
        name, path = f"spanguard_{uuid.uuid4().hex}", self._new("bucketed")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.repartition(n, key).write.bucketBy(n, key).format("parquet").option("path", path).saveAsTable(name)
        out = self.spark.table(name)
        out._spanguard_table, out._spanguard_path = name, path
        return out

    def forget(self, table: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table._spanguard_table}")
        self.drop(table)

    def clear(self, *but: DataFrame) -> None:
        """Delete all that was saved so far but these tables."""
        at, fs = self._path(self.root)
        for f in fs.listStatus(at):
            if f.getPath().getName() not in [df._spanguard_path.rpartition("/")[2] for df in but]:
                fs.delete(f.getPath(), True)

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            at, fs = self._path(df._spanguard_path)
            fs.delete(at, True)


def rows_of(saved: DataFrame) -> int:
    """Rows of a table that ``Scratch.save`` has written."""
    return saved._spanguard_rows


def numbered(scratch: Scratch, df: DataFrame, order: list, name: str, rows: int) -> DataFrame:
    """``df`` with ``nth``, gapless from 0 in ``order``: sorted by ranges, whose counts are summed up; no task holds all rows."""
    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // FILE_ROWS)))
    ranged = scratch.save(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)
    ahead, sums = [], 0
    for r in ranged.groupBy("_part").count().orderBy("_part").collect():  # a row for each partition
        ahead.append((r["_part"], sums))
        sums += r["count"]
    first = F.broadcast(df.sparkSession.createDataFrame(ahead, "_part int, _ahead long"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(first, "_part").withColumn("nth", nth + F.col("_ahead")).drop("_part", "_ahead")
