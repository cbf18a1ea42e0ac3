"""Shared pieces of the text-corpus operators: scratch tables, reading inputs, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spanguard.scratch import Scratch, numbered, rows_of, shared_dir  # noqa: F401  what the operators share
from spanguard.session import ship

#: Rows and bytes of an Arrow batch; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[str, object] = {}


def keep(owner: str, make: Callable[[], object]):
    """What a Python worker keeps from task to task of one ``owner``."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def _begin(owner: str | None) -> None:
    """A task of another operator begins in this worker: what the one before kept goes."""
    if owner not in _kept:
        _kept.clear()


def _end() -> None:
    """Give freed memory back to the system, as the worker stays for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def _bound_batches(spark: SparkSession) -> None:
    """Bounds of Arrow batches, where the session has none of its own."""
    for name, value in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.max{name}PerBatch"
        if spark.conf.get(key, "1") == "1":
            spark.conf.set(key, str(value))


def run_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, owner: str | None = None) -> DataFrame:
    """``mapInArrow`` with bounded batches, whose workers give memory back at the end of each task."""
    ship(df.sparkSession)
    _bound_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(owner)
        try:
            yield from run(batches)
        finally:
            _end()

    return df.mapInArrow(task, schema)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, owner: str | None = None) -> DataFrame:
    """``run_batches`` where ``make()`` runs once for each task, to build tables that its batches share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return run_batches(df, run, schema, owner)
