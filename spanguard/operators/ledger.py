"""Paid calls with a ledger: what has been answered is never asked again, and calls at once are bounded over the cluster.

A call is known by its row's id and the hash of its instructions and text. Answers are appended to a folder as
they come, one JSON line each, flushed line by line. Before anything is asked,
the ledger is read and answered calls are left out, so a later run pays for the rest only. A task that is
tried again first reads what its earlier attempts have written: its rows are the same, as rows
are dealt by hash to a fixed number of tasks. That number bounds the calls at once in the whole cluster. Where the session
speculates, the tasks run in barrier mode, which Spark never duplicates.

The folder is written by Python workers and must be in a file system that Arrow knows (a shared mount, HDFS, S3, GCS).
"""

from __future__ import annotations

import asyncio
import io
import json
import time
import uuid
from collections.abc import Awaitable, Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settings, ship

LINES = "key string, prompt string, reply string, error string, at double"
#: Rows that a task holds at once, with their texts and calls made ready.
ROWS = 256
#: Calls after which a share of failures above the bound ends a task's asking.
PATIENCE = 20

Client = Callable[[], Callable[[str, str], Awaitable[str]]]


class RetryLater(Exception):
    """What a client raises when the call may succeed later."""


class CallsFailed(RuntimeError):
    """More calls failed than the bound allows."""


def pause(k: int, wait: tuple[float, float]) -> float:
    """Seconds before try ``k`` + 1: doubling from 1, held between the bounds."""
    return max(wait[0], min(wait[1], 2.0**k))


async def one_call(call, instructions: str, value: str, attempts: int, wait: tuple[float, float]) -> tuple[str | None, str | None]:
    """(reply, error). Only ``RetryLater`` is tried again."""
    error = None
    for k in range(attempts):
        try:
            return await call(instructions, value), None
        except RetryLater as e:
            error = f"RetryLater: {e}"
            if k + 1 < attempts:
                await asyncio.sleep(pause(k, wait))
        except Exception as e:  # a client may raise anything; it is counted and kept
            return None, f"{type(e).__name__}: {e}"
    return None, error


def prompt_hash(instructions: str, text: Column) -> Column:
    return F.sha2(F.concat(F.lit(instructions + "\0"), text), 256)


class Ledger:
    """A folder of answered calls."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        filesystem, self.base = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        filesystem.create_dir(self.base, recursive=True)

    def lines(self) -> DataFrame:
        """All lines; one that a killed task left unfinished isn't a line."""
        read = self.spark.read.schema(LINES).option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
        return read.json(self.path).where("key is not null and prompt is not null and at is not null")

    def replies(self) -> DataFrame:
        """key, prompt, reply: the latest answer of each call; failed calls have none."""
        answered = self.lines().where("error is null").groupBy("key", "prompt")
        return answered.agg(F.max_by("reply", F.struct("at", "reply")).alias("reply"))


class _Book:
    """What one task attempt writes, and what earlier ones have written."""

    def __init__(self, uri: str, run: str, part: int):
        self.files, self.base = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
        self.folder = f"{self.base}/{run}/{part}"
        self.files.create_dir(self.folder, recursive=True)
        self.out = None

    def done(self) -> set[tuple[str, str]]:
        found = set()
        for f in self.files.get_file_info(fs.FileSelector(self.folder)):
            with self.files.open_input_stream(f.path) as stream, io.BufferedReader(stream) as lines:
                for line in lines:
                    try:
                        row = json.loads(line)
                        if row["error"] is None:
                            found.add((row["key"], row["prompt"]))
                    except (ValueError, KeyError):  # an unfinished last line
                        continue
        return found

    def add(self, key: str, prompt: str, reply: str | None, error: str | None) -> None:
        if self.out is None:
            self.out = self.files.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}.jsonl")
        line = {"key": key, "prompt": prompt, "reply": reply, "error": error, "at": time.time()}
        self.out.write((json.dumps(line) + "\n").encode())
        self.out.flush()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def ask_once(rows: DataFrame, client: Client, instructions: str, ledger: Ledger, text: str = "code", key: str = "unique_id", concurrency: int = 10, attempts: int = 3, wait: tuple[float, float] = (1.0, 10.0), most_failed: float = 0.5) -> DataFrame:
    """Rows ``key`` and reply; asks for what the ledger doesn't have, then reads it.

    At most ``concurrency`` calls run at once in the whole cluster. An empty reply is an answer that says nothing, and null
    here; so is the reply of a null text, which isn't asked for, and of a failed call, which a later
    run asks for again. If more than the share ``most_failed`` of a task's calls fail (of ``PATIENCE`` at least), it asks no
    more, and ``CallsFailed`` tells the first error.
    """
    spark = rows.sparkSession
    ship(spark)
    kind, run_id, uri = dict(rows.dtypes)[key], uuid.uuid4().hex, ledger.path
    calls = rows.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    calls = calls.withColumn("prompt", prompt_hash(instructions, F.col("text"))).dropDuplicates(["key", "prompt"])
    tasks = max(1, min(concurrency, spark.sparkContext.defaultParallelism))
    todo = calls.join(ledger.replies().select("key", "prompt"), ["key", "prompt"], "left_anti").repartition(tasks, "key", "prompt")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        book = _Book(uri, run_id, part)
        done, free = book.done(), asyncio.Semaphore(concurrency // tasks + (part < concurrency % tasks))
        asked = failed = 0
        first = None
        with asyncio.Runner() as loop:  # one loop for the client's whole life
            call = None

            async def one(key: str, prompt: str, value: str) -> None:
                nonlocal asked, failed, first
                async with free:
                    if asked >= PATIENCE and failed > most_failed * asked:
                        return
                    reply, error = await one_call(call, instructions, value, attempts, wait)
                    book.add(key, prompt, reply, error)
                    asked += 1
                    if error is not None:
                        failed, first = failed + 1, first or error

            async def all_of(frame: pd.DataFrame) -> None:
                await asyncio.gather(*(one(k, p, v) for k, p, v in zip(frame["key"], frame["prompt"], frame["text"]) if (k, p) not in done))

            try:
                for frame in frames:
                    call = call or client()
                    loop.run(all_of(frame))
            finally:
                book.close()
        yield pd.DataFrame({"asked": [asked], "failed": [failed], "error": [first]})

    barrier = spark.conf.get("spark.speculation", "false") == "true"
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=ROWS):
        found = todo.mapInPandas(run, "asked long, failed long, error string", barrier=barrier).collect()  # a row for each task
    for r in found:
        if r.asked >= PATIENCE and r.failed > most_failed * r.asked:
            raise CallsFailed(f"{r.failed} of {r.asked} calls of a task failed, the first with {r.error}")
    own = rows.select(F.col(key), F.col(key).cast("string").alias("_k"), prompt_hash(instructions, F.col(text)).alias("_p"))
    said = ledger.replies().select(F.col("key").alias("_k"), F.col("prompt").alias("_p"), "reply")
    reply = F.when(F.col("reply").rlike(r"(?U)\S"), F.col("reply"))
    return own.join(said, ["_k", "_p"], "left").select(F.col(key).cast(kind).alias(key), reply.alias("reply"))
