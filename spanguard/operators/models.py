"""Models as pluggable steps: token taggers, text scorers and language models, with bounded concurrency."""

from __future__ import annotations

import asyncio
import importlib
from collections.abc import Awaitable, Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPAN_TYPE
from .ledger import PATIENCE, CallsFailed, RetryLater, one_call  # noqa: F401  what clients raise
from .spans import decode_tags, windows


def tag_windows(docs: DataFrame, tokens: Callable[[Column], Column], predict: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], size: int = 512, overlap: int = 64) -> DataFrame:
    """Adds model_spans, one array of spans for each window of each document, and model_error: it has no tags.

    ``tokens`` gives the text's tokens (start, end); ``predict`` maps frames with column ``pieces`` to
    frames with ``tags`` and ``scores`` of equal lengths, and loads its model once for each task.
    Offsets are those of the whole text's tokens, so no window drifts.
    """
    docs = docs.withColumn("_tokens", tokens(F.col("text"))).withColumn("_windows", windows(F.size("_tokens"), size, overlap))
    pieces = F.transform("_windows", lambda w: F.transform(F.slice(F.col("_tokens"), w["token_start"] + 1, w["token_end"] - w["token_start"]), lambda t: F.substring(F.col("text"), t["start"] + 1, t["end"] - t["start"])))
    docs = docs.withColumn("pieces", pieces)

    from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

    kind = StructType([StructField("tags", ArrayType(ArrayType(StringType()))), StructField("scores", ArrayType(ArrayType(DoubleType())))])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from predict(pd.DataFrame({"pieces": b}) for b in batches)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    docs = docs.withColumn("_p", F.pandas_udf(run, kind)("pieces"))

    def spans(w: Column, i: Column) -> Column:
        at = F.slice(F.col("_tokens"), w["token_start"] + 1, w["token_end"] - w["token_start"])
        return decode_tags(F.transform(at, lambda t, k: F.struct(F.get(F.get(F.col("_p.tags"), i), k).alias("tag"), t["start"].alias("start"), t["end"].alias("end"), F.get(F.get(F.col("_p.scores"), i), k).alias("score"))))

    failed = F.col("_p.tags").isNull()
    docs = docs.withColumn("model_spans", F.when(failed, F.array().cast(f"array<{SPAN_TYPE}>")).otherwise(F.transform("_windows", spans))).withColumn("model_error", failed & F.col("text").isNotNull())
    return docs.drop("_tokens", "_windows", "pieces", "_p")


def ask(rows: DataFrame, client: Callable[[], Callable[[str, str], Awaitable[str]]], instructions: str, text: str = "code", key: str = "unique_id", concurrency: int = 10, attempts: int = 3, wait: tuple[float, float] = (1.0, 10.0), most_failed: float = 1.0) -> DataFrame:
    """Rows key and reply of a language model; null where every attempt failed.

    For calls that cost nothing: a task that is tried again calls again (``ledger.ask_once`` doesn't), and ``concurrency``
    calls run at once in each task. ``client()`` is called once for each task and returns an async (instructions,
    input) call. Only ``RetryLater`` is tried again, after growing pauses. More than the share ``most_failed`` of failed
    calls, of ``PATIENCE`` at least, is an error.
    """
    schema = f"{key} {dict(rows.dtypes)[key]}, reply string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free, asked, errors = asyncio.Semaphore(concurrency), 0, []

        async def one(call, value: str):
            async with free:
                return await one_call(call, instructions, value, attempts, wait)

        async def all_of(call, values):
            return await asyncio.gather(*(one(call, v) for v in values))

        with asyncio.Runner() as loop:  # one loop for the client's whole life
            call = client()
            for batch in batches:
                found = loop.run(all_of(call, batch[text]))
                asked += len(found)
                errors += [e for _, e in found if e is not None]
                if asked >= PATIENCE and len(errors) > most_failed * asked:
                    raise CallsFailed(f"{len(errors)} of {asked} calls failed, the first with {errors[0]}")
                # an empty reply says nothing
                yield pd.DataFrame({key: batch[key], "reply": [r if r and not r.isspace() else None for r, _ in found]})

    return rows.select(key, text).mapInPandas(run, schema)


def named(name: str) -> Callable:
    """What ``package.module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def client_of(name: str, *args, **more) -> Callable[[], Callable[[str, str], Awaitable[str]]]:
    """A client's or tagger's factory by its name, looked up where it is called."""

    def make():
        return named(name)(*args, **more)

    return make


def isolated(load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A ``predict`` for ``tag_windows`` from a model's loader.

    ``load()`` is called once for each task and returns a function of one frame. A frame that it
    fails on is given to it row by row, and a row that it fails on gets no tags, so that only that
    document becomes an error record.
    """

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            try:
                yield model(frame)
                continue
            except Exception:
                parts = []
            for i in range(len(frame)):
                try:
                    found = model(frame.iloc[i : i + 1])
                    parts.append((found["tags"].iloc[0], found["scores"].iloc[0]))
                except Exception:
                    parts.append((None, None))
            yield pd.DataFrame(parts, columns=["tags", "scores"])

    return predict


def canned(replies: list[str]) -> Callable[[], Callable[[str, str], Awaitable[str]]]:
    """A stand-in for a language model: the reply depends on the length of the input."""

    def make():
        async def call(instructions: str, value: str) -> str:
            return replies[len(value) % len(replies)]

        return call

    return make


def stand_in():
    """A client without a model, to try the review's command line: code that calls ``eval`` is vulnerable."""

    async def call(instructions: str, value: str) -> str:
        if "eval(" not in value:
            return '{"verdict": "secure"}'
        return '{"verdict": "vulnerable", "cwe_id": "CWE-95", "mechanism": "evaluates its input", "fixed_code": "pass", "justification": "calls eval"}'

    return call


TRIAGE_INSTRUCTIONS = 'You are given source code. Judge whether it has a security weakness. Answer with one JSON object: {"verdict": "vulnerable" | "secure" | "uncertain"}.'
ANALYSIS_INSTRUCTIONS = 'You are given source code that may have a security weakness. Answer with one JSON object with the keys "verdict", "cwe_id" (such as CWE-79, or empty), "mechanism", "fixed_code" and "justification".'
