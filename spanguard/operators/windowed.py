"""A tagger over windows of text that are rows of their own: dealt evenly, in micro-batches, and folded again by document.

A document of any length is as many rows as it has windows, so a long one is spread over all
tasks and a model gets frames of so many windows, however they are spread over documents. What
the windows found is then put together: the spans of a document in order of (start, end) are one
list of overlapping windows' duplicates, folded as ``spans.merge_spans`` does. A span that begins
behind the ends of all before it can't meet any of them, so the list falls into chains that are
folded apart.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPAN_TYPE
from ..scratch import Scratch
from ..session import settings, ship
from .spans import merge_spans

#: Frames that an Arrow batch holds.
FRAMES = 8


def window_rows(docs: DataFrame, tokens: Callable[[Column], Column], size: int = 512, overlap: int = 64, key: str = "_row") -> DataFrame:
    """Rows ``key``, window, start (of its first token, in the whole text), part (the window's text) and places.

    Places are the tokens as pairs of the gap before one and its length, integers of as many bytes as the document's largest needs.
    """
    stride = size - overlap
    if stride <= 0:
        raise ValueError("the overlap must be smaller than the window")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, text, found in zip(b.column(key).to_pylist(), b.column("text"), b.column("_tokens")):
                text, found = text.as_py(), found.values
                starts, ends = (np.asarray(() if found is None else found.field(f).cast(pa.int32()), np.int32) for f in ("start", "end"))
                pairs = np.column_stack([np.diff(starts, prepend=0), ends - starts]).astype(np.int32)
                pairs[1:, 0] -= pairs[:-1, 1]
                pairs = pairs.astype(next(t for t in (np.int8, np.int16, np.int32) if not len(pairs) or np.iinfo(t).min <= pairs.min() and pairs.max() <= np.iinfo(t).max))
                for w in range(-(-max(len(starts) - size, 0) // stride) + 1):
                    x, y = w * stride, min(w * stride + size, len(starts))
                    start, end = (int(starts[x]), int(ends[y - 1])) if x < y else (0, 0)
                    out.append((k, w, start, text[start:end], pairs[x:y].tobytes(), pairs.itemsize))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names)

    names, kinds = [key, "window", "start", "part", "places", "bytes"], [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int32()]
    # a filter on tokens would find them once more
    rows = docs.where("text is not null").select(key, "text", tokens(F.col("text")).alias("_tokens"))
    return rows.mapInArrow(cut, f"{key} long, window int, start int, part string, places binary, bytes int")


def decoded(tags, scores, bounds: list[int], first: int) -> list[dict]:
    """What ``spans.decode_tags`` gives of one window: only tokens that carry a label are looked at, as any other closes what is open."""
    out, open_ = [], None
    for i, tag in enumerate(tags):
        if not tag or tag[0] == "O" or "-" not in tag or 2 * i >= len(bounds):
            continue
        kind, _, label = tag.partition("-")
        score = scores[i] if scores is not None and i < len(scores) else None
        score = None if score is None else float(score)
        start, end = first + bounds[2 * i], first + bounds[2 * i + 1]
        goes_on = open_ is not None and open_[0] == i and open_[1] == label
        if kind == "S" or kind == "E" and goes_on:
            n, total = (0, 0.0) if kind == "S" else (open_[3], open_[4])
            mean = None if score is None or total is None else score if kind == "S" else (total + score) / (n + 1)
            out.append({"label": label, "start": start if kind == "S" else open_[2], "end": end, "score": mean})
            open_ = None
        elif kind == "B":
            open_ = (i + 1, label, start, 1, score)
        elif kind == "I" and goes_on:
            open_ = (i + 1, label, open_[2], open_[3] + 1, None if score is None or open_[4] is None else open_[4] + score)
        else:
            open_ = None
    return out


def tag_rows(rows: DataFrame, predict: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], batch_size: int, key: str = "_row") -> DataFrame:
    """Rows ``key``, window, failed, spans of the windows that a model failed on or found something in; it gets frames of at most ``batch_size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: deque[list[tuple]] = deque()

        def frames() -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = list(zip(*(b.column(c).to_pylist() for c in (key, "window", "start", "part", "places", "bytes"))))
                for i in range(0, len(rows), batch_size):
                    held, pieces = [], []
                    for k, w, start, part, places, n in rows[i : i + batch_size]:
                        steps = np.frombuffer(places, f"i{n}")
                        bounds = (steps.cumsum(dtype=np.int64) - steps[:1].sum(dtype=np.int64)).tolist()  # the first gap lies before the part
                        held.append((k, w, start, bounds))
                        pieces.append([part[x:y] for x, y in zip(bounds[::2], bounds[1::2])])
                    waiting.append(held)
                    yield pd.DataFrame({"pieces": pd.Series(pieces, dtype=object)})

        for found in predict(frames()):
            held, out = waiting.popleft(), []
            if len(found) != len(held):
                raise ValueError(f"the model gave {len(found)} rows for {len(held)} windows")
            for (k, w, start, bounds), tags, scores in zip(held, found["tags"], found["scores"]):
                failed = not hasattr(tags, "__len__")
                spans = [] if failed else decoded(tags, scores if hasattr(scores, "__len__") else None, bounds, start)
                if failed or spans:
                    out.append((k, w, failed, spans))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [key, "window", "failed", "spans"])

    span = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.list_(span)]
    return rows.mapInArrow(run, f"{key} long, window int, failed boolean, spans {SPAN_TYPE}")


def fold_windows(found: DataFrame, key: str = "_row") -> DataFrame:
    """``key``, model_entities from rows ``key``, window, spans: the fold of all windows' spans, in chains."""
    rows = found.select(key, "window", F.posexplode("spans").alias("pos", "span")).withColumns({"start": F.col("span.start"), "end": F.col("span.end")})
    order = Window.partitionBy(key).orderBy("start", "end", "window", "pos")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("fresh", F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0))
    rows = rows.withColumn("chain", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "window", "pos", "span"))), lambda x: x["span"])
    chains = rows.groupBy(key, "chain").agg(spans.cast(SPAN_TYPE).alias("spans")).withColumn("spans", merge_spans(F.col("spans")))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chain", "spans"))), lambda x: x["spans"]))
    return chains.groupBy(key).agg(whole.alias("model_entities"))


def tag_documents(docs: DataFrame, tokens: Callable[[Column], Column], predict: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], size: int = 512, overlap: int = 64, batch_size: int = 32) -> DataFrame:
    """``docs`` with model_entities, the merged spans of all windows, and model_error.

    ``tokens`` gives the text's tokens (start, end). ``predict`` maps frames of windows (column
    ``pieces``, a list of tokens) to frames with their ``tags`` and ``scores`` (null where it failed), in order, and loads its
    model once for each task. A document of which a window failed has an error and no entities; one
    without text has neither. The windows' results are written to the shared folder, so a model runs once.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "windows")
    rows = scratch.save(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = window_rows(rows, tokens, size, overlap).repartition(n, F.xxhash64("_row", "window"))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=FRAMES * batch_size):
        found = scratch.save(tag_rows(each, predict, batch_size), "found")
    errors = found.where("failed").select("_row", F.lit(True).alias("_failed")).distinct()
    out = rows.join(fold_windows(found), "_row", "left").join(errors, "_row", "left")
    error, none = F.coalesce("_failed", F.lit(False)), F.array().cast(SPAN_TYPE)
    entities = F.when(error, none).otherwise(F.coalesce("model_entities", none))
    own = [c for c in docs.columns if c not in ("model_entities", "model_error")]
    return out.select(*own, entities.alias("model_entities"), error.alias("model_error"))
