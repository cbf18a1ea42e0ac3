"""Ordered folds over the spans of a document, as array expressions: no shuffle, one row a document."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import fixed_values as V
from ..functions.text import SPAN_TYPE, card_spans, email_spans, phone_spans
from .fuzzy import cluster_forms


def regex_spans(text: Column, existing: Column | None = None) -> Column:
    """E-mail, phone and card spans in this order; those inside an existing span are left out.

    Only ``existing`` spans cover others, so found spans may overlap each other.
    """
    found = F.concat(email_spans(text), phone_spans(text), card_spans(text))
    return found if existing is None else uncovered(found, existing)


def uncovered(found: Column, existing: Column) -> Column:
    return F.filter(found, lambda s: ~F.exists(existing, lambda m: (s["start"] >= m["start"]) & (s["end"] <= m["end"])))


def sort_by_start(spans: Column) -> Column:
    """By start; of equal starts in the order given."""
    keyed = F.transform(spans, lambda s, i: F.struct(s["start"].alias("o"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def sort_by_bounds(spans: Column) -> Column:
    keyed = F.transform(spans, lambda s, i: F.struct(s["start"].alias("o"), s["end"].alias("e"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def action(label: Column, score: Column, least=V.MIN_SCORE, high=V.HIGH_CONFIDENCE, risky=tuple(V.HIGH_RISK_LABELS)) -> Column:
    """replace, mask or skip; both bounds are inclusive."""
    return F.when(score >= high, "replace").when(score >= least, F.when(label.isin(*risky), "mask").otherwise("replace")).otherwise("skip")


def windows(n: Column, size: int = 512, overlap: int = 64) -> Column:
    """Token windows (token_start, token_end) of ``n`` tokens."""
    stride = size - overlap
    if stride <= 0:
        raise ValueError("the overlap must be smaller than the window")
    last = (F.ceil(F.greatest(n - size, F.lit(0)) / stride) * stride).cast("int")
    return F.transform(F.sequence(F.lit(0), last, F.lit(stride)), lambda s: F.struct(s.alias("token_start"), F.least(s + size, n).cast("int").alias("token_end")))


def window_bounds(window: Column, offsets: Column, text_length: Column) -> Column:
    """Characters of a window: its first and last token that has any, else the whole text."""
    own = F.filter(F.slice(offsets, window["token_start"] + 1, window["token_end"] - window["token_start"]), lambda o: o["start"] != o["end"])
    return F.struct(F.coalesce(F.get(own, F.lit(0))["start"], F.lit(0)).alias("char_start"), F.coalesce(F.try_element_at(own, F.lit(-1))["end"], text_length).alias("char_end"))


def tag_parts(tag: Column) -> Column:
    """Struct (kind, label); O, and what has no dash, is outside."""
    dashed = F.contains(tag, F.lit("-")) & ~F.startswith(tag, F.lit("O"))
    return F.struct(F.when(dashed, F.substring_index(tag, "-", 1)).otherwise("O").alias("kind"), F.when(dashed, F.substring(tag, F.instr(tag, "-") + 1, F.length(tag))).otherwise("").alias("label"))


def decode_tags(tokens: Column) -> Column:
    """Spans of tokens (tag, start, end, score): singles, and begin, inside and end of one label.

    A span's score is its tokens' mean. Whatever breaks an open span drops it.
    """
    state = "struct<open:boolean,label:string,start:int,sum:double,n:int,out:" + SPAN_TYPE + ">"
    closed = lambda out: F.struct(F.lit(False).alias("open"), F.lit("").alias("label"), F.lit(0).alias("start"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), out.alias("out")).cast(state)
    span = lambda label, start, end, score: F.array(F.struct(label.alias("label"), start.alias("start"), end.alias("end"), score.alias("score")))

    def step(a: Column, t: Column) -> Column:
        kind, label = t["part"]["kind"], t["part"]["label"]
        goes_on = a["open"] & (a["label"] == label)
        begun = F.struct(F.lit(True).alias("open"), label.alias("label"), t["start"].alias("start"), t["score"].alias("sum"), F.lit(1).alias("n"), a["out"].alias("out")).cast(state)
        grown = F.struct(F.lit(True).alias("open"), a["label"].alias("label"), a["start"].alias("start"), (a["sum"] + t["score"]).alias("sum"), (a["n"] + 1).alias("n"), a["out"].alias("out")).cast(state)
        done = closed(F.concat(a["out"], span(a["label"], a["start"], t["end"], (a["sum"] + t["score"]) / (a["n"] + 1))))
        single = closed(F.concat(a["out"], span(label, t["start"], t["end"], t["score"])))
        return F.when(kind == "S", single).when(kind == "B", begun).when((kind == "I") & goes_on, grown).when((kind == "E") & goes_on, done).otherwise(closed(a["out"]))

    parsed = F.transform(tokens, lambda t: F.struct(tag_parts(t["tag"]).alias("part"), t["start"].cast("int").alias("start"), t["end"].cast("int").alias("end"), t["score"].cast("double").alias("score")))
    return F.aggregate(parsed, closed(F.array().cast(SPAN_TYPE)), step, lambda a: a["out"])


def merge_spans(spans: Column) -> Column:
    """One list from the spans of overlapping windows.

    In order of (start, end), a span meets the last one kept: of the same label and overlapping,
    the outer one stays, else the one of higher score, the earlier on ties.
    """
    ordered = sort_by_bounds(spans)

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        meet = F.coalesce((last["label"] == s["label"]) & (last["start"] < s["end"]) & (s["start"] < last["end"]), F.lit(False))
        same = (last["start"] == s["start"]) & (last["end"] == s["end"])
        outer, inner = (last["start"] <= s["start"]) & (last["end"] >= s["end"]), (s["start"] <= last["start"]) & (s["end"] >= last["end"])
        better = s["score"] > last["score"]
        swap = F.when(same, better).when(outer, F.lit(False)).when(inner, F.lit(True)).otherwise(better)
        swapped = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(s))
        return F.when(~meet, F.concat(acc, F.array(s))).when(swap, swapped).otherwise(acc)

    return F.aggregate(ordered, F.array().cast(SPAN_TYPE), step)


def best_of_each(spans: Column) -> Column:
    """The highest score of each (label, start, end), the first on ties, by start."""
    key = lambda s, i: F.struct(s["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"), (-s["score"]).alias("score"), i.alias("i"))
    ranked = F.array_sort(F.transform(spans, lambda s, i: F.struct(key(s, i).alias("k"), s.alias("s"))))
    same = lambda a, b: (a["label"] == b["label"]) & (a["start"] == b["start"]) & (a["end"] == b["end"])
    firsts = F.filter(F.transform(ranked, lambda r, i: F.struct(r.alias("r"), F.get(ranked, i - 1).alias("last"))), lambda x: x["last"].isNull() | ~same(x["r"]["k"], x["last"]["k"]))
    # of equal starts in the order in which they first came
    order = F.array_sort(F.transform(firsts, lambda x: F.struct(x["r"]["s"]["start"].alias("o"), x["r"]["k"]["i"].alias("i"), x["r"]["s"].alias("s"))))
    return F.transform(order, lambda x: x["s"])


def resolve_overlaps(spans: Column) -> Column:
    """An extension: of overlapping spans the longest stays, then the best, then the first."""
    ranked = F.transform(F.array_sort(F.transform(spans, lambda s, i: F.struct((s["start"] - s["end"]).alias("o"), (-s["score"]).alias("b"), i.alias("i"), s.alias("s")))), lambda k: k["s"])
    kept = F.aggregate(ranked, F.array().cast(SPAN_TYPE), lambda acc, s: F.when(F.exists(acc, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), acc).otherwise(F.concat(acc, F.array(s))))
    return sort_by_start(kept)


def fuzzy_clusters(threshold: float = 0.8):
    """A column function: the first leader that is similar enough, or itself, for each of an array of names; see ``fuzzy`` for tables."""

    @F.pandas_udf(ArrayType(StringType()))
    def cluster(names: pd.Series, normalized: pd.Series) -> pd.Series:
        def one(values, norms):
            return [values[i] for i in cluster_forms([" ".join(sorted(n.split())) for n in norms], threshold)]

        return pd.Series([None if v is None else one(list(v), list(n)) for v, n in zip(names, normalized)])

    return cluster
