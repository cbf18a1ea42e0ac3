"""Replies of a language model: the JSON object in them, verdicts, weakness ids."""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from . import fixed_values as V
from .text import BLANK, let

FIELDS = ("verdict", "cwe_id", "mechanism", "fixed_code", "justification")
#: Types are objects, as a worker that loads this module can't parse them from text.
TRIAGE = StructType([StructField("verdict", StringType()), StructField("parse_error", BooleanType())])
ANALYSIS = StructType([*(StructField(f, StringType()) for f in FIELDS), StructField("parse_error", BooleanType())])
SPANS = ArrayType(StructType([StructField("label", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_FENCE, _BRACES = re.compile(V.FENCE_PATTERN, re.S), re.compile(V.BRACES_PATTERN, re.S)


def reply_object(text: str | None) -> dict | None:
    """The JSON object of a reply: in a fence, then from the first to the last brace; else None."""
    if text is None:
        return None
    text = text.strip()
    fenced = _FENCE.search(text)
    if fenced:
        text = fenced[1].strip()
    braced = _BRACES.search(text)
    try:
        found = json.loads(braced[0] if braced else text)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _text(value) -> str:
    """A field as text; half a surrogate pair, which no column can hold, becomes a question mark."""
    return str(value).strip().encode("utf-8", "replace").decode()


def _verdict(value) -> str:
    return _text(value).lower()


@F.pandas_udf(TRIAGE)
def _triage_in_python(texts: pd.Series) -> pd.DataFrame:
    out = []
    for t in texts:
        found = reply_object(t)
        v = _verdict(found.get("verdict", "")) if found is not None else ""
        out.append((v, False) if v in V.VERDICTS else ("uncertain", True))
    return pd.DataFrame(out, columns=["verdict", "parse_error"])


@F.pandas_udf(ANALYSIS)
def _analysis_in_python(texts: pd.Series) -> pd.DataFrame:
    out = []
    for t in texts:
        found = reply_object(t)
        if found is None:
            out.append(("uncertain", "", "", "", "", True))
            continue
        v = _verdict(found.get("verdict", "vulnerable"))
        out.append((v if v in V.VERDICTS else "uncertain", *(_text(found.get(f, "")) for f in FIELDS[1:]), False))
    return pd.DataFrame(out, columns=[*FIELDS, "parse_error"])


#: Fixed value: what both readers of JSON may take differently (lone surrogates, endless numbers, separators).
_ODD = r"\\u[dD][89a-fA-F]|[0-9]{300}|[\x1c-\x1f]"


def _stripped(value: Column) -> Column:
    return F.regexp_replace(value, f"^{BLANK}|{BLANK}$", "")


def _braced(text: Column) -> Column:
    """What stands between the first and the last brace, in a fence if there is one; empty if nothing does."""
    fenced = r"(?sU)" + V.FENCE_PATTERN
    inner = F.when(text.rlike(fenced), F.regexp_extract(text, fenced, 1)).otherwise(text)
    return F.regexp_extract(inner, "(?s)" + V.BRACES_PATTERN, 0)


def _read(text: Column, fields: tuple[str, ...]) -> Column:
    """Struct (state, fields) of a reply: ``object`` with the fields' strings, null where missing, ``error`` without an object, or null: not decided.

    An object is decided on only if it ends where the text does (a parser that stops at its end doesn't tell, so it is parsed
    as an array's only element and as an object's value), no name stands twice and the fields are strings.
    """

    def of(body: Column) -> Column:
        both = F.struct(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).alias("a"), F.try_parse_json(F.concat(F.lit('{"r":'), body, F.lit("}"))).alias("o"))

        def parsed(x: Column) -> Column:
            kind = lambda path: F.schema_of_variant(F.try_variant_get(x["a"], path, "variant"))
            plain = lambda f: F.coalesce(kind(f"$[0].{f}") == "STRING", F.lit(True))
            sure = x["o"].isNotNull() & kind("$[1]").isNull() & kind("$[0]").startswith("OBJECT")
            for f in fields:
                sure = sure & plain(f)
            values = [F.try_variant_get(x["a"], f"$[0].{f}", "string").alias(f) for f in fields]
            return F.when(F.coalesce(sure, F.lit(False)), F.struct(F.lit("object").alias("state"), *values))

        none = F.struct(F.lit("error").alias("state"), *[F.lit(None).cast("string").alias(f) for f in fields])
        return F.when(body == "", none).when(~text.rlike(_ODD), let(both, parsed))

    return F.when(text.isNotNull(), let(_braced(text), of))


def triage_reply(text: Column | str) -> Column:
    """A first-stage reply: its verdict, or uncertain with an error. Python reads only what Spark's own parser leaves open."""
    text = F.col(text) if isinstance(text, str) else text

    def decided(x: Column) -> Column:
        v = F.lower(_stripped(F.coalesce(x["verdict"], F.lit(""))))
        good = (x["state"] == "object") & v.isin(*V.VERDICTS)
        own = F.struct(F.when(good, v).otherwise("uncertain").alias("verdict"), (~good).alias("parse_error"))
        return F.struct(F.when(x["state"].isNotNull(), own).alias("r"))

    native = let(_read(text, FIELDS[:1]), decided)["r"]
    return F.coalesce(native, _triage_in_python(F.when(native.isNull(), text)))


def analysis_reply(text: Column | str) -> Column:
    """A second-stage reply; without a verdict it is vulnerable, with an unknown one uncertain."""
    text = F.col(text) if isinstance(text, str) else text

    def decided(x: Column) -> Column:
        v = F.lower(_stripped(F.coalesce(x["verdict"], F.lit("vulnerable"))))
        good = x["state"] == "object"
        verdict = F.when(good & v.isin(*V.VERDICTS), v).otherwise("uncertain")
        rest = [F.when(good, _stripped(F.coalesce(x[f], F.lit("")))).otherwise("").alias(f) for f in FIELDS[1:]]
        own = F.struct(verdict.alias("verdict"), *rest, (~good).alias("parse_error"))
        return F.struct(F.when(x["state"].isNotNull(), own).alias("r"))

    native = let(_read(text, FIELDS), decided)["r"]
    return F.coalesce(native, _analysis_in_python(F.when(native.isNull(), text)))


def read_natively(text: Column, fields: tuple[str, ...] = FIELDS) -> Column:
    """Whether a reply is decided without Python, for a report of the share."""
    return _read(text, fields).isNotNull()


def cwe_reason(cwe_id: Column, known: Column) -> Column:
    """Why an id isn't valid, or the empty string; ``known``: whether the dictionary has it."""
    return F.when(cwe_id.isNull() | (cwe_id == ""), "empty").when(~cwe_id.rlike(V.CWE_PATTERN), "bad_format").when(~F.coalesce(known, F.lit(False)), "not_in_dict").otherwise("")


def span_literal(text: str | None) -> list[dict] | None:
    """Spans given as a Python literal or as JSON; None if neither can be read."""
    if text is None:
        return None
    for read in (ast.literal_eval, json.loads):
        try:
            found = read(text)
            if isinstance(found, list) and all(isinstance(s, dict) for s in found):
                return found
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
    return None


@F.pandas_udf(SPANS)
def parse_spans(texts: pd.Series) -> pd.Series:
    def one(text):
        found = span_literal(text)
        return None if found is None else [{"label": s.get("label"), "start": s.get("start"), "end": s.get("end")} for s in found]

    return texts.map(one)
