"""Replies read by Spark's own parser against the reader in Python, on texts of every kind."""

import json
import random

import pytest
from pyspark.sql import functions as F

from spanguard.functions import fixed_values as V
from spanguard.functions import replies as R

HARD = [
    None, "", " ", "{}", "[]", "5", "null", '"secure"', "secure", "{", "}", "}{", "{}}", "{{}", '{"verdict": "secure"}', '{"verdict": "SECURE "}', '{"verdict": "\\u00a0secure\\u3000"}', '{"verdict": "secure"} and {"verdict": "vulnerable"}', '{"verdict": "secure"},{"verdict": "vulnerable"}',
    '{"verdict": "secure"}],[{"a": 1}', '{"verdict": "secure"},"k": {"a": 1}', '{"verdict": "secure"}}', '{"verdict": "secure", "verdict": "vulnerable"}', '{"verdict": null}', '{"verdict": true}', '{"verdict": 1.0}', '{"verdict": ["secure"]}', '{"verdict": {"a": "secure"}}', '{"Verdict": "secure"}', '{"verdict": "unknown"}',
    "```json\n{\"verdict\": \"secure\"}\n```", "```\n{\"verdict\": \"secure\"}```", "text ```json {\"verdict\": \"uncertain\"} ``` more {\"verdict\": \"secure\"}", "``` nothing ``` {\"verdict\": \"secure\"}", "```json\n[1]\n```", "```{\"verdict\": \"secure\"", "{'verdict': 'secure'}", '{"verdict": "secure",}', '{verdict: "secure"}', '{"verdict": "secure" /* c */}',
    '{"cwe_id": "CWE-79", "fixed_code": "x\\n\\ty"}', '{"cwe_id": 79, "verdict": "vulnerable"}', '{"verdict": "vulnerable", "mechanism": null}', '{"mechanism": "\\ud83d\\ude00 \\ud800"}', '{"mechanism": "\\ud83d\\ude00"}', '{"justification": "a\tb"}', '{"justification": "\x1f"}', '{"justification": "a b\\u0085"}', '{"n": NaN}', '{"n": Infinity, "verdict": "secure"}',
    '{"n": 1e999, "verdict": "secure"}', '{"n": ' + "9" * 5000 + "}", '{"n": 01}', '{"a": ' + "[" * 2000 + "]" * 2000 + "}", '{"a": ' + "[" * 200000 + "]" * 200000 + "}", '﻿{"verdict": "secure"}', '{"verdict": "ſecure"}', '{"verdict": "secure\\u0000"}', "{\n}\n", '{"": "x", "verdict": "secure"}', '{"a.b": "x", "verdict": " \\u001csecure\\u001d "}', '{"verdict": "secure"}\x1c',
]


def expected(text):
    found = R.reply_object(text)
    v = str(found.get("verdict", "")).strip().lower() if found is not None else ""
    first = (v, False) if v in V.VERDICTS else ("uncertain", True)
    if found is None:
        return first, ("uncertain", "", "", "", "", True)
    w = str(found.get("verdict", "vulnerable")).strip().lower()
    return first, (w if w in V.VERDICTS else "uncertain", *(str(found.get(f, "")).strip().encode("utf-8", "replace").decode() for f in R.FIELDS[1:]), False)


def test_native_replies_equal_python(spark):
    r = random.Random(2)
    pieces = ['{"verdict": "secure"', '"cwe_id": "CWE-1"', '"mechanism": 5', ", ", "}", "{", "```", "json", "\n", '"', ": ", "\\", "[", "]", " text ", '"verdict": "vulnerable"', "é😀"]
    texts = HARD + ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(1500)]
    values = ["secure", " Vulnerable", "x", None, 3, ["a"], "uncertain\n", "é ", ""]
    for _ in range(300):
        body = json.dumps({f: r.choice(values) for f in r.sample(R.FIELDS, r.randint(0, 5))} | {"other": [1, {"a": None}]}, ensure_ascii=r.random() < 0.5)
        texts.append(r.choice(["", "so: ", "```json\n", "```"]) + body + r.choice(["", " done", "\n```", "}"]))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = {x.i: (tuple(x.a), tuple(x.b)) for x in df.select("i", R.triage_reply(F.col("t")).alias("a"), R.analysis_reply("t").alias("b")).collect()}
    wrong = [(t, got[i], expected(t)) for i, t in enumerate(texts) if got[i] != expected(t)]
    assert not wrong, wrong[:3]


def test_most_replies_need_no_python(spark):
    """Well formed replies are read natively, all of them."""
    texts = [json.dumps({"verdict": V.VERDICTS[i % 3], "cwe_id": f"CWE-{i}", "fixed_code": "f(x)\n" * (i % 5)}) for i in range(300)]
    texts = [t if i % 3 else f"Here it is:\n```json\n{t}\n```" for i, t in enumerate(texts)] + ["no object at all"] * 20
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.agg(F.avg(R.read_natively(F.col("t")).cast("int")).alias("share")).first().share == 1.0


@pytest.mark.parametrize("text", ['{"verdict": 1}', '{"verdict": "secure", "verdict": "secure"}', '{"verdict": "secure"} {}'])
def test_what_is_left_to_python(spark, text):
    assert not spark.createDataFrame([(text,)], "t string").select(R.read_natively(F.col("t")).alias("n")).first().n
