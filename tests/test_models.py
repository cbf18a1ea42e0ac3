"""Windows as rows, paid calls with a ledger, the load contract and thresholds of the train split."""

import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from spanguard import cli
from spanguard.functions import text as T
from spanguard.operators import ledger, models, windowed
from spanguard.operators import spans as S
from spanguard.plans import pii, review

TOKENS = lambda text: T.find_spans(text, r"[^\x20\x09-\x0D]+", "T", 1.0)


def tags_of(pieces):
    """Names of one or two words; the score depends on the neighbours, so windows disagree."""
    out = []
    for i, p in enumerate(pieces):
        begun, goes_on = p.startswith("N") and not p.endswith("x"), i > 0 and pieces[i - 1].startswith("N") and not pieces[i - 1].endswith("x")
        out.append("B-name" if begun else "E-name" if p.endswith("x") and goes_on else "S-code" if p.isdigit() else "O")
    return out


def scores_of(pieces):
    return [0.5 + (len(p) + i) % 7 / 20 for i, p in enumerate(pieces)]


def by_window(frames):
    for f in frames:
        yield pd.DataFrame({"tags": [tags_of(p) for p in f["pieces"]], "scores": [scores_of(p) for p in f["pieces"]]})


def by_document(frames):
    for f in frames:
        yield pd.DataFrame({"tags": [[tags_of(w) for w in p] for p in f["pieces"]], "scores": [[scores_of(w) for w in p] for p in f["pieces"]]})


def random_text(r, n):
    return " ".join(r.choice(["Nat", "Nora", "alex", "maxx", "12", "7", "some", "words", "\n"]) for _ in range(n))


def test_window_rows_equal_the_fold(spark):
    """Documents of no, one and many windows, one of 10,000: the same spans as all windows of a document in one row give."""
    r = random.Random(3)
    texts = [None, "", "  ", "Nat maxx 12", *(random_text(r, r.randint(1, 90)) for _ in range(30)), random_text(r, 70_000)]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, window string").repartition(3)
    for c in ("pieces", "offsets", "model_error", "chain"):
        docs = docs.withColumn(c, F.lit("own"))
    got = windowed.tag_documents(docs, TOKENS, by_window, 8, 2, batch_size=16)
    rows = {x.doc_id: x for x in got.collect()}
    fold = models.tag_windows(docs.where("doc_id < 34").drop("model_error"), TOKENS, by_document, 8, 2).withColumn("m", S.merge_spans(F.flatten("model_spans")))
    want = {x.doc_id: x.m or [] for x in fold.collect()}
    assert all(rows[i].model_entities == want[i] and not rows[i].model_error and rows[i].window == "own" for i in want)
    # the long one against a loop, as one array would be folded for minutes
    words = [(s.start, s.end) for s in spark.createDataFrame([(texts[-1],)], "t string").select(TOKENS(F.col("t")).alias("s")).first().s]
    spans = []
    for w, a in enumerate(range(0, max(1, len(words) - 8 + 6), 6)):
        part = words[a : a + 8]
        pieces = [texts[-1][s:e] for s, e in part]
        tags, scores = tags_of(pieces), scores_of(pieces)
        for k, t in enumerate(tags):
            if t == "S-code":
                spans.append((*part[k], w, k, "code", scores[k]))
            elif t == "E-name" and tags[k - 1] == "B-name":
                spans.append((part[k - 1][0], part[k][1], w, k, "name", (scores[k - 1] + scores[k]) / 2))
    kept = []
    for start, end, _, _, label, score in sorted(spans):
        last = kept[-1] if kept else None
        if not last or last[2] != label or not (last[0] < end and start < last[1]):
            kept.append((start, end, label, score))
        elif (last[0], last[1]) == (start, end) and score > last[3]:
            kept[-1] = (start, end, label, score)
    assert w >= 9_998 and [(s.start, s.end, s.label, s.score) for s in rows[34].model_entities] == kept


def test_words_read_off_bytes_equal_the_pattern(spark):
    r = random.Random(4)
    texts = [None, "", " ", "a", " \t\n\x0b\f\r", "\x08\x0e\x1c\x85\xa0", "é ß\n中文 😀x  ", *("".join(r.choices(" \t\n\ra1é中😀\u2003", k=r.randint(1, 60))) for _ in range(200))]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    places = F.coalesce(T.word_spans("t"), F.array().cast("array<struct<start:int,end:int>>"))
    for x in docs.select("t", places.alias("a"), TOKENS(F.col("t")).alias("b")).collect():
        assert [(s.start, s.end) for s in x.a] == [(s.start, s.end) for s in x.b], x.t


def test_windows_hold_few_bytes_a_token(spark):
    """A window's text and two bytes a token are dealt, not two arrays of offsets; a wide gap or a long token costs its document more."""
    texts = [random_text(random.Random(2), 3_000), "a " * 20 + " " * 300 + "b " * 20, "a " * 20 + "b" * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "_row long, text string")
    rows = windowed.window_rows(docs, T.word_spans, 8, 2).collect()
    assert {r.bytes for r in rows if r._row == 0} == {1} and max(len(r.places) for r in rows if r._row == 0) == 16
    assert {r.bytes for r in rows if r._row == 1} == {2} and {r.bytes for r in rows if r._row == 2} == {4}
    assert all(r.part == texts[r._row][r.start : r.start + len(r.part)] for r in rows)


def test_any_tags_are_decoded_as_by_the_fold(spark):
    def odd(pieces, k):
        r = random.Random(f"{k}{''.join(pieces)}")
        return r.choices(["O", "O-a", "", None, "x", "B-a", "I-a", "E-a", "S-a", "B-b", "I-b-c", "E-b", "S-b", "X-a", "-a"], [2, 1, 1, 1, 1, 6, 6, 6, 2, 3, 1, 3, 1, 1, 1], k=len(pieces) - k)

    def by_rows(of):
        def predict(frames):
            for f in frames:
                yield pd.DataFrame({"tags": [of(p, odd) for p in f["pieces"]], "scores": [of(p, lambda q, k: [i % 4 / 4 for i in range(len(q))]) for p in f["pieces"]]})

        return predict

    docs = spark.createDataFrame([(i, random_text(random.Random(i), 6)) for i in range(120)], "doc_id long, text string")
    short = lambda p, f: f(list(p), 0 if len(p) < 3 else 1)
    got = {r.doc_id: r.model_entities for r in windowed.tag_documents(docs, T.word_spans, by_rows(short), 8, 2).collect()}
    fold = models.tag_windows(docs, TOKENS, by_rows(lambda p, f: [short(w, f) for w in p]), 8, 2).withColumn("m", S.merge_spans(F.flatten("model_spans")))
    assert got == {r.doc_id: r.m for r in fold.collect()} and sum(map(len, got.values())) > 50


def test_windows_are_dealt_over_tasks(spark, tmp_path):
    def predict(frames):
        for f in frames:
            with open(f"{tmp_path}/{TaskContext.get().partitionId()}", "a") as out:
                out.write(f"{len(f)}\n")
            yield from by_window([f])

    docs = spark.createDataFrame([(1, random_text(random.Random(1), 4_000))], "doc_id long, text string")
    conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    windowed.tag_documents(docs, TOKENS, predict, 8, 2, batch_size=10).collect()
    sizes = [[int(x) for x in open(f"{tmp_path}/{p}")] for p in os.listdir(tmp_path)]
    assert len(sizes) == 4 and min(map(sum, sizes)) > 100 and max(x for s in sizes for x in s) == 10
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == conf


def test_a_failed_window_is_its_documents_error(spark):
    def load():
        def model(frame):
            if any("boom" in p for p in frame["pieces"]):
                raise ValueError("boom")
            return next(by_window([frame]))

        return model

    docs = spark.createDataFrame([("a", "12 two " * 20), ("b", "12 " * 30 + "boom 7"), ("c", None)], "uid string, text string")
    tagger = lambda d: windowed.tag_documents(d, TOKENS, models.isolated(load), 8, 2, batch_size=4)
    out = {r.doc_id: r for r in pii.anonymize(docs, tagger=tagger).collect()}
    assert [out[k].metadata.error for k in "abc"] == [False, True, True] and len(out["a"].entities) == 20 and out["b"].entities == []


def test_a_call_before_loading_raises(spark):
    docs = spark.createDataFrame([("a", "12 two")], "uid string, text string")
    run = pii.Anonymizer(lambda: lambda d: windowed.tag_documents(d, TOKENS, by_window, 8, 2))
    with pytest.raises(RuntimeError, match="load"):
        run(docs)
    assert not run.loaded and run.load().loaded and run(docs).first().entities[0].label == "code"


# ---- paid calls


def paying(folder, **how):
    """A client that leaves a file for each call; ``how``: failing texts and what they raise."""

    def client():
        async def call(instructions, value):
            with open(f"{folder}/{value}-{time.time_ns()}", "w"):
                pass
            if value in how.get("kill", ()) and not os.path.exists(f"{folder}/killed"):
                open(f"{folder}/killed", "w").close()
                os._exit(1)
            if value in how.get("later", ()):
                raise models.RetryLater("busy")
            if value in how.get("bad", ()):
                raise KeyError(value)
            return f"re {value}" if value != "blank" else " \n"

        return call

    return client


def calls_in(folder):
    return sorted(f.rpartition("-")[0] for f in os.listdir(folder) if "-" in f)


def test_nothing_is_asked_twice(spark, tmp_path):
    paid = tmp_path / "paid"
    paid.mkdir()
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(60)] + [(60, None), (61, "blank"), (1, "t1")], "unique_id long, code string")
    book = ledger.Ledger(spark, f"{tmp_path}/ledger")
    first = ledger.ask_once(rows.where("unique_id < 20"), paying(paid), "x", book, concurrency=3)
    assert {r.unique_id: r.reply for r in first.collect()} == {i: f"re t{i}" for i in range(20)} and len(calls_in(paid)) == 20
    for _ in range(2):
        out = {r.unique_id: r.reply for r in ledger.ask_once(rows, paying(paid), "x", book, concurrency=3).collect()}
        assert out == {i: f"re t{i}" for i in range(60)} | {60: None, 61: None}
    assert calls_in(paid) == sorted([f"t{i}" for i in range(60)] + ["blank"])
    ledger.ask_once(rows.where("unique_id = 5"), paying(paid), "other words", book)
    assert calls_in(paid).count("t5") == 2


def test_a_killed_task_goes_on_where_it_was(tmp_path):
    """In a cluster of its own, as a task is tried again there: the worker dies in the middle of its calls."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path[:0] = {[os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]!r}
from pyspark.sql import SparkSession
from tests.test_models import paying
from spanguard.operators import ledger
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
rows = spark.createDataFrame([(i, f"t{{i}}") for i in range(30)], "unique_id long, code string")
out = ledger.ask_once(rows, paying({str(tmp_path / "paid")!r}, kill=["t17"]), "x", ledger.Ledger(spark, {str(tmp_path / "ledger")!r}), concurrency=2)
assert {{r.unique_id: r.reply for r in out.collect()}} == {{i: f"re t{{i}}" for i in range(30)}}
"""
    (tmp_path / "paid").mkdir()
    subprocess.run([sys.executable, "-c", code], check=True, timeout=240, capture_output=True)
    # the call that died had no reply and is made again; no other is
    assert calls_in(tmp_path / "paid") == sorted([f"t{i}" for i in range(30)] + ["t17"])


def test_a_task_holds_few_texts_at_once(spark, tmp_path):
    """However many rows a task has, a bounded number of calls is made ready at once."""

    def client():
        import asyncio

        async def call(instructions, value):
            with open(f"{tmp_path}/{value}", "w") as out:
                out.write(str(len(asyncio.all_tasks())))
            return "said"

        return call

    rows = spark.range(3_000).select(F.col("id").alias("unique_id"), F.concat(F.lit("t"), F.col("id")).alias("code"))
    conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = ledger.ask_once(rows, client, "x", ledger.Ledger(spark, f"{tmp_path}/ledger"), concurrency=2)
    ready = [int((tmp_path / f"t{i}").read_text()) for i in range(3_000)]
    assert max(ready) <= ledger.ROWS + 1 and out.where("reply = 'said'").count() == 3_000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == conf


def test_calls_at_once_are_bounded_over_tasks(spark, tmp_path):
    def client():
        import asyncio

        async def call(instructions, value):
            name = f"{tmp_path}/now-{value}"
            open(name, "w").close()
            seen = len([f for f in os.listdir(tmp_path) if f.startswith("now-")])
            await asyncio.sleep(0.02)
            os.remove(name)
            return str(seen)

        return call

    rows = spark.createDataFrame([(i, f"t{i}") for i in range(80)], "unique_id long, code string").repartition(20)
    for bound in (1, 3, 6):
        book = ledger.Ledger(spark, f"{tmp_path}/ledger{bound}")
        seen = [int(r.reply) for r in ledger.ask_once(rows, client, "x", book, concurrency=bound).collect()]
        assert max(seen) <= bound and len(seen) == 80


def test_failures_are_kept_counted_and_asked_again(spark, tmp_path):
    paid = tmp_path / "paid"
    paid.mkdir()
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "unique_id long, code string")
    book = ledger.Ledger(spark, f"{tmp_path}/ledger")
    how = {"later": ["t1"], "bad": ["t2"]}
    out = {r.unique_id: r.reply for r in ledger.ask_once(rows, paying(paid, **how), "x", book, wait=(0.0, 0.0)).collect()}
    assert out == {i: None if i in (1, 2) else f"re t{i}" for i in range(40)}
    assert calls_in(paid).count("t1") == 3 and calls_in(paid).count("t2") == 1
    assert {(r.key, r.error) for r in book.lines().where("error is not null").collect()} == {("1", "RetryLater: busy"), ("2", "KeyError: 't2'")}
    out = {r.unique_id: r.reply for r in ledger.ask_once(rows, paying(paid), "x", book).collect()}
    assert out[1] == "re t1" and out[2] == "re t2" and len(calls_in(paid)) == 40 + 2 + 2
    bad = spark.createDataFrame([(i, f"t{i}") for i in range(100, 400)], "unique_id long, code string")
    with pytest.raises(ledger.CallsFailed, match="KeyError"):
        ledger.ask_once(bad, paying(paid, bad=[f"t{i}" for i in range(100, 400)]), "x", book, concurrency=1)
    assert len(calls_in(paid)) < 44 + 100  # it gave up early


@pytest.mark.parametrize("wait, want", [((1.0, 10.0), [1, 2, 4, 8, 10]), ((2.0, 15.0), [2, 2, 4, 8, 15]), ((0.0, 0.0), [0, 0, 0, 0, 0])])
def test_pauses(wait, want):
    assert [ledger.pause(k, wait) for k in range(5)] == want


def test_paid_cascade_and_settings(spark, tmp_path):
    seen = []

    def client(stage):
        seen.append(stage)

        async def call(instructions, value):
            return json.dumps({"verdict": "vulnerable" if "eval" in value else "secure", "cwe_id": "CWE-95", "fixed_code": str(stage.max_output_tokens)})

        return call

    code = spark.createDataFrame([(1, "eval(x)"), (2, "print(x)"), (3, "eval(y)")], "unique_id long, code string")
    known = spark.createDataFrame([("CWE-95",)], "cwe_id string")

    def between(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    out = review.run_cascade(code, client, known, f"{tmp_path}/ledger", between)
    assert {(r.unique_id, r.verdict, r.fixed_code) for r in out.collect()} == {(1, "vulnerable", "2000"), (2, "secure", ""), (3, "vulnerable", "2000")}
    s = review.ReviewSettings().sampled(2)
    assert (s.triage.concurrency, s.analysis.attempts, s.sample) == (1, 1, 2) and s.analysis.wait == (2.0, 15.0) and s.triage.temperature == 0.0
    assert review.run_cascade(code, client, known, f"{tmp_path}/ledger", between, s).count() == 2


# ---- thresholds


def test_thresholds_are_the_train_splits(spark, tmp_path):
    """They don't change when the labels of the test split do, and without a train split there are none."""
    r = random.Random(6)
    rows = [(i, f"text {i}", r.random(), r.choice([0, 1, 2]), "train" if i % 2 else "test") for i in range(200)]
    schema, found = "row_id int, text string, p1 double, label int, split string", []
    for k in range(2):
        spark.createDataFrame([(i, t, p, (lab + k) % 3 if s == "test" else lab, s) for i, t, p, lab, s in rows], schema).write.parquet(f"{tmp_path}/in{k}")
        out = cli.main(["guard", "--input", f"{tmp_path}/in{k}", "--output-dir", f"{tmp_path}/out{k}", "--calibrate", "--evaluate"])
        assert out["total"] == 100
        found.append((out["t_low"], out["t_high"], out["metrics"]["tp"]))
    assert found[0][:2] == found[1][:2] and found[0][2] != found[1][2]
    spark.createDataFrame([x[:4] for x in rows], schema.rpartition(",")[0]).write.parquet(f"{tmp_path}/none")
    with pytest.raises(SystemExit):
        cli.main(["guard", "--input", f"{tmp_path}/none", "--output-dir", f"{tmp_path}/o", "--calibrate"])
