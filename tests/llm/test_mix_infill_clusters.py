"""Mixing, fill-in-the-middle and centroid clustering against brute force and exact round trips."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.test_operators import HARD, prose

from spanguard.llm import clusters, infill, mixing
from spanguard.llm.common import Scratch, numbered

# ---- mixing


def targets_by_force(words):
    """Shares by weight, bounded, the excess shared anew; ``words`` by source in order."""
    total, target = sum(words), [0.0] * len(words)
    weight, bounded = [i % 3 + 1 for i in range(len(words))], set()
    while True:
        free = [i for i in range(len(words)) if i not in bounded]
        left = total - sum(3 * words[i] for i in bounded)
        target = [3.0 * w if i in bounded else left * weight[i] / sum(weight[j] for j in free) for i, w in enumerate(words)]
        over = {i for i in free if target[i] > 3 * words[i]}
        if not over:
            return target
        bounded |= over


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def sources(spark):
    r = random.Random(5)
    rows = [(i, prose(r, r.randint(0, 60)), f"s{i % 7}") for i in range(600)] + [(600 + i, t, None) for i, t in enumerate(HARD)]
    rows += [(700 + i, prose(r, 30), "hot") for i in range(400)] + [(2000, "one two", "tiny"), (2001, None, "no words"), (2002, "  \t lead and trail \n", "Ünï"), (None, "a b c d e", "s1"), (None, "a b c d e", "s1")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(sources):
    rows, docs = sources
    got = mixing.plan_mix(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, count(t)) for i, t, _ in rows)
    words, taken = collections.Counter(), collections.Counter()
    for r in got:
        words[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    order = sorted(words, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, targets_by_force([words[s] for s in order])))
    for r in got:
        assert r.source_size == words[r.source] and r.target == pytest.approx(want[r.source])
    assert all(taken[s] == math.floor(want[s] + 1e-6) for s in order if s != "s1") and abs(taken["s1"] - want["s1"]) <= 2
    assert want["tiny"] == 6 and taken["tiny"] == 6 and want["no words"] == 0


def test_mix_depends_on_rows_alone(sources, monkeypatch):
    _, docs = sources
    rows = lambda df: sorted(map(str, df.collect()))
    first = rows(mixing.plan_mix(docs))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows(mixing.plan_mix(docs.repartition(7, "text"))) == first
    assert rows(mixing.plan_mix(docs, seed=12)) != first


def test_mixed_corpus(sources):
    rows, docs = sources
    for c in ("doc", "_key", "_size", "cut_key", "words", "last", "whole", "epoch", "mix_epoch"):
        docs = docs.withColumn(c, F.lit("own"))
    plan = {r.doc_id: r for r in mixing.plan_mix(docs).collect() if r.doc_id is not None}
    text_of, taken, seen = {i: t for i, t, _ in rows}, collections.Counter(), collections.Counter()
    out = mixing.mix(docs)
    assert out.columns == [*[c for c in docs.columns if c != "mix_epoch"], "mix_epoch", "mix_words"]
    for r in out.collect():
        assert r.words == r.last == r.doc == r._key == "own" and count(r.text) == r.mix_words
        if r.doc_id is not None:
            taken[r.doc_id] += r.mix_words
            seen[r.doc_id] += 1
            assert r.text == text_of[r.doc_id] if r.mix_words == plan[r.doc_id].size else text_of[r.doc_id].startswith(r.text)
    assert all(taken[i] == p.taken for i, p in plan.items()) and max(seen.values()) == 3


def test_mix_of_few_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.plan_mix(none).count() == 0 and mixing.mix(none).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.plan_mix(empty).collect()] == [(0, 0.0, 0)] * 2
    same = spark.createDataFrame([(1, "x y", "a")] * 50 + [(2, "x y z", "b")], "doc_id long, text string, source string")
    got = mixing.plan_mix(same).collect()
    assert sum(r.taken for r in got if r.source == "b") == 9 and abs(sum(r.taken for r in got if r.source == "a") - 94) <= 25


def test_long_text_is_counted_whole(spark):
    docs = spark.createDataFrame([(1, "ab " * 3_000_000, "a")], "doc_id long, text string, source string")
    assert [(r.size, r.taken) for r in mixing.plan_mix(docs).collect()] == [(3_000_000, 3_000_000)]


def test_numbers_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = numbered(Scratch(spark, "test"), df, [F.col("x")], "numbers", rows=3_000_000).collect()
    assert all(r.nth == r.x for r in got) and len(got) == 1000


# ---- fill in the middle


def infill_by_force(doc_id, text, seed=1):
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h, n = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)], len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 400), st.one_of(st.text(alphabet="ab<PSM>é日😀 \n", max_size=40), st.text(max_size=60)), st.integers(1, 9))
def test_infill_by_small_chunks(doc_id, text, chunk):
    text = text.encode(errors="ignore").decode()
    *facts, pieces = infill.infill(doc_id, text.encode(), chunk=chunk)
    output = b"".join(pieces)
    assert (*facts, output.decode()) == infill_by_force(doc_id, text)
    assert infill.restore(output, facts[1]) == text.encode()


@pytest.mark.parametrize("unit, pattern", [("words", r"(?<=[ \t-\r])(?=[^ \t-\r])"), ("lines", r"(?<=\n)(?=.)")])
def test_other_units(unit, pattern):
    r = random.Random(3)
    for _ in range(200):
        text = "".join(r.choice("ab é\n\t日 ") for _ in range(r.randint(0, 60)))
        starts = [0, *(m.start() for m in re.finditer(pattern, text, re.S) if m.start())] if text else []
        starts = [len(text[:s].encode()) for s in starts]
        found = infill.Chunks(np.frombuffer(text.encode(), np.uint8), unit, chunk=r.randint(1, 9))
        assert found.n == len(starts) and [found.place(k) for k in range(found.n + 1)] == [*starts, len(text.encode())]


def test_infilled_documents(spark):
    texts = [*HARD, "<P>" + "x" * 50, "<" * 40, "<S" * 30, "ab😀" * 400_000]
    rows = [(i, t) for i, t in enumerate(texts * 4)] + [(None, "null id"), (7, "one"), (7, "two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n", "form", "output")})
    got = [tuple(r) for r in infill.fill_in_middle(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    assert sorted(got, key=key) == sorted([(i, *infill_by_force(i, t or "")) for i, t in rows], key=key)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    short = [tuple(r) for r in infill.fill_in_middle(docs, digests=True).collect()]
    assert sorted(short, key=key) == sorted([(i, *(f := infill_by_force(i, t or ""))[:4], sha(f[4]), sha(t or "")) for i, t in rows], key=key)
    assert {r[2] for r in short} == {"plain", "psm", "spm"} and infill.fill_in_middle(docs.limit(0)).count() == 0


# ---- clusters


def clusters_by_force(rows, k=8, rounds=10, dims=64, seed=3):
    kept = [(i, [math.floor(1024 * e) if abs(e) < 1e300 else 1024 * int(e) for e in v]) for i, v in rows if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]
    sha = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda x: (sha(x[0]), x[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if groups[j] else c for j, c in enumerate(centroids)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, j in found:
        inertia[j] += d
    fits = lambda d: d if d < 1 << 63 else None
    parts = {j: None if any(fits(d) is None for _, d, c in found if c == j) else s for j, s in inertia.items()}
    total = None if None in parts.values() else sum(parts.values())
    return [(i, j, fits(d), parts[j] and fits(parts[j]), total and fits(total), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found]


def check_clusters(spark, rows, dims=64, k=8, kind="double", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({c: F.lit("own") for c in ("v", "x", "cluster", "up", "of")})
    got = [tuple(r) for r in clusters.cluster_vectors(df.repartition(5), dims=dims, k=k, **more).collect()]
    if kind == "float":
        rows = [(i, v and [e if e is None else float(np.float32(e)) for e in v]) for i, v in rows]
    assert sorted(got, key=str) == sorted(clusters_by_force(rows, k=k, dims=dims), key=str)


def test_clusters(spark):
    r, scans = random.Random(8), []
    centers = [[r.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [c + r.gauss(0, 0.3) for c in centers[i % 6]]) for i in range(700)] + [(700 + i, centers[0]) for i in range(300)]
    hard = [None, [], [0.5] * 63, [0.5] * 65, [math.nan] * 64, [math.inf] + [0.0] * 63, [None] + [0.0] * 63]
    check_clusters(spark, rows + [(2000 + i, v) for i, v in enumerate(hard)] + rows[:20], kind="float", report=scans)
    assert len(scans) == 11 and scans[0] == 1020 and sum(scans[1:]) < 1020 * 5


def test_clusters_with_ties(spark):
    r = random.Random(9)  # few places: distances tie, first centroids are equal, centroids lose all vectors
    check_clusters(spark, [(r.randint(0, 40), [r.choice([-0.001, 0.0, 0.001, 0.002]) for _ in range(2)]) for _ in range(400)] + [(None, [0.0, 0.0])] * 3, dims=2)
    check_clusters(spark, [(i, [i // 7 / 1024, 0.0]) for i in range(200)], dims=2, k=20)


def test_clusters_of_any_size(spark):
    r = random.Random(10)
    large = [(i, [r.uniform(-1, 1) * 10.0 ** r.choice([0, 3, 6, 9, 40, 305]) for _ in range(3)]) for i in range(120)]
    check_clusters(spark, large, dims=3)
    check_clusters(spark, [(i, [r.uniform(-130000, 130000) for _ in range(64)]) for i in range(60)] + [(60 + i, [r.uniform(-1e7, 1e7)] * 64) for i in range(10)])
    check_clusters(spark, [(i, [1.7e308, 5.0, -1.7e308]) for i in range(5)], dims=3)


def test_few_vectors(spark):
    check_clusters(spark, [(3, [0.25] * 64), (5, [0.5] * 64), (5, [0.5] * 64)])
    check_clusters(spark, [(3, [0.25] * 64)])
    check_clusters(spark, [(3, None)])


@pytest.mark.parametrize("total", [0, 1, -1, 2**31, -(2**32), 2**32 - 1, 2**95 + 7, -(2**95) - 7])
def test_digits(total):
    assert sum(d * clusters.BASE**p for p, d in clusters.digits(total)) == total
