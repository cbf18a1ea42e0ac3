"""Clusters of similar names against the sequential rule, in plain loops."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SF
from pyspark.sql import functions as F

from spanguard.operators import fuzzy


def ratio_by_force(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        before, row = row, [0]
        for j, other in enumerate(b):
            row.append(before[j] + 1 if ch == other else max(before[j + 1], row[j]))
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def clusters_by_force(names, threshold=0.8):
    leaders, out = [], {}
    form = {n: " ".join(sorted(n.lower().split())) for n in names}
    for n in names:
        found = next((k for k in leaders if ratio_by_force(form[n], form[k]) >= threshold), None)
        if found is None:
            leaders.append(found := n)
        out[n] = found
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcé日 😀", max_size=9), max_size=14), st.sampled_from([0.5, 0.8, 0.9, 1.0]))
def test_bounds_lose_nothing(names, threshold):
    forms = [" ".join(sorted(n.split())) for n in names]
    leaders, want = [], []
    for i, f in enumerate(forms):
        found = next((k for k in leaders if ratio_by_force(f, forms[k]) >= threshold), None)
        if found is None:
            leaders.append(found := i)
        want.append(found)
    assert fuzzy.cluster_forms(forms, threshold) == want


def name_of(r):
    words = [r.choice(["anna", "ana", "boris", "carla", "karla", "dmitri", "li", "zoë"]), r.choice(["petrov", "petrova", "lee", "smithson", "smitson", "óg", "x"])] + [r.choice("abcdefgh") * r.randint(0, 6)]
    r.shuffle(words)
    return r.choice([" ", "  "]).join(words).strip() if r.random() < 0.97 else ""


@pytest.mark.parametrize("small, most, part", [(250, 1000, 4096), (3, 6, 10)])
def test_groups_of_any_size(spark, monkeypatch, small, most, part):
    """With small bounds the hot group goes through many rounds, in parts."""
    for k, v in (("SMALL", small), ("MOST", most), ("PART", part)):
        monkeypatch.setattr(fuzzy, k, v)
    r = random.Random(4)
    rows = [("hot", name_of(r), r.randint(0, 90)) for _ in range(350)] + [(r.choice(["a", "b", None, ""]), name_of(r), r.randint(0, 9)) for _ in range(120)]
    rows += [("one", "single", 1), ("none", None, 1), ("hot", None, 2)] + [("same", "Copied Name", 3)] * 30
    df = spark.createDataFrame(rows, "who string, name string, at int").withColumns({c: F.lit("own") for c in ("g", "form", "pos", "part", "cluster")})
    want = set()
    for g in {x[0] for x in rows}:
        at = {}
        for who, n, p in rows:
            if who == g and n is not None:
                at[n] = min(p, at.get(n, p))
        want |= {(g, n, c) for n, c in clusters_by_force(sorted(at, key=lambda n: (at[n], n))).items()}
    got = [tuple(x) for x in fuzzy.fuzzy_name_clusters(df.repartition(5), "who", "name", "at").collect()]
    assert len(got) == len(want) and {(g, n) for g, n, _ in got} == {(g, n) for g, n, _ in want} and set(got) == want


def test_no_names(spark):
    df = spark.createDataFrame([], "who string, name string")
    assert fuzzy.fuzzy_name_clusters(df, "who", "name").count() == 0


def test_all_customers(spark):
    """The registered query over a whole given table equals the rule."""
    from spanguard.plans.catalog import QUERIES

    want = set()
    names = {}
    for c in spark.read.parquet(f"{SF}/customer.parquet").collect():
        names.setdefault(c.c_nationkey, set()).update((c.c_name, f"{c.c_mktsegment} {c.c_name}", f"{c.c_name} {c.c_mktsegment}"))
    for g, of in names.items():
        want |= {(g, n, c) for n, c in clusters_by_force(sorted(of)).items()}
    assert {tuple(x) for x in QUERIES["fuzzy_name_clusters"](spark, SF).collect()} == want
