"""Span operators against small Python versions of their definitions, and pinned cases."""

import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spanguard.functions import fixed_values as V
from spanguard.functions import text as T
from spanguard.operators import spans as S

SPAN = T.SPAN_TYPE


def one(spark, expression, **columns):
    types = ", ".join(f"{k} {t}" for k, (t, _) in columns.items()) or "x int"
    row = tuple(v for _, v in columns.values()) or (0,)
    return spark.createDataFrame([row], types).select(expression.alias("r")).first().r


def spans(*rows):
    return [Row(label=a, start=b, end=c, score=d) for a, b, c, d in rows]


def tuples(found):
    return [tuple(s) for s in found]


TEXTS = [
    "", "write to a.b@example.com or c@d.org!", "call +1 (555) 123-4567 now", "card 4111 1111 1111 1111, not 4111 1111 1111 1112", "1234567 and 123456 and 2024-01-02",
    "é a@b.cc é +7 999 123 45 67\n12-34-56-78", "no data at all", "９９９ 123 456 78 90 x@y.zz x@y.zz", "a" * 50 + "@mail.test 5500005555555559",
]


@pytest.mark.parametrize("pattern", [V.EMAIL_PATTERN, V.PHONE_PATTERN, V.CARD_PATTERN])
def test_offsets_are_those_of_a_scan(spark, pattern):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").select("text", T.find_spans(F.col("text"), pattern, "L", 0.5).alias("s"))
    for r in df.collect():
        assert [(s.start, s.end) for s in r.s] == [m.span() for m in re.finditer(pattern, r.text)]


def test_null_and_empty_text(spark):
    rows = spark.createDataFrame([(None,), ("",)], "text string").select(S.regex_spans(F.col("text")).alias("s"), T.mask_generic(F.col("text")).alias("m")).collect()
    assert [r.s for r in rows] == [[], []] and rows[1].m == ""


@pytest.mark.parametrize("number,fine", [("4111111111111111", True), ("4111111111111112", False), ("4111 1111 1111 1111", True), ("4111-1111-1111-1111", True), ("18", False), ("0" * 12, False), ("0" * 20, False)])
def test_luhn(spark, number, fine):
    assert one(spark, T.is_card(F.col("v")), v=("string", number)) is fine


@pytest.mark.parametrize(
    "f,value,want",
    [
        (T.mask_phone, "+1 (555) 123-4567", "+* (***) ***-**67"), (T.mask_phone, "12", "12"), (T.mask_gov_id, "123-45-6789", "***-**-**89"), (T.mask_gov_id, "A1", "**"), (T.mask_gov_id, "AB1", "A*1"),
        (T.mask_card, "4111 1111 1111 1111", "**** **** **** 1111"), (T.mask_card, "123", "1*3"), (T.mask_email, "john@x.com", "j**n@x.com"), (T.mask_email, "ab@x.com", "a*@x.com"), (T.mask_email, "a@b@c", "a*@b@c"),
        (T.mask_email, "none", "n**e"), (T.mask_generic, "ab", "**"), (T.mask_generic, "abc", "a*c"), (T.mask_phone, "1" * 20, "*" * 15 + "1" * 5),
    ],
)
def test_masks(spark, f, value, want):
    assert one(spark, f(F.col("v")), v=("string", value)) == want


def test_policy_bounds(spark):
    cases = [("ssn", 0.5, "mask"), ("ssn", 0.85, "replace"), ("ssn", 0.49, "skip"), ("EMAIL", 0.5, "replace"), ("EMAIL", 0.84, "replace"), ("url", 0.0, "skip")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "l string, s double").select(S.action(F.col("l"), F.col("s")).alias("a"))
    assert [r.a for r in df.collect()] == [c for _, _, c in cases]


def test_replacements(spark):
    pair = "array<struct<start:int,end:int,text:string>>"
    apply = lambda text, *p: one(spark, T.apply_replacements(F.col("t"), F.col("p")), t=("string", text), p=(pair, [Row(start=a, end=b, text=c) for a, b, c in p]))
    assert apply("aa b cccc", (0, 2, "XXXXXX"), (3, 4, "Y"), (5, 9, "ZZZZ")) == "XXXXXX Y ZZZZ"
    assert apply("abc") == "abc"
    assert apply("abcdef", (0, 3, "1"), (3, 6, "22")) == "122"
    # overlapping spans work on what is there by then; of equal starts the earlier goes first
    text, pairs = "abcdefghij", [(2, 6, "X"), (4, 8, "YY"), (2, 4, "Z")]
    want = text
    for a, b, c in sorted(pairs, key=lambda p: p[0], reverse=True):
        want = want[:a] + c + want[b:]
    assert apply(text, *pairs) == want


def decode_by_scan(tags):
    out, i = [], 0
    while i < len(tags):
        kind, _, label = tags[i][0].partition("-")
        if kind == "S" and label:
            out.append((label, tags[i][1], tags[i][2], tags[i][3]))
        if kind == "B" and label:
            j = i + 1
            while j < len(tags) and tags[j][0] == f"I-{label}":
                j += 1
            if j < len(tags) and tags[j][0] == f"E-{label}":
                scores = [t[3] for t in tags[i : j + 1]]
                out.append((label, tags[i][1], tags[j][2], sum(scores) / len(scores)))
                i = j
        i += 1
    return out


def test_tags_decode_as_a_scan_does(spark):
    r = random.Random(5)
    rows = []
    for k in range(300):
        tags = [r.choice(["O", "B-x", "I-x", "E-x", "S-x", "B-y", "I-y", "E-y", "O-x", "x", "B-a-b", "E-a-b"]) for _ in range(r.randint(0, 12))]
        rows.append((k, [(t, 3 * i, 3 * i + 2, r.randint(1, 9) / 10) for i, t in enumerate(tags)]))
    df = spark.createDataFrame(rows, "k int, t array<struct<tag:string,start:int,end:int,score:double>>")
    for row in df.select("k", "t", S.decode_tags(F.col("t")).alias("s")).collect():
        want = decode_by_scan([tuple(t) for t in row.t])
        assert [s[:3] for s in tuples(row.s)] == [w[:3] for w in want]
        assert [s.score for s in row.s] == pytest.approx([w[3] for w in want])


def merge_by_scan(found):
    kept = []
    for s in sorted(found, key=lambda s: (s[1], s[2])):
        if not kept or kept[-1][0] != s[0] or not (kept[-1][1] < s[2] and s[1] < kept[-1][2]):
            kept.append(s)
            continue
        p = kept[-1]
        if p[1:3] != s[1:3] and p[1] <= s[1] and p[2] >= s[2]:
            continue
        if p[1:3] != s[1:3] and s[1] <= p[1] and s[2] >= p[2] or s[3] > p[3]:
            kept[-1] = s
    return kept


def test_merge_as_a_scan_does(spark):
    r = random.Random(6)
    rows = []
    for k in range(300):
        rows.append((k, [(r.choice("ab"), a := r.randint(0, 12), a + r.randint(1, 8), r.randint(1, 9) / 10) for _ in range(r.randint(0, 8))]))
    for row in spark.createDataFrame(rows, f"k int, s {SPAN}").select("k", "s", S.merge_spans(F.col("s")).alias("m")).collect():
        assert tuples(row.m) == merge_by_scan(tuples(row.s))


def test_windows(spark):
    def scan(n, size=512, overlap=64):
        out, start = [], 0
        while True:
            out.append((start, min(start + size, n)))
            if start + size >= n:
                return out
            start += size - overlap

    sizes = [0, 1, 100, 512, 513, 960, 961, 1500]
    df = spark.createDataFrame([(n,) for n in sizes], "n int").select("n", S.windows(F.col("n")).alias("w"))
    for row in df.collect():
        assert tuples(row.w) == scan(row.n)
    with pytest.raises(ValueError):
        S.windows(F.lit(3), 10, 10)


def test_window_bounds_skip_tokens_without_characters(spark):
    offsets = [Row(start=0, end=0), Row(start=2, end=5), Row(start=6, end=9), Row(start=0, end=0)]
    got = one(spark, S.window_bounds(F.struct(F.lit(0).alias("token_start"), F.lit(4).alias("token_end")), F.col("o"), F.lit(20)), o=("array<struct<start:int,end:int>>", offsets))
    assert tuple(got) == (2, 9)
    got = one(spark, S.window_bounds(F.struct(F.lit(0).alias("token_start"), F.lit(1).alias("token_end")), F.col("o"), F.lit(20)), o=("array<struct<start:int,end:int>>", offsets))
    assert tuple(got) == (0, 20)


def test_coverage_best_and_overlaps(spark):
    a = spans(("EMAIL", 0, 10, 0.6), ("PHONE_NUMBER", 2, 8, 0.5), ("PHONE_NUMBER", 5, 12, 0.5))
    assert tuples(one(spark, S.uncovered(F.col("a"), F.slice("a", 1, 1)), a=(SPAN, a))) == [("PHONE_NUMBER", 5, 12, 0.5)]
    b = spans(("x", 5, 9, 0.2), ("x", 1, 3, 0.5), ("x", 5, 9, 0.8), ("y", 5, 9, 0.1))
    assert tuples(one(spark, S.best_of_each(F.col("b")), b=(SPAN, b))) == [("x", 1, 3, 0.5), ("x", 5, 9, 0.8), ("y", 5, 9, 0.1)]
    assert tuples(one(spark, S.resolve_overlaps(F.col("a")), a=(SPAN, a))) == [("EMAIL", 0, 10, 0.6)]


def test_pseudonyms_depend_on_document_value_and_locale(spark):
    p = lambda doc, value, category, locale: one(spark, T.pseudonym(T.seed_of(F.lit(doc), T.normalize_ascii(F.lit(value)), F.lit(category)), F.lit(category), F.lit(locale)))
    assert p("d", "John  Smith", "NAME", "en") == p("d", " john smith ", "NAME", "en")
    assert p("d", "john", "NAME", "en") != p("d", "john", "NAME", "ru")
    assert len({p(f"d{i}", "john", "NAME", "en") for i in range(8)}) > 1
    assert p("d", "x", "DIAGNOSIS", "ru") == V.MEDICAL_RU and p("d", "x", "url", "en-GB") == V.REDACTED
    assert re.fullmatch(r"\d\d/\d\d/1990", p("d", "x", "DATE", "US")) and re.fullmatch(r"\d\d\.\d\d\.1990", p("d", "x", "DATE", "de"))
    assert re.fullmatch(r"[0-9a-f]{8}@(example\.com|mail\.test|sample\.org)", p("d", "x", "EMAIL", "en"))


def test_fuzzy_clusters(spark):
    names = ["Ivan Petrov", "Petrov Ivan", "Ivan Petrof", "Anna Lee", ""]
    got = one(spark, S.fuzzy_clusters()(F.col("n"), F.transform("n", T.normalize_ascii)), n=("array<string>", names))
    assert got == ["Ivan Petrov", "Ivan Petrov", "Ivan Petrov", "Anna Lee", ""]


def test_fuzzy_name_clusters_takes_all_customers(spark, tmp_path):
    from spanguard.plans.catalog import QUERIES

    def ratio(a, b):
        a, b = (" ".join(sorted(x.lower().split())) for x in (a, b))
        row = [0] * (len(b) + 1)
        for ch in a:
            before, row = row, [0]
            for j, other in enumerate(b):
                row.append(before[j] + 1 if ch == other else max(before[j + 1], row[j]))
        return 2 * row[-1] / (len(a) + len(b))

    first, last = ["Anna", "Ana", "Boris", "Carla", "Karla", "Dmitri"], ["Petrov", "Petrova", "Lee", "Smithson", "Smitson"]
    rows = [(i, f"{first[i % 6]} {last[i % 5]}", i % 2, ["FURNITURE", "MACHINERY", "BUILDING"][i % 3]) for i in range(60)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    want = set()
    for nation in (0, 1):
        reps = []
        for name in sorted({x for _, n, k, m in rows if k == nation for x in (n, f"{m} {n}", f"{n} {m}")}):
            found = next((r for r in reps if ratio(name, r) >= 0.8), None)
            if found is None:
                reps.append(found := name)
            want.add((nation, name, found))
    got = [tuple(r) for r in QUERIES["fuzzy_name_clusters"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want
