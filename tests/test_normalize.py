"""Normalized values: the native table against Python's own functions, on every code point and on random texts."""

import random
import unicodedata

from pyspark.sql import functions as F

from spanguard.functions import text as T


def by_python(v):
    return None if v is None else " ".join(unicodedata.normalize("NFKC", v).casefold().split())


def test_every_code_point(spark):
    """Alone, and between letters that it might meet."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = [("".join(f"{x}{c}{y}|" for c in every[i : i + 64]),) for i in range(0, len(every), 64) for x, y in (("", ""), ("A", "é"))]
    got = spark.createDataFrame(rows, "v string").repartition(8).select("v", T.normalize_value("v").alias("n")).collect()
    assert [r.v[:9] for r in got if r.n != by_python(r.v)] == []
    # each by itself, so that no hard neighbour sends it to Python
    one = spark.createDataFrame([(c,) for c in every[:0x3400] + every[0xF900 - 0x800 : 0x10000 - 0x800] + every[0x10400 - 0x800 : 0x10500 - 0x800] + every[0x1D400 - 0x800 : 0x1F200 - 0x800]], "v string").repartition(8)
    assert [r.v for r in one.select("v", T.normalize_value(F.col("v")).alias("n")).collect() if r.n != by_python(r.v)] == []


def test_random_texts(spark):
    r = random.Random(4)
    pool = ["Иван", "ПЕТРОВ", "Ёж", "José", "José", "ﬁ", "ß", "ΑΣ", "ς", "İ", "ı", "Ⅷ", "½", "ｱﾞ", "가", "가", "각", "ㄱㅏ", "\u1100\u1161", "\u1100\u1161\u11a8", "e\u0301\u0323", "Ω", "Å", "Å", "ǅ", "日本", "ﷺ", "ͅ", "ᾳ", " ", " ", "\t", "\x1c", "　", "​", "𝐀", "😀", "x", "Z"]
    texts = [None, "", " \n"] + ["".join(r.choice(pool) for _ in range(r.randint(1, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "v string").repartition(4)
    assert [r.v for r in df.select("v", T.normalize_value("v").alias("n")).collect() if r.n != by_python(r.v)] == []


def test_names_need_no_python(spark):
    one, to, hard = T.folding()
    assert len(one) == len(to) > 1000
    names = ["José Núñez", "Ёлкин", "Ångström", "Ωμέγα", "山田太郎", "ﾔﾏﾀﾞ".replace("ﾞ", ""), "Ｗｉｄｅ", "김철수", "ŁUKASZ"]
    left = ["ǅ", "Jose\u0301", "straße", "ﬁn", "½", "ｱﾞ", "\u1100\u1161"]
    found = {r.v for r in spark.createDataFrame([(v,) for v in names + left], "v string").where(F.col("v").rlike(hard)).collect()}
    assert found == set(left)
