"""The pattern bank behind its required literals: the same flags as every pattern searched in every text."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tests.conftest import SF

from spanguard.functions import fixed_values as V
from spanguard.functions import guard as G


def plain(text):
    """Every category's patterns over the whole text."""
    return F.coalesce(F.array_compact(F.array(*[F.when(text.rlike(G.category_pattern(c)), F.lit(c)) for c in V.GUARD_PATTERNS])), F.array().cast("array<string>"))


def test_flags_equal_a_search_of_everything(spark):
    r = random.Random(7)
    texts = [None, "", " ", "A" * 79, "A" * 80, "x" + "a/+9" * 20 + "=", "É" + "aB" * 40, "aſK" * 30]
    swap = {"i": "İıI", "s": "ſS", "k": "KK", "в": "ᲀВ", "о": "ᲂО", "с": "ᲃС", "т": "ᲄᲅТ", "д": "ᲁД"}
    for patterns in V.GUARD_PATTERNS.values():
        for p in patterns:
            for _ in range(25):  # texts that nearly match: the pattern's own words with gaps, case and look-alikes
                t = re.sub(r"\[\^?[^\]]*\][*{0-9,}?]*", lambda m: "word " * 12 if "50" in m[0] else "a/+9Z" * 17 if "80" in m[0] else " ", p)
                t = re.sub(r"\(\?:|\(", "(", t)
                while m := re.search(r"\(([^()]*)\)\??", t):
                    t = t[: m.start()] + (r.choice(m[1].split("|")) if r.random() < 0.8 else "") + t[m.end() :]
                t = re.sub(r"\\s[*+]|[?]", lambda m: r.choice([" ", "\n", "  ", " ", ""]), t)
                t = "".join(r.choice(swap[c]) if c in swap and r.random() < 0.15 else c.upper() if r.random() < 0.2 else c for c in t)
                texts.append(r.choice(["", "so, ", "ну "]) + t + r.choice(["", " x ", " a b"]))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = df.select("i", plain(F.col("t")).alias("want"), G.flags(F.col("t")).alias("got")).collect()
    assert [x.i for x in rows if x.want != x.got] == []
    assert {c for x in rows for c in x.want} == set(V.GUARD_PATTERNS) and sum(bool(x.want) for x in rows) > 300


def test_flags_of_the_given_texts(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("text").union(spark.read.parquet(f"{SF}/conversations.parquet").select("text"))
    assert df.where(plain(F.col("text")) != G.flags(F.col("text"))).count() == 0


def test_look_alikes_are_complete():
    """No other character becomes a letter of the patterns by upper and then lower case."""
    letters = set("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0x430, 0x450))) + "ё")
    found = {chr(c) for c in range(0x110000) if chr(c).lower() not in letters and len(chr(c).upper()) == 1 and chr(c).upper().lower() in letters}
    # the dotted capital becomes a letter and a mark by lower case, and one letter in patterns; the sign of degrees Kelvin becomes k either way
    assert found | {"İ", "\u212a"} == set(G._ALIKE)
    assert all(chr(c).upper().lower() == w for c, w in zip(map(ord, G._ALIKE), G._LETTERS) if c not in (0x130, 0x131)) and len(G._ALIKE) == len(G._LETTERS)


@pytest.mark.parametrize("pattern, need", [("ab+c", ("and", [])), (r"system\s+prompt", ("and", ["system", "prompt"])), ("(?:abc|defg)?hij", ("and", ["hij"])), ("abc(?:def|x)", ("and", ["abc"])), ("[a-c]{5,}", ("and", [("run", "abc", 5)])), ("(abcd|efgh)i", ("and", [("and", [("or", [("and", ["abcd"]), ("and", ["efgh"])])])]))])
def test_requirements(pattern, need):
    assert G.required(pattern) == need
