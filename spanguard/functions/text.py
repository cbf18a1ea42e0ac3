"""Text functions: matches with offsets, Luhn, masks, replacement, hashes."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import fixed_values as V

SPAN_TYPE = "array<struct<label:string,start:int,end:int,score:double>>"
#: Matches that are counted in one array.
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def unicode_pattern(pattern: str) -> str:
    """Digit, space and word classes that know Unicode, as the patterns are meant."""
    return "(?U)" + pattern


def find_spans(text: Column, pattern: str, label: str, score: float, needs: str | None = None) -> Column:
    """All matches as spans with code-point offsets; the pattern must not match the empty string.

    Offsets follow from the lengths of the pieces between the matches and of the matches. Texts
    without a match of ``needs``, a cheap pattern that every match holds, aren't searched.
    """
    p = unicode_pattern(pattern)
    gaps, found = F.split(text, p, -1), F.regexp_extract_all(text, F.lit(p), F.lit(0))

    def spans_from_0(pairs: Column) -> Column:
        def step(acc, x):
            at = acc["at"] + x["gap"]
            span = F.struct(F.lit(label).alias("label"), at.alias("start"), (at + x["size"]).alias("end"), F.lit(float(score)).alias("score"))
            return F.struct((at + x["size"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN_TYPE).alias("out")), step)

    def grow(pairs: Column) -> Column:
        return F.when(F.size(pairs) <= BLOCK, spans_from_0(pairs)["out"]).otherwise(by_blocks(pairs))

    def by_blocks(pairs: Column) -> Column:
        """An array that grows is copied at each step, so many matches are counted in blocks, and the blocks then moved to their places."""
        parts = F.transform(F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK)), lambda i: spans_from_0(F.slice(pairs, i, F.lit(BLOCK))))

        def moved(parts: Column) -> Column:
            ends = F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"])))
            move = lambda s, d: F.struct(s["label"].alias("label"), (s["start"] + d).alias("start"), (s["end"] + d).alias("end"), s["score"].alias("score"))
            return let(ends, lambda at: F.flatten(F.transform(parts, lambda x, i: let(F.get(at, i), lambda d: F.transform(x["out"], lambda s: move(s, d))))))

        return let(parts, moved)

    def sized(g: Column) -> Column:
        return F.transform(found, lambda m, i: F.struct(F.length(F.get(g, i)).alias("gap"), F.length(m).alias("size")))

    none = F.array().cast(SPAN_TYPE)
    spans = F.coalesce(grow(let(gaps, sized)), none)
    return spans if needs is None else F.when(text.rlike(needs), spans).otherwise(none)


@F.arrow_udf(ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))
def word_spans(texts: pa.Array) -> pa.Array:
    """The runs of ``[^\\x20\\x09-\\x0D]+`` with code-point offsets, read off the bytes: ``find_spans`` without a pattern, for every word of a text."""
    found, none = [], np.zeros(0, np.int32)
    for raw in texts.cast(pa.large_binary()):
        b = np.frombuffer(raw.as_buffer() or b"", np.uint8)
        edges = np.flatnonzero(np.diff((b == 32) | (b - np.uint8(9) < 5), prepend=True, append=True))
        heads = (b & 0xC0) != 0x80
        found.append((edges if heads.all() else np.concatenate([[0], heads.cumsum()])[edges]).astype(np.int32))
    edges = np.concatenate(found or [none])
    ends = np.cumsum([0, *(len(x) // 2 for x in found)]).astype(np.int32)
    places = pa.StructArray.from_arrays([edges[::2], edges[1::2]], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(ends), places, mask=texts.is_null() if texts.null_count else None)


def email_spans(text: Column) -> Column:
    return find_spans(text, V.EMAIL_PATTERN, "EMAIL", V.EMAIL_SCORE, "@")


def phone_spans(text: Column) -> Column:
    """Matches of 7 to 15 digits."""
    return F.filter(find_spans(text, V.PHONE_PATTERN, "PHONE_NUMBER", V.PHONE_SCORE, r"\p{Nd}"), lambda s: is_phone(span_text(text, s)))


def card_spans(text: Column) -> Column:
    """Matches that pass Luhn's check."""
    return F.filter(find_spans(text, V.CARD_PATTERN, "CARD_NUMBER", V.CARD_SCORE, r"\p{Nd}"), lambda s: is_card(span_text(text, s)))


def span_hint(span: Column) -> Column:
    """A short name of a span, for logs."""
    return F.format_string("<%s @%d:%d>", span["label"], span["start"], span["end"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)\D", "")


def span_text(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(*V.PHONE_DIGITS)


def is_card(value: Column) -> Column:
    """Luhn's check on 13 to 19 digits; separators don't count."""
    d = digits(value)
    return F.length(d).between(*V.CARD_DIGITS) & F.call_function("luhn_check", d)


def mask_generic(value: Column) -> Column:
    n = F.length(value)
    return F.when(n <= 2, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.left(value, F.lit(1)), F.repeat(F.lit("*"), n - 2), F.right(value, F.lit(1))))


def keep_last_digits(value: Column, k) -> Column:
    """Every digit with ``k`` or more digits behind it becomes a star."""
    if isinstance(k, int):
        return F.regexp_replace(value, r"\d(?=(?:\D*\d){%d})" % k, "*")
    pattern = F.concat(F.lit(r"\d(?=(?:\D*\d){"), k.cast("string"), F.lit("})"))
    return F.regexp_replace(value, pattern, F.lit("*"))


def mask_phone(value: Column) -> Column:
    k = F.greatest(F.lit(2), F.floor(F.length(digits(value)) / 4).cast("int"))
    # numbers of up to 15 digits need two fixed patterns only
    return F.when(k == 2, keep_last_digits(value, 2)).when(k == 3, keep_last_digits(value, 3)).otherwise(keep_last_digits(value, k))


def mask_email(value: Column) -> Column:
    local = F.substring_index(value, "@", 1)
    domain = F.substring(value, F.length(local) + 2, F.length(value))
    n = F.length(local)
    short = F.concat(F.left(local, F.lit(1)), F.repeat(F.lit("*"), F.greatest(F.lit(1), n - 1)))
    long = F.concat(F.left(local, F.lit(1)), F.repeat(F.lit("*"), n - 2), F.right(local, F.lit(1)))
    return F.when(~F.contains(value, F.lit("@")), mask_generic(value)).otherwise(F.concat(F.when(n <= 2, short).otherwise(long), F.lit("@"), domain))


def mask_card(value: Column) -> Column:
    return F.when(F.length(digits(value)) < 4, mask_generic(value)).otherwise(keep_last_digits(value, 4))


def mask_gov_id(value: Column) -> Column:
    return F.when(F.length(digits(value)) <= 2, mask_generic(value)).otherwise(keep_last_digits(value, 2))


def apply_replacements(text: Column, pairs: Column) -> Column:
    """Cut in each (start, end, text) from right to left; of equal starts, the earlier goes first.

    Each step works on what the steps before have made of the text, also where spans overlap.
    """
    order = F.array_sort(
        F.transform(pairs, lambda p, i: F.struct((-p["start"]).alias("o"), i.alias("i"), p["start"].alias("start"), p["end"].alias("end"), p["text"].alias("text")))
    )
    return F.aggregate(order, text, lambda acc, p: F.concat(F.left(acc, p["start"]), p["text"], F.substring(acc, p["end"] + 1, F.length(acc))))


def normalize_ascii(value: Column) -> Column:
    """Lower-cased, white space collapsed and trimmed: exact for ASCII values."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"\s+", " "), "^ | $", "")


@F.pandas_udf(StringType())
def _normalize_in_python(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFKC", v).casefold().split()))


@cache
def folding() -> tuple[str, str, str]:
    """Characters that fold to another one, what they fold to, and a pattern of those that a table of single characters can't fold.

    The latter fold to several, or meet a neighbour when composed: marks, vowels and finals of Hangul and other second
    halves of composed characters. By rule from ``unicodedata``.
    """
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    pairs = [d.split() for c in every if (d := unicodedata.decomposition(c)) and d[0] != "<"]
    second = {chr(int(d[1], 16)) for d in pairs if len(d) == 2} | set(map(chr, range(0x1161, 0x1176))) | set(map(chr, range(0x11A8, 0x11C3)))
    one, to, hard = [], [], []
    for c in every:
        folded = unicodedata.normalize("NFKC", c).casefold()
        if len(folded) != 1 or any(x in second or unicodedata.combining(x) for x in (c, *unicodedata.normalize("NFKC", c))):
            hard.append(ord(c))
        elif folded != c:
            one.append(c)
            to.append(folded)
    ranges, start = [], hard[0]
    for x, y in zip(hard, [*hard[1:], None]):
        if y != x + 1:
            ranges.append(f"\\x{{{start:x}}}-\\x{{{x:x}}}")
            start = y
    return "".join(one), "".join(to), f"[{''.join(ranges)}]"


#: White space as Python splits at it, and letters whose case a column's ``lower`` folds alike.
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
_PLAIN = r"^[\x00-\x7f\u0400-\u045f]*$"


def normalize_value(value: Column | str) -> Column:
    """Compatibility form, case folded, white space collapsed and trimmed, for any text.

    ASCII and Cyrillic fold by ``lower``, other characters that fold by themselves by a table; Python composes the rest.
    """
    value = F.col(value) if isinstance(value, str) else value
    one, to, hard = folding()
    plain = value.rlike(_PLAIN)
    native = F.when(plain, F.lower(value)).when(~value.rlike(hard), F.translate(value, one, to))
    rest = _normalize_in_python(F.when(~plain & value.rlike(hard), value))
    return F.coalesce(F.trim(F.regexp_replace(native, BLANK, " ")), rest)


def seed_of(doc_id: Column, value: Column, category: Column) -> Column:
    return F.sha2(F.concat(doc_id, F.lit(":"), value, F.lit(":"), category), 256)


def seed_index(seed: Column) -> Column:
    return F.conv(F.substring(seed, 1, 8), 16, 10).cast("bigint")


def choose(words: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), (index % len(words)).cast("int"))


def is_english(locale: Column) -> Column:
    return F.startswith(F.lower(F.regexp_replace(locale, "-", "_")), F.lit("en")) | (F.lower(locale) == "us")


def pseudonym(seed: Column, category: Column, locale: Column) -> Column:
    """The category's pseudonym; a function of its arguments, so it needs no registry."""

    def body(i: Column) -> Column:
        en, b, c = is_english(locale), F.shiftright(i, 8), F.shiftright(i, 16)
        person = F.when(en, F.concat_ws(" ", choose(V.EN_FIRST, i), choose(V.EN_LAST, b))).otherwise(F.concat_ws(" ", choose(V.RU_LAST, b), choose(V.RU_FIRST, i), choose(V.RU_PATRONYMICS, c)))
        house = lambda n: (c % n + 1).cast("string")
        address = F.when(en, F.concat(house(200), F.lit(" "), choose(V.EN_STREETS, i), F.lit(", "), choose(V.EN_CITIES, b))).otherwise(F.concat(choose(V.RU_CITIES, i), F.lit(", "), choose(V.RU_STREETS, b), F.lit(", д."), house(50)))
        two = lambda x: F.lpad(x.cast("string"), 2, "0")
        day, month = two(i % 28 + 1), two(b % 12 + 1)
        date = F.when(en, F.concat(month, F.lit("/"), day, F.lit("/1990"))).otherwise(F.concat(day, F.lit("."), month, F.lit(".1990")))
        return (
            F.when(category.isin(V.PERSON_LABELS), person)
            .when(category.isin(V.ADDRESS_LABELS), address)
            .when(category.isin(V.DATE_LABELS), date)
            .when(category.isin(V.EMAIL_LABELS), F.concat(F.substring(seed, 1, 8), F.lit("@"), choose(V.EMAIL_DOMAINS, b)))
            .when(category.isin(V.MEDICAL_LABELS), F.when(en, V.MEDICAL_EN).otherwise(V.MEDICAL_RU))
            .when(category.isin(V.ORGANIZATION_LABELS), F.when(en, choose(V.EN_ORGANIZATIONS, i)).otherwise(choose(V.RU_ORGANIZATIONS, i)))
            .otherwise(V.REDACTED)
        )

    return let(seed_index(seed), body)


def masked(value: Column, category: Column, locale: Column, other: Column) -> Column:
    """The mask of the categories that have one on either action, else ``other``."""
    return (
        F.when(category.isin(V.PHONE_LABELS), mask_phone(value))
        .when(category.isin(V.EMAIL_LABELS), mask_email(value))
        .when(category.isin(V.CARD_LABELS), mask_card(value))
        .when(category.isin(V.GOV_ID_LABELS + V.ACCOUNT_LABELS), mask_gov_id(value))
        .when(category.isin(V.MEDICAL_LABELS), F.when(is_english(locale), V.MEDICAL_EN).otherwise(V.MEDICAL_RU))
        .otherwise(other)
    )


def replacement(value: Column, category: Column, action: Column, doc_id: Column, locale: Column, normalized: Column | None = None) -> Column:
    """What stands for a value in the text, by category and action."""
    norm = normalize_ascii(value) if normalized is None else normalized
    other = F.when(action == "mask", mask_generic(value)).otherwise(pseudonym(seed_of(doc_id, norm, category), category, locale))
    return masked(value, category, locale, other)


def strategy(category: Column, action: Column) -> Column:
    out = F.when(action == "mask", V.MASK_STRATEGY)
    for name, labels in V.STRATEGIES.items():
        out = out.when(category.isin(labels), name)
    return out.otherwise(V.OTHER_STRATEGY)
