"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Words are the lower-cased runs of letters and digits; in scripts that write words without spaces every
letter is a word. An overlap is a window of ``WINDOW``
aligned words of a benchmark item of which at most ``MISSES`` differ, words beyond the document's
ends included; an item of fewer words counts where all of it stands in a row. A seed is the hash of the words at the positions of a
mask, the other positions are ignored. Any two differences in a window leave one of the masks
untouched somewhere (a test goes through all), so no overlap is missed. Items that no mask fits in have one seed, of all
their words. Seeds of documents meet
seeds of the benchmark in a join, and every hit's whole diagonal is then verified word by word, so many hits of a document at a time.

All seeds but those of single words begin with two neighbouring words. A bitmap of fixed size has the hashes of the
benchmark's pairs (and of its items of one word); positions whose bit isn't set have no seed worth a row.

Defined results: null and empty texts have no overlap, and neither have benchmark items that are
null or without a word; equal items are reported each; repeated rows and very long
texts are treated like any other; an empty benchmark leaves all documents clean; further columns
and the names of columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WINDOW, MISSES = 13, 2
MASKS = ((0, 1, 2, 4, 6), (0, 1, 3, 4, 5), (0, 1, 3, 5, 6))
#: Words of the longest mask: shorter items have a seed of their own length.
REACH = 1 + max(max(m) for m in MASKS)
#: Bits of the bitmap, and hits of a document that are verified in one row.
BITS, HITS = 1 << 20, 64
#: Tells the masks' seeds apart.
_SALTS = (-7046029254386353131, -4417276706812531889, 1609587929392839161)
#: Scripts without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def word_array(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(low.rlike(UNSPACED), F.regexp_replace(low, f"({UNSPACED})", " $1 ")).otherwise(low)
    return F.split(apart, r"[^\p{L}\p{N}]+")


def _hash(h: Column, at: Column, mask: tuple[int, ...], salt: int = 0) -> Column:
    """The word hashes at the mask's positions, each rotated by its place and combined; null beyond the end."""
    total = F.get(h, at).bitwiseXOR(F.lit(salt))
    for k, p in enumerate(mask[1:], 1):
        x = F.get(h, at + p)
        total = total.bitwiseXOR(F.shiftleft(x, 7 * k).bitwiseOR(F.shiftrightunsigned(x, 64 - 7 * k)))
    return total


def _pair(h: Column, at: Column) -> Column:
    return _hash(h, at, (0, 1))


def _seeds(h: Column, places: Column) -> Column:
    """Array of (position, seed) for the positions in ``places``; a seed that runs over the end is null."""
    return F.flatten(F.transform(places, lambda i: F.array(*[F.struct(i.alias("pos"), _hash(h, i, m, salt).alias("seed")) for m, salt in zip(MASKS, _SALTS)])))


def _short_seeds(h: Column, places: Column, sizes: list[int]) -> Column:
    """The same of runs of so many words, which stand for whole items."""
    return F.flatten(F.transform(places, lambda i: F.array(*[F.struct(i.alias("pos"), _hash(h, i, tuple(range(n)), n).alias("seed")) for n in sizes])))


def _bitmap(keys: DataFrame) -> Column:
    """The bits of the keys' hashes (column ``k``) as a constant array of longs: ``BITS`` / 64 rows at most reach the driver."""
    bit = F.pmod(F.col("k"), F.lit(BITS))
    words = keys.select((bit / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    held = [0] * (BITS // 64)
    for r in words:
        held[r.w] = r.b
    return F.from_json(F.lit(str(held)), "array<bigint>")


def _is_set(bits: Column, key: Column) -> Column:
    at = F.pmod(key, F.lit(BITS))
    return F.getbit(F.get(bits, (at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1


def overlaps(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows doc_id, th, item_id, diag, spans: the overlapping runs of words (start, stop) in the document."""
    scratch = Scratch(docs.sparkSession, "overlaps")
    words = F.filter(word_array(F.col(item_text)), lambda w: w != "")
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), words.alias("item")).where(F.size("item") > 0)
    items = scratch.save(items.withColumn("h", F.transform("item", lambda w: F.xxhash64(w))), "items")
    sizes = sorted(r.n for r in items.select(F.size("item").alias("n")).where(F.col("n") < REACH).distinct().collect())  # REACH at most
    places = F.when(F.size("h") > 1, F.sequence(F.lit(0), F.size("h") - 2)).otherwise(F.array().cast("array<int>"))
    own = _seeds(F.col("h"), places)
    for n in sizes:
        own = F.when(F.size("h") == n, _short_seeds(F.col("h"), F.array(F.lit(0)), [n])).otherwise(own)
    seeds = items.select("item_id", F.explode(own).alias("s")).select("item_id", F.col("s.pos").alias("item_pos"), "s.seed").where("seed is not null")
    seeds = scratch.save(seeds, "seeds")
    pairs = items.select(F.explode(F.transform(places, lambda i: _pair(F.col("h"), i))).alias("k"))
    known = _bitmap(pairs.unionByName(items.where(F.size("h") == 1).select(F.get("h", F.lit(0)).alias("k"))))
    short = [n for n in sizes if n > 1]

    def near(h: Column) -> Column:
        every = F.when(F.size(h) > 1, F.sequence(F.lit(0), F.size(h) - 2)).otherwise(F.array().cast("array<int>"))
        places = F.filter(every, lambda i: _is_set(known, _pair(h, i)))
        found = _seeds(h, places)
        if short:
            found = F.concat(found, _let(places, lambda p: _short_seeds(h, p, short)))
        if 1 in sizes:
            single = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: _is_set(known, F.get(h, i)))
            found = F.concat(found, _short_seeds(h, single, [1]))
        return F.filter(found, lambda s: s["seed"].isNotNull())

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    found = rows.select("doc_id", "th", F.explode(_let(F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)), near)).alias("s")).select("doc_id", "th", "s.pos", "s.seed")
    hits = found.join(seeds, "seed").select("doc_id", "th", "item_id", (F.col("pos") - F.col("item_pos")).alias("diag")).distinct()
    hits = scratch.save(hits, "hits")

    # so many hits of a document to a row, however many it has
    nth = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("item_id", "diag"))
    parted = hits.withColumn("part", F.floor((nth - 1) / HITS))
    each = parted.join(items.select("item_id", "item"), "item_id").groupBy("doc_id", "th", "part").agg(F.collect_list(F.struct("item_id", "diag", "item")).alias("hits"))
    texts = rows.join(each, rows.doc_id.eqNullSafe(each.doc_id) & (rows.th == each.th)).select(rows.doc_id, rows.th, "part", "text", "hits").dropDuplicates(["doc_id", "th", "part"])

    def spans(words: Column, hit: Column) -> Column:
        n = F.size(hit["item"])
        width, least = F.least(n, F.lit(WINDOW)), F.when(n >= WINDOW, WINDOW - MISSES).otherwise(n)
        same = F.transform(hit["item"], lambda w, j: F.coalesce((F.get(words, hit["diag"] + j) == w).cast("int"), F.lit(0)))
        full = lambda e: F.filter(F.sequence(F.lit(0), n - width), lambda s: F.aggregate(F.slice(e, s + 1, width), F.lit(0), lambda a, b: a + b) >= least)
        return F.transform(_let(same, full), lambda s: F.struct(F.greatest(hit["diag"] + s, F.lit(0)).alias("start"), F.least(hit["diag"] + s + width, F.size(words)).alias("stop")))

    checked = _let(word_array(F.col("text")), lambda w: F.transform(F.col("hits"), lambda x: F.struct(x["item_id"].alias("item_id"), x["diag"].alias("diag"), spans(w, x).alias("spans"))))
    return texts.select("doc_id", "th", F.explode(checked).alias("o")).select("doc_id", "th", "o.item_id", "o.diag", "o.spans").where(F.size("spans") > 0)


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """Rows doc_id, th, n_items, items, n_words (of the document, inside overlaps), contaminated, for every row of ``docs``."""
    found = overlaps(docs, bench, id_col, text_col, **names)
    # spans in order; each counts what it has beyond the ends of those before
    order = Window.partitionBy("doc_id", "th").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("doc_id", "th", "item_id", F.inline("spans")).withColumn("before", F.coalesce(F.max("stop").over(order), F.lit(0)))
    fresh = F.greatest(F.col("stop") - F.greatest("start", "before"), F.lit(0))
    per = spans.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.sum(fresh).cast("long").alias("n_words"))
    per = per.withColumnRenamed("doc_id", "i").withColumnRenamed("th", "t")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"))
    out = rows.join(per, rows.doc_id.eqNullSafe(per.i) & (rows.th == per.t), "left")
    return out.select("doc_id", "th", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"), F.col("items").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, all columns, without an overlap with the benchmark."""
    found = overlaps(docs, bench, id_col, text_col, **names).select(F.col("doc_id").alias("i"), F.col("th").alias("t")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"))
    return rows.join(found, rows.id.eqNullSafe(found.i) & (rows.th == found.t), "left_anti").select("row.*")
