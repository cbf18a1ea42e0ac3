"""Mixing sources to target weights: hash-random keys, prefix sums of word counts, one cut a source.

A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``. Sources are numbered by code point
(null last) and weigh 1, 2, 3, repeating. They share the words of all documents by weight; a target stops at
``MOST`` times its source's words, and what is over is shared anew by weight until no target is above.

Within a source the documents stand in the order of a random key, the hash of id and text. The
mix takes whole epochs of the source and then the first words in that order, up to the target
rounded down. To find where that ends, no document is moved: words are summed by source and range
of keys, prefix sums of these few rows tell the range that owns the cut, and only the rows of owning
ranges are sorted. Documents are then compared with their source's cut, one row a source. The
document at the cut gives its first words only, so a source meets its budget exactly.

Defined results: a null text has size 0 and gives nothing; a null source is a source; rows of one
source that are equal in id and text share a key, and where the cut falls among n of them each
gives the same share, rounded (the source is then off by n / 2 words at most); null ids are an id like any other; a source
without words has target 0; an empty table gives an empty one. The result depends on nothing but
the rows, so reruns agree, whatever the partitioning. Columns of the input named as those that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered, rows_of

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating, and the most epochs that a mix takes of a source.
WEIGHTS, MOST = (1, 2, 3), 3
#: Bits of a random key, and rows that a range of keys holds on average.
KEY_BITS, RANGE_ROWS = 60, 4096
#: One row a source is sent to all executors up to so many (some 10 MB); beyond, documents are dealt by source and salt.
BROADCAST_SOURCES, SALTS = 100_000, 64
SEED = 11


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """60 random bits that only id and text decide."""
    own = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(F.md5(text.cast("binary")), F.lit("")))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (words, weight) with a double ``target``: shares by weight, none above ``most`` times the words.

    Each round is one aggregate: sources above their bound stop there, the others share what is left. Bounded
    sources stay bounded, as the share of a weight only grows, so few rounds end it.
    """
    cap = most * F.col("words")
    total, weights = sources.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left, weight, n = total, weights, -1
    share = lambda: F.lit(float(left)) * F.col("weight") / F.lit(float(max(weight, 1)))
    while True:
        bounded = sources.where(cap < share()).agg(F.coalesce(F.sum(cap), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")).first()
        if bounded[2] == n:
            return sources.withColumn("target", F.least(cap.cast("double"), share()))
        left, weight, n = total - bounded[0], weights - bounded[1], bounded[2]


def by_source(docs: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """``docs`` with the columns of their source's row; a source of any share of the rows isn't one task."""
    if n_sources <= BROADCAST_SOURCES:
        same = docs["_source"].eqNullSafe(sources["source"])
        return docs.join(F.broadcast(sources), same).drop("source")
    salted = docs.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    each = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(each, salted["_source"].eqNullSafe(each["source"]) & (salted["_salt"] == each["salt"])).drop("source", "salt", "_salt")


def cuts(scratch: Scratch, rows: DataFrame, n_rows: int) -> tuple[DataFrame, int]:
    """Of each source: source, words, target, whole (epochs), cut_key, cut_take and cut_words; and how many sources there are.

    ``rows`` are (_source, _key, _size). Of documents with a smaller key the last epoch takes all words, of those at
    ``cut_key``, which have ``cut_words`` together, it takes ``cut_take``.
    """
    found = scratch.save(rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("words")), "sources")
    ranked = numbered(scratch, found, [F.col("source").asc_nulls_last()], "ranked", rows=rows_of(found))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("nth") % len(WEIGHTS) + 1).cast("int"))
    shared = targets(ranked.withColumn("weight", weight)).withColumn("budget", F.floor("target").cast("long"))
    some = F.greatest(F.col("words"), F.lit(1))
    shared = shared.select("source", "words", "target", F.expr("budget div greatest(words, 1)").alias("whole"), (F.col("budget") % some).alias("rest"))
    shared = scratch.save(shared, "targets", rows=rows_of(found))
    n_sources = rows_of(shared)

    bits = min(24, max(0, (n_rows // RANGE_ROWS).bit_length()))
    ranges = rows.select("_source", F.shiftright("_key", KEY_BITS - bits).alias("range"), "_key", "_size")
    sums = ranges.groupBy("_source", "range").agg(F.sum("_size").alias("size"))
    in_order = Window.partitionBy("_source").orderBy("range")
    owning = sums.withColumn("before", F.sum("size").over(in_order) - F.col("size")).join(shared, F.col("_source").eqNullSafe(F.col("source")))
    owning = owning.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
    owning = scratch.save(owning.select("source", F.col("range").alias("own"), (F.col("rest") - F.col("before")).alias("rest")), "ranges", rows=n_sources)

    # the rows of owning ranges only: equal keys are one, and the prefix sum within finds the key that owns the cut
    near = F.broadcast(owning) if n_sources <= BROADCAST_SOURCES else owning
    inside = ranges.join(near, F.col("_source").eqNullSafe(F.col("source")) & (F.col("range") == F.col("own")))
    keys = inside.groupBy("source", "_key", "rest").agg(F.sum("_size").alias("cut_words"))
    keys = keys.withColumn("before", F.sum("cut_words").over(Window.partitionBy("source").orderBy("_key")) - F.col("cut_words"))
    keys = keys.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("cut_words")))
    keys = keys.select(F.col("source").alias("at"), F.col("_key").alias("cut_key"), (F.col("rest") - F.col("before")).alias("cut_take"), "cut_words")
    out = shared.join(keys, F.col("source").eqNullSafe(F.col("at")), "left").drop("at", "rest")
    return scratch.save(out, "cuts", rows=n_sources), n_sources


def _last() -> Column:
    """Words that the last epoch takes of a document."""
    share = F.expr("(2 * _size * cut_take + cut_words) div (2 * cut_words)")
    return F.when(F.col("_key") < F.col("cut_key"), F.col("_size")).when(F.col("_key") == F.col("cut_key"), share).otherwise(F.lit(0)).cast("long")


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, whole_rows: bool) -> DataFrame:
    """Each row with its source's targets and cut, and ``last``; with the row itself as ``doc`` if wanted."""
    scratch = Scratch(docs.sparkSession, "mix")
    doc_id, text = F.col(id_col), F.col(text_col)
    keyed = docs.select(F.struct("*").alias("doc"), doc_id.alias("doc_id"), F.col(source_col).alias("_source"), random_key(doc_id, text, seed).alias("_key"), words(text).alias("_size"))
    rows = scratch.save(keyed.drop("doc"), "rows")
    found, n_sources = cuts(scratch, rows.drop("doc_id"), rows_of(rows))
    return by_source(keyed if whole_rows else rows, found, n_sources).withColumn("last", _last())


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """Columns doc_id, size, source_size, target, taken, source of each row: what the mix takes, without texts."""
    rows = _planned(docs, id_col, text_col, source_col, seed, whole_rows=False)
    taken = F.col("whole") * F.col("_size") + F.col("last")
    return rows.select("doc_id", F.col("_size").alias("size"), F.col("words").alias("source_size"), "target", taken.alias("taken"), F.col("_source").alias("source"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The mixed corpus: a row of ``docs`` for each epoch that takes words of it, with ``mix_epoch`` (from 1) and ``mix_words``.

    The text of a document at the cut ends after its last word taken; all other texts are whole.
    """
    rows = _planned(docs, id_col, text_col, source_col, seed, whole_rows=True)
    epochs = F.col("whole") + F.when(F.col("last") > 0, 1).otherwise(0)
    rows = rows.where((epochs > 0) & (F.col("_size") > 0)).withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), epochs)))
    taken = F.when(F.col("epoch") > F.col("whole"), F.col("last")).otherwise(F.col("_size"))
    text = F.col(f"doc.`{text_col}`")
    # words with the white space behind them; what stands before the first word is a part of its own
    parts = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    ahead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    begun = F.rtrim(F.array_join(F.slice(parts, F.lit(1), (taken + ahead).cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))
    cut = F.when(taken < F.col("_size"), begun).otherwise(text)
    own = [cut.alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns if c not in ("mix_epoch", "mix_words")]
    return rows.select(*own, F.col("epoch").alias("mix_epoch"), taken.alias("mix_words"))
