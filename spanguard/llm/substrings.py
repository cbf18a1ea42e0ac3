"""Removal of long byte strings that occur more than once, by prefix-free parsing.

Triggers: in every string of ``length`` bytes, the first of its ``TRIGGER``-byte substrings with
the least rolling hash is a trigger, so equal strings have equal triggers at equal places and
every string of that length has one. A phrase holds a trigger and all window positions that
have it as theirs, with the ``length - 1`` bytes behind the last: phrases overlap, and no window
lies in two. Then

1. the dictionary counts each distinct phrase over the corpus; all windows of a phrase that
   occurs twice are repeated, and a trigger string that occurs once has no repeated window;
2. only distinct phrases around the same trigger string can share some windows and not others:
   their suffixes, cut at ``length`` bytes, are ranked against each other. Only the equality of
   two such suffixes counts, so fingerprints stand for their ranks in the suffix order, and no
   task has to hold the order of a trigger string's phrases, however many they are;
3. repeated windows become spans of each document, and the spans are cut out.

Phrases are told apart by two unlike hashes, 64 bits each (a polynomial of the trigger, xxh3 of all
bytes), blocks and windows of wide groups by 128 bits of xxh3 and the trigger. Suffixes that a task ranks are
first matched by a rolling hash, and every match is then confirmed byte by byte.

Texts are strings of bytes or, for passages, of words: runs of bytes that aren't white space, each
a 64-bit hash. A passage of over 50 words that repeats is then a repeated string of 51 units,
however many bytes it has and whatever white space stands between its words.

Defined results: a null text is empty; texts shorter than ``length`` keep everything; matches
never cross documents; a copied document loses all that it has in windows; repeated rows count
as further occurrences; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import Scratch, map_batches, rows_of, run_batches

LENGTH, TRIGGER = 400, 100
#: Window starts in a piece of a long text, and bytes that are hashed together.
PIECE, BUFFER = 1 << 18, 1 << 20
_BITS = 21
#: Bytes that a unit has in what is compared.
ITEM = {"bytes": 1, "words": 8}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_r = np.random.default_rng(20240229)
_BYTE = _r.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Roller:
    """Rolling hashes of a buffer of at most ``BUFFER + PIECE + length`` units: bytes, or 64-bit hashes of words."""

    def __init__(self, length: int):
        n = BUFFER + PIECE + 2 * length + 1
        self.pw, self.inverse = _powers(_BASE, n), _powers(_BASE_INVERSE, n)

    def load(self, raw: np.ndarray) -> None:
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_BYTE[raw] if raw.dtype == np.uint8 else raw) * self.pw[: len(raw)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def all(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, from prefix and suffix minima of blocks."""
    n = len(x) - w + 1
    full = np.full(-(-len(x) // w) * w, np.uint64(2**64 - 1))
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end."""
    space = np.concatenate(([True], _SPACE[np.frombuffer(raw, np.uint8)], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_values(raw: bytes, roller: Roller) -> np.ndarray:
    """A 64-bit hash of each word; of those longer than a buffer it is xxh3."""
    (start, end), i = word_bounds(raw), 0
    out = np.empty(len(start), np.uint64)
    while i < len(start):
        j = int(np.searchsorted(end, start[i] + BUFFER, "right"))
        if j > i:
            roller.load(np.frombuffer(raw, np.uint8, end[j - 1] - start[i], start[i]))
            out[i:j] = roller.hash(start[i:j] - start[i], end[i:j] - start[i])
        else:
            out[i], j = xxhash.xxh3_64_intdigest(memoryview(raw)[start[i] : end[i]]), i + 1
        i = j
    return out


def units_of(text: str | None, unit: str, roller: Roller) -> bytes:
    """A text as the bytes of its units."""
    raw = (text or "").encode()
    return word_values(raw, roller).tobytes() if unit == "words" else raw


def _array(raw: bytes, item: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if item == 1 else np.uint64)


def buffers(texts: list[bytes], length: int, item: int = 1):
    """Pieces (text number, first window start, window starts) with the units they need, packed in buffers."""
    pieces, parts, size = [], [], 0
    for i, raw in enumerate(texts):
        n = len(raw) // item
        for s in range(0, n - length + 1, PIECE):
            m = min(PIECE, n - length + 1 - s)
            pieces.append((i, s, m, size))
            parts.append(raw[s * item : (s + m + length - 1) * item])
            size += m + length - 1
            if size >= BUFFER:
                yield pieces, b"".join(parts)
                pieces, parts, size = [], [], 0
    if pieces:
        yield pieces, b"".join(parts)


def phrases(texts: list[bytes], roller: Roller, length: int = LENGTH, k: int = TRIGGER, item: int = 1):
    """Arrays text number, lo, hi (first and last window), trigger offset, trigger hash, phrase hash."""
    for pieces, raw in buffers(texts, length, item):
        roller.load(_array(raw, item))
        grams = roller.all(k)
        key = (grams & ~np.uint64((1 << _BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_min(key, length - k + 1) & np.uint64((1 << _BITS) - 1)).astype(np.int64)
        who, first, count, base = (np.array(c) for c in zip(*pieces))
        begin = np.zeros(len(at), bool)
        inside = np.zeros(len(at) + 1, np.int8)
        np.add.at(inside, base, 1)
        np.add.at(inside, base + count, -1)
        valid = np.cumsum(inside[:-1]).astype(bool)
        begin[1:] = at[1:] != at[:-1]
        begin[base] = True
        lo = np.flatnonzero(begin & valid)
        piece = np.searchsorted(base, lo, "right") - 1
        stop = np.append(lo[1:], len(at))
        hi = np.minimum(stop, (base + count)[piece]) - 1
        shift = first[piece] - base[piece]
        view = memoryview(raw)
        whole = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip((lo * item).tolist(), ((hi + length) * item).tolist())), np.uint64, len(lo))
        yield who[piece], lo + shift, hi + shift, at[lo] - lo, grams[at[lo]], whole


def window_hashes(text: bytes, lo: int, hi: int, roller: Roller, length: int = LENGTH, item: int = 1) -> np.ndarray:
    """Fingerprints of the windows lo to hi of a text."""
    roller.load(_array(text[lo * item : (hi + length) * item], item))
    return roller.all(length)


#: Distinct phrases of a trigger string up to which one task ranks them together.
GROUP = 256
#: Windows of a block, where there are more.
BLOCK = 12
_PHRASES = "doc_id long, th long, lo int, hi int, off int, kh long, ph long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def phrase_rows(rows: DataFrame, length: int, unit: str = "bytes") -> DataFrame:
    """The parse of all texts: one row for each phrase of each document."""

    def make():
        roller = Roller(length)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [units_of(t, unit, roller) for t in batch.column("text").to_pylist()]
            found = list(phrases(texts, roller, length, _trigger(length), ITEM[unit]))
            who, lo, hi, off, kh, ph = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
            own = lambda name: batch.column(name).take(pa.array(who))
            ph = mix(ph + off.astype(np.uint64) * np.uint64(1000003) + (hi - lo).astype(np.uint64))
            return pa.RecordBatch.from_arrays([own("doc_id"), own("th"), *(pa.array(x.astype(np.int32)) for x in (lo, hi, off)), _signed(kh), _signed(ph)], names=["doc_id", "th", "lo", "hi", "off", "kh", "ph"])

        return step

    return map_batches(rows, make, _PHRASES)


def _trigger(length: int) -> int:
    return max(1, length // 4)


def _block(length: int) -> int:
    """Windows of a block: they must have units in common."""
    return min(BLOCK, max(1, length // 4))


def _runs(p: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    if not len(p):
        return []
    cut = np.flatnonzero(np.diff(p) != 1)
    return list(zip(p[np.append(0, cut + 1)].tolist(), p[np.append(cut, len(p) - 1)].tolist()))


def _same_bytes(held: list, begin: np.ndarray, owner: np.ndarray, like: np.ndarray, twice: np.ndarray, length: int, item: int) -> bool:
    """Whether each window that is said to be like another (``like``: its number) has the same bytes, a run of windows at a time."""
    at = np.flatnonzero(twice & (like != np.arange(len(like))))
    if not len(at):
        return True
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(like[at]) != 1) | (np.diff(owner[at]) != 0) | (np.diff(owner[like[at]]) != 0)) + 1
    for i, j in zip(at[np.append(0, cut)].tolist(), at[np.append(cut, len(at)) - 1].tolist()):
        p, q = owner[i], owner[like[i]]
        x, y = i - begin[p], like[i] - begin[q]
        n = (j - i + length) * item
        if held[p][7][x * item : x * item + n] != held[q][7][y * item : y * item + n]:
            return False
    return True


def _ranked(phr: DataFrame, length: int, item: int) -> DataFrame:
    """Repeated windows of phrases seen once, where a task has all phrases of a trigger string."""

    def run(batches):
        roller, held = Roller(length), []

        def finish() -> pa.RecordBatch:
            sizes = [hi - lo + 1 for doc, th, lo, hi, off, kh, n, raw in held]
            begin = np.append(0, np.cumsum(sizes))
            places = [(off - np.arange(m)).astype(np.uint64) for (doc, th, lo, hi, off, kh, n, raw), m in zip(held, sizes)]
            keys = np.concatenate([mix(window_hashes(h[7], 0, m - 1, roller, length, item) + o * np.uint64(1000003)) for h, m, o in zip(held, sizes, places)])
            _, first, back, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            owner = np.repeat(np.arange(len(held)), sizes)
            if not _same_bytes(held, begin, owner, first[back], times[back] > 1, length, item):
                ids: dict = {}
                back = np.array([ids.setdefault((int(o[i]), h[7][i * item : (i + length) * item]), len(ids)) for h, m, o in zip(held, sizes, places) for i in range(m)])
                times = np.bincount(back)
            twice, out = times[back] > 1, []
            for (doc, th, lo, hi, off, kh, n, raw), at, m in zip(held, begin, sizes):
                if n == 1:
                    out += [(doc, th, lo + a, lo + b) for a, b in _runs(np.flatnonzero(twice[at : at + m]))]
            cols = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "th", "lo", "hi"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][5] != row[5]:
                    yield finish()
                    held = []
                held.append(row)
        if held:
            yield finish()

    cols = ["doc_id", "th", "lo", "hi", "off", "kh", "n", "raw"]
    return run_batches(phr.repartition("kh").sortWithinPartitions("kh").select(*cols), run, "doc_id long, th long, lo int, hi int")


def _blocks(phr: DataFrame, length: int, item: int) -> DataFrame:
    """A row for each block of windows of a phrase, where a trigger string has too many for one task.

    ``core`` is the fingerprint of what all windows of the block have in common, ``bh`` that of all
    their bytes, ``w`` has the windows' own.
    """

    size = _block(length)

    def make():
        def digest(raw: bytes, *place: int) -> bytes:
            return xxhash.xxh3_128_digest(b"%d,%d," % place + raw)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for doc, th, lo, hi, off, kh, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "lo", "hi", "off", "kh", "n", "raw"))):
                o = off - np.arange(hi - lo + 1)
                w = [digest(raw[i * item : (i + length) * item], off - i, 0) for i in range(len(o))]
                block = o // size
                at = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                to = np.append(at[1:], len(o))
                for i, j, b in zip(at.tolist(), to.tolist(), block[at].tolist()):
                    start = off - b * size  # a phrase's first and last block may lack windows, but have the core
                    core = digest(raw[start * item : (start - size + 1 + length) * item], b, -1)
                    out.append((doc, th, kh, core, digest(raw[i * item : (j - 1 + length) * item], off - i, j - i), lo + i, lo + j - 1, n, w[i:j]))
            kinds = (*[pa.int64()] * 3, pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "th", "kh", "core", "bh", "lo", "hi", "n", "w"])

        return step

    return map_batches(phr, make, "doc_id long, th long, kh long, core binary, bh binary, lo int, hi int, n long, w array<binary>")


def _wide(phr: DataFrame, scratch: Scratch, length: int, item: int) -> DataFrame:
    """Repeated windows of phrases seen once, by blocks first and then by the windows of what is left.

    A block whose bytes occur twice is repeated as a whole, one whose core occurs once has no
    repeated window. A phrase at the edge of a passage keeps one block for the last step.
    """
    each = scratch.save(_blocks(phr, length, item), "blocks")
    words = scratch.save(each.groupBy("kh", "core", "bh").agg(F.count("*").alias("m"), F.min(F.struct("doc_id", "th", "lo", "n", "w")).alias("rep")), "block-words", rows_of(each))
    whole = _without(each.where("n = 1"), words.where("m = 1").select("rep.doc_id", "rep.th", "rep.lo")).select("doc_id", "th", "lo", "hi")
    cores = words.groupBy("kh", "core").agg(F.count("*").alias("c")).where("c > 1").select("kh", "core")
    left = words.join(scratch.save(cores, "cores", rows_of(words)), ["kh", "core"])
    at = (F.col("rep.lo") + F.col("k")).cast("int")
    single = left.select(F.col("rep"), "kh", ((F.col("m") == 1) & (F.col("rep.n") == 1)).alias("open"), F.posexplode("rep.w").alias("k", "f"))
    single = scratch.save(single.select("rep.doc_id", "rep.th", at.alias("lo"), "kh", "f", "open"), "windows", _block(length) * rows_of(words))
    once = single.groupBy("kh", "f").agg(F.count("*").alias("t"), F.min(F.struct("doc_id", "th", "lo")).alias("rep")).where("t = 1").select("rep.*")
    open_ = _without(single.where("open"), scratch.save(once, "once", rows_of(single)))
    return whole.unionByName(open_.select("doc_id", "th", "lo", F.col("lo").alias("hi")))


def _without(rows: DataFrame, single: DataFrame) -> DataFrame:
    """The rows whose place (doc_id, th, lo) isn't one of ``single``.

    What occurs more than once is what isn't listed as occurring once, and places are dealt evenly
    where a string that occurs very often would meet itself in one task.
    """
    s = single.select(F.col("doc_id").alias("i"), F.col("th").alias("t"), F.col("lo").alias("l"))
    return rows.join(s, rows.doc_id.eqNullSafe(s.i) & (rows.th == s.t) & (rows.lo == s.l), "left_anti")


def repeated_spans(rows: DataFrame, scratch: Scratch, length: int = LENGTH, group: int = GROUP, unit: str = "bytes") -> DataFrame:
    """For each (doc_id, th) the list of runs lo..hi of repeated windows, in units; th is the text's hash."""
    item = ITEM[unit]
    seen = scratch.save(phrase_rows(rows, length, unit), "parse")
    strings = seen.groupBy("kh").agg(F.count("*").alias("m"), (F.min("ph") == F.max("ph")).alias("one")).where("m > 1").drop("m")
    strings = scratch.save(strings, "strings", rows_of(seen))
    hits = scratch.save(seen.join(strings, "kh"), "hits", rows_of(seen))
    scratch.drop(seen, strings)

    mixed = hits.where("not one")
    words = scratch.save(mixed.groupBy("kh", "ph").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "lo", "hi", "off")).alias("rep")), "dictionary", rows_of(hits))
    again = _without(mixed, words.where("n = 1").select("rep.doc_id", "rep.th", "rep.lo"))
    whole = hits.where("one").select("doc_id", "th", "lo", "hi").unionByName(again.select("doc_id", "th", "lo", "hi"))

    many = scratch.save(words.groupBy("kh").agg(F.count("*").alias("g")), "sizes", rows_of(words))
    reps = words.join(many, "kh").select("rep.*", "kh", "n", (F.col("g") > group).alias("large"))
    wanted = reps.groupBy("doc_id", "th").agg(F.collect_list(F.struct("lo", "hi", "off", "kh", "n", "large")).alias("wanted"))
    # a copy of a row would give its phrases again
    texts = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.doc_id) & (rows.th == wanted.th)).select(rows.doc_id, rows.th, "text", "wanted")
    phr = scratch.save(map_batches(texts, lambda: _cut_phrases(length, unit), "doc_id long, th long, lo int, hi int, off int, kh long, n long, large boolean, raw binary").dropDuplicates(["doc_id", "th", "lo"]), "phrases", 10 * rows_of(words))
    local = _ranked(phr.where("not large"), length, item)

    wide = _wide(phr.where("large").repartition("doc_id", "lo"), scratch, length, item)
    return whole.unionByName(local).unionByName(wide).groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))


def _cut_phrases(length: int, unit: str):
    roller, item = Roller(length), ITEM[unit]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc, th, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "wanted"))):
            raw = units_of(text, unit, roller)
            out += [(doc, th, w["lo"], w["hi"], w["off"], w["kh"], w["n"], w["large"], raw[w["lo"] * item : (w["hi"] + length) * item]) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        names = ["doc_id", "th", "lo", "hi", "off", "kh", "n", "large", "raw"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return step


def spans_of(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Spans of units that the windows of the runs cover, merged."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in runs or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return [tuple(s) for s in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, group: int = GROUP) -> DataFrame:
    """Rows doc_id, n_bytes, n_removed, n_spans, spans and kept text (bytes), or its SHA-256 as kept_sha256."""
    scratch = Scratch(docs.sparkSession, "repeats")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    runs = repeated_spans(rows.where(F.octet_length("text") >= length), scratch, length, group)
    runs = scratch.save(runs.withColumnsRenamed({"doc_id": "i", "th": "h"}), "runs")
    scratch.clear(runs)
    both = rows.join(runs, rows.doc_id.eqNullSafe(runs.i) & (rows.th == runs.h), "left").select("doc_id", "text", "runs")
    last = ("kept_sha256", pa.string()) if digests else ("kept", pa.binary())

    def make():
        def one(text: str, runs):
            raw = text.encode()
            spans = spans_of(runs, length)
            kept, at = [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            return len(raw), len(raw) - len(kept), len(spans), [{"start": a, "stop": b} for a, b in spans], hashlib.sha256(kept).hexdigest() if digests else kept

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [one(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "runs")))]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), last[1])
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", last[0]])

        return step

    out = map_batches(both, make, f"doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: int, stop: int>>, {last[0]} {'string' if digests else 'binary'}")
    return out.drop("spans") if digests else out


def _byte_spans(raw: bytes, runs: list[dict], length: int, unit: str) -> list[tuple[int, int]]:
    """What to cut: whole characters of repeated bytes, or repeated words with the white space behind them."""
    spans = spans_of(runs, length)
    if unit == "words":
        start = np.append(word_bounds(raw)[0], len(raw))
        return [(int(start[a]), int(start[b])) for a, b in spans]
    inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    whole = lambda i: next(k for k in range(i, len(raw) + 1) if not inside(k))
    return [(whole(a), whole(b)) for a, b in spans]


def strip_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", unit: str = "bytes", group: int = GROUP) -> DataFrame:
    """``docs``, all columns, with the repeated strings of ``length`` bytes or words cut out of the text; n_chars, if there, follows.

    Of bytes, a character goes if all its bytes are covered, so the text stays UTF-8. Null texts stay null.
    """
    scratch = Scratch(docs.sparkSession, "strip")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    least = length if unit == "bytes" else 2 * length - 1
    runs = repeated_spans(rows.select("doc_id", "th", "text").where(F.octet_length("text") >= least), scratch, length, group, unit)
    runs = scratch.save(runs.withColumnsRenamed({"doc_id": "i", "th": "h"}), "runs")
    scratch.clear(runs)
    both = rows.join(runs, rows.doc_id.eqNullSafe(runs.i) & (rows.th == runs.h), "left").select("row", "text", "runs")

    def make():
        def cut(text: str, runs) -> str:
            if not runs:
                return text
            raw, kept, at = text.encode(), [], 0
            for a, b in _byte_spans(raw, runs, length, unit):
                kept.append(raw[at:a])
                at = b
            return b"".join([*kept, raw[at:]]).decode()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [cut(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())]
            return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "cut"])

        return step

    out = map_batches(both, make, StructType([both.schema["row"], StructField("cut", StringType())]))
    new = F.when(F.col(f"row.{text_col}").isNotNull(), F.col("cut"))
    changed = {text_col: new, "n_chars": F.when(F.col("row.n_chars").isNotNull(), F.coalesce(F.length(new), F.lit(0))).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[(changed.get(c) if changed.get(c) is not None else F.col("row")[c]).alias(c) for c in docs.columns])
