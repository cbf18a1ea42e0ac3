"""Sharding by sampled splitters, with DataFrame functions only.

The key of a record is the hash of its text, so equal texts are neighbours. A size-weighted
sample of keys (bounded, whatever the input's size) gives quantile boundaries of many more
ranges than shards; every record falls in one range. The ranges are then measured over all
rows, and overfull ones are subdivided at quantiles of their own keys. What stays overfull holds one
text: with very many copies it becomes ranges of its own, which are subdivided by record id. Ranges are packed into shards, largest first, so
that the bytes of the shards are near equal. Copies of a text share a shard unless the text
alone fills more than nine tenths of one.

Defined results: a null text counts as no bytes (size 1, checksum 0); empty input gives empty
output; a null id is a value like any other; repeated rows get a slot each; further columns of
the input are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Sampled keys for each range; the sample has ranges * this many rows at most.
SAMPLE_PER_RANGE = 16
#: Parts that an overfull range is cut into at once.
SUBDIVIDE = 4


def _range_of(key, bounds: list[int]):
    """Number of boundaries at or below ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    step = 1
    while step * 2 <= len(bounds):
        step *= 2
    steps = []
    while step:
        steps.append(step)
        step //= 2

    def walk(at, s):
        return F.when((at + s <= len(bounds)) & (F.get(table, at + s - 1) <= key), at + s).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), walk)


def _pack(units: list[tuple[int, list[int]]], n: int) -> dict[int, int]:
    """Shard of each range: units (bytes, ranges), largest first, to the least loaded shard."""
    loads = [(0, s) for s in range(n)]
    out = {}
    for size, ranges in sorted(units, key=lambda u: (-u[0], u[1])):
        load, s = heapq.heappop(loads)
        heapq.heappush(loads, (load + size, s))
        out.update(dict.fromkeys(ranges, s))
    return out


def shard(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", ranges_per_shard: int = 64) -> DataFrame:
    """Columns doc_id, size, text_crc32, law, shard, slot, grown_shard, range of each row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shard")
    text = F.col(text_col)
    rows = scratch.save(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "rows",
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    n_ranges = n_shards * ranges_per_shard

    # weighted sampling without replacement: the least of exponential variables with rate size
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "h", F.lit(17)), 11) + 1) / F.lit(float(2**53 + 1))
    wanted = n_ranges * SAMPLE_PER_RANGE
    drawn = rows.select((-F.log(u) / F.col("size")).alias("e"), "h").where(F.col("e") < 2 * wanted / max(total, 1))  # about twice as many as wanted
    sample = [r.h for r in drawn.orderBy("e", "h").limit(wanted).collect()]
    sample.sort()
    bounds = sorted({sample[i * len(sample) // n_ranges] for i in range(1, n_ranges)}) if sample else []

    # texts that overfill their range: no more than 2 * n_ranges can be so large
    most_bytes, most_rows = 2 * total / n_ranges, 2 * count / n_ranges
    # ranges that are overfull are subdivided at quantiles of their own keys, until none of several texts is
    parts_of = [F.lit(i / SUBDIVIDE) for i in range(1, SUBDIVIDE)]
    while True:
        ranged = rows.withColumn("r", _range_of(F.col("h"), bounds))
        full = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.min("h").alias("lo"), F.percentile_approx("h", F.array(*parts_of), F.lit(1000)).alias("cuts"))
        full = full.where(((F.col("b") > most_bytes) | (F.col("n") > most_rows))).collect()
        finer = sorted(set(bounds) | {c for g in full for c in g.cuts if c > g.lo})
        if len(finer) == len(bounds):
            break
        bounds = finer
    over = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).where((F.col("b") > most_bytes) | (F.col("n") > most_rows))
    full = {r.r for r in over.collect()}
    heavy = []
    if full:
        heavy = (
            ranged.where(F.col("r").isin(sorted(full)))
            .groupBy("h")
            .agg(F.sum("size").alias("b"), F.count("*").alias("n"))
            .where((F.col("n") > 1) & ((F.col("b") > most_bytes) | (F.col("n") > most_rows)))
            .orderBy("h")
            .collect()
        )
    groups: dict[int, list[int]] = {}
    first, parts = len(bounds) + 1, []
    for g in heavy:
        k = int(max(g.b / most_bytes, g.n / most_rows)) + 1
        parts.append((g.h, first, k))
        groups[g.h] = list(range(first, first + k))
        first += k
    if parts:
        # a long array literal of no more than 2 * n_ranges texts, searched as the boundaries are
        keys = sorted(parts)
        at = _range_of(F.col("h"), [k[0] for k in keys]) - 1
        pick = lambda i: F.get(F.array(*[F.lit(k[i]) for k in keys]), at)
        ranged = ranged.withColumn("r", F.when((at >= 0) & (pick(0) == F.col("h")), pick(1) + F.pmod(F.xxhash64("doc_id", F.lit(3)), pick(2)).cast("int")).otherwise(F.col("r")))

    ranged = scratch.save(ranged, "ranged")
    measured = {r.r: (r.b, r.n) for r in ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    units, grouped = [], set()
    for _, ranges in groups.items():
        ranges = [r for r in ranges if r in measured]
        grouped.update(ranges)
        b = sum(measured[r][0] for r in ranges)
        units += [(b, ranges)] if b <= 0.9 * total / n_shards else [(measured[r][0], [r]) for r in ranges]
    units += [(b, [r]) for r, (b, _) in measured.items() if r not in grouped]
    where = _pack(units, n_shards)
    ahead, placed = [0] * n_shards, []
    for r in sorted(where):
        placed.append((r, where[r], ahead[where[r]]))
        ahead[where[r]] += measured[r][1]
    scratch.drop(rows)

    place = spark.createDataFrame(placed, "r int, shard int, ahead long")  # one row for each range
    slots = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("r").orderBy("h", "doc_id", "size")))
    return slots.join(F.broadcast(place), "r").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("ahead") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("r").alias("range")
    )
