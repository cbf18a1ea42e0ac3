"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, rows_of


def components(edges: DataFrame, scratch: Scratch, rows: int | None = None) -> DataFrame:
    """Rows node, root for every node of ``edges`` (u, v): the root is its component's least node.

    Each round is two aggregations and a join, written to the shared folder; the number of
    rounds grows with the logarithm of the largest component. Nothing but a count and a
    checksum of a round reaches the driver. ``rows``: a bound of the edges, if one is known.
    """
    at = scratch.save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges", rows)
    sign = None
    while True:
        n = rows_of(at)
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.save(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large", 2 * n)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = scratch.save(small.where("u <> v").distinct(), "edges", 2 * n)
        scratch.drop(at, large)
        at = after
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() if rows_of(at) else None
        if now == sign:
            break
        sign = now
    stars = at.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
