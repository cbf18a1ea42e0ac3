"""Centroid clustering in exact integers, with Hamerly's two bounds a vector.

Components become integers floor(``SCALE`` * x). The first centroids are the vectors of least hash; each of
``rounds`` rounds assigns every vector to its nearest centroid (squared Euclidean distance, ties to the
smaller number) and moves every centroid that has vectors to floor(sum / count) of each component.
Then vectors are assigned once more.

A vector's row carries its centroid, an upper bound of the distance to it and a lower bound of the distance to the
second nearest. When centroids move, the bounds are loosened by how far: the upper by its own centroid's drift, the
lower by the largest drift of another. While the upper is below the lower the centroid can't have changed, and no
distance is computed. Otherwise the upper bound is first made exact, and vectors that stay ambiguous are
compared with all centroids in integers. Bounds are kept a little looser than doubles are
exact, so they never decide a tie. A round is one pass over the vectors: rows are written to the shared folder
with their new bounds, and each task adds the sums and counts of the vectors that moved. Only those sums
(centroids x dimensions) reach the driver.

Integers of any size are exact: vectors with components above ``SMALL`` are compared in Python's integers,
and sums travel as digits to the base 2^32. A distance or inertia that a long can't hold is null.

Defined results: vectors that are null, of another number of components, or with a null or non-finite component are
left out; fewer kept vectors than k give so many centroids; equal vectors may be several first
centroids, and the smaller number then takes all; null ids hash as the empty string and ties of the hash are broken by id and
components; repeated rows each count; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, run_batches

_log = logging.getLogger(__name__)

#: Components are multiplied by this before they are rounded down.
SCALE = 1024
#: The largest component whose squared distances surely fit 64 bits: 64 dimensions * (2 * 2^27)^2 = 2^62.
SMALL = 1 << 27
#: Base of the digits that sums travel in.
BASE = 1 << 32
LONG = (1 << 63) - 1
#: Bounds are loosened by this, relative and absolute, over what doubles lose.
SLACK = 1e-12
_ROW = "vec_id, v array<long>, x array<double>, cluster int, up double, low double, distance long"
_SUM = "of int, pos int, digit int, amount long"
#: Positions of a centroid's counter of vectors, and of the number of full scans.
COUNT, SCANS = -1, -2


def _wider(d):
    return d * (1 + SLACK) + SLACK


def _root(d: int) -> float:
    try:
        return math.sqrt(d)
    except OverflowError:
        return math.inf


def integers(x: list[float]) -> list[int]:
    """floor(SCALE * x) of each component, exact also where the product leaves the doubles."""
    return [math.floor(SCALE * e) if abs(e) < 1e300 else SCALE * int(e) for e in x]


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one vector or to as many; of 64-bit or of Python integers."""
    d = v - c
    return np.einsum("ij,ij->i", d, d) if d.dtype != object else (d * d).sum(axis=1)


def all_distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.stack([squared(v, c) for c in centroids], axis=1)


def drifts(old: list[list[int]] | None, new: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """How far each centroid has moved, and the farthest of the others."""
    k = len(new)
    own = np.array([_wider(_root(sum((a - b) ** 2 for a, b in zip(p, q)))) for p, q in zip(old or new, new)])
    others = np.array([max([own[j] for j in range(k) if j != i], default=0.0) for i in range(k)])
    return own, others


def assign(v: np.ndarray, cluster: np.ndarray, up: np.ndarray, low: np.ndarray, centroids: np.ndarray, own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New (cluster, up, low) of rows of 64-bit integers, and how many were compared with all centroids."""
    cluster, at = cluster.copy(), np.maximum(cluster, 0)
    up, low = up + own[at], low - others[at]
    doubt = np.flatnonzero(~(up < low) | (cluster < 0))
    held = doubt[cluster[doubt] >= 0]
    up[held] = _wider(np.sqrt(squared(v[held], centroids[cluster[held]]).astype(float)))
    doubt = doubt[~(up[doubt] < low[doubt]) | (cluster[doubt] < 0)]
    if len(doubt):
        d = all_distances(v[doubt], centroids)
        nearest = d.argmin(axis=1)  # the first of equals
        first = d[np.arange(len(doubt)), nearest].astype(float)
        d = d.astype(float)
        d[np.arange(len(doubt)), nearest] = np.inf
        cluster[doubt], up[doubt] = nearest, _wider(np.sqrt(first))
        low[doubt] = np.sqrt(d.min(axis=1)) * (1 - SLACK) - SLACK
    return cluster, up, low, len(doubt)


def digits(total: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of ``total`` to the base 2^32; the last digit carries the sign."""
    place = 0
    while not -BASE <= total < BASE:
        total, digit = divmod(total, BASE)
        yield place, digit
        place += 1
    yield place, total


class Sums:
    """What a task's moved vectors change in the sums and counts of centroids."""

    def __init__(self, k: int, dims: int):
        self.small, self.large = np.zeros((k, dims), np.int64), [[0] * dims for _ in range(k)]
        self.count, self.scans = [0] * k, 0

    def move(self, v: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        moved = np.flatnonzero(old != new)
        for sign, where in ((1, new[moved]), (-1, old[moved])):
            for j in np.unique(where[where >= 0]):
                rows = moved[where == j]
                self.count[j] += sign * len(rows)
                if v.dtype == object:
                    self.large[j] = [a + sign * int(b) for a, b in zip(self.large[j], v[rows].sum(axis=0))]
                else:
                    self.small[j] += sign * v[rows].sum(axis=0)

    def rows(self) -> list[tuple[int, int, int, int]]:
        out = [(-1, SCANS, 0, self.scans)]
        for j, n in enumerate(self.count):
            sums = [int(a) + b for a, b in zip(self.small[j], self.large[j])]
            out += [(j, pos, place, d) for pos, total in [(COUNT, n), *enumerate(sums)] if total for place, d in digits(total)]
        return out


def _long(d) -> int | None:
    return int(d) if d <= LONG else None


def _round(state: DataFrame, centroids: list[list[int]], before: list[list[int]] | None, last: bool) -> DataFrame:
    """One pass: rows with new bounds, and rows of sums. ``last``: with each row's exact distance."""
    k, dims = len(centroids), len(centroids[0])
    own, others = drifts(before, centroids)
    exact = np.array(centroids, dtype=object)
    whole = np.array(centroids, np.int64) if all(abs(e) <= SMALL for c in centroids for e in c) else None
    kinds = dict(zip(("cluster", "up", "low", "distance", "of", "pos", "digit", "amount"), (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())))
    id_type = state.schema["vec_id"].dataType.simpleString()

    def run(batches):
        sums, kind = Sums(k, dims), None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, n = batch.schema, batch.num_rows
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            old, up, low = (column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "up", "low"))
            new, up, low, distance = old.copy(), up.copy(), low.copy(), [None] * n
            large = column("v").is_null().to_numpy(zero_copy_only=False)
            slow = np.flatnonzero(large if whole is not None else np.ones(n, bool))
            fast = np.setdiff1d(np.arange(n), slow, assume_unique=True)
            if len(fast):
                v = column("v").take(pa.array(fast)).flatten().to_numpy().reshape(-1, dims)
                new[fast], up[fast], low[fast], scans = assign(v, old[fast], up[fast], low[fast], whole, own, others)
                sums.scans += scans
                sums.move(v, old[fast], new[fast])
                if last:
                    for i, d in zip(fast, squared(v, whole[new[fast]])):
                        distance[i] = int(d)
            if len(slow):  # integers of any size: no bounds, all centroids
                v = np.array([integers(column("x")[int(i)].as_py()) if large[i] else column("v")[int(i)].as_py() for i in slow], dtype=object)
                d = all_distances(v, exact)
                new[slow], up[slow], low[slow] = d.argmin(axis=1), np.inf, 0.0
                sums.scans += len(slow)
                sums.move(v, old[slow], new[slow])
                if last:
                    for i, row in zip(slow, d):
                        distance[i] = _long(min(row))
            made = [pa.array(a, t) for a, t in zip((new, up, low, distance, *[[None] * n] * 4), kinds.values())]
            yield pa.RecordBatch.from_arrays([column("vec_id"), column("v"), column("x"), *made], ["vec_id", "v", "x", *kinds])
        if kind is not None:
            rows = sums.rows()
            none = [pa.nulls(len(rows), kind.field(c).type) for c in ("vec_id", "v", "x")] + [pa.nulls(len(rows), t) for t in list(kinds.values())[:4]]
            yield pa.RecordBatch.from_arrays(none + [pa.array([r[i] for r in rows], t) for i, t in enumerate(list(kinds.values())[4:])], ["vec_id", "v", "x", *kinds])

    return run_batches(state, run, f"vec_id {id_type}, {_ROW.partition(', ')[2]}, {_SUM}")


def _vectors(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """Kept vectors: small ones as integers, others as they are."""
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("vec_id"), vector.alias("x")).where(F.size("x") == dims)
    rows = rows.where(~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(math.inf))))
    large = F.exists("x", lambda e: F.abs(e) >= SMALL // SCALE)
    v = F.when(~large, F.transform("x", lambda e: F.floor(e * SCALE).cast("long")))
    state = [F.lit(-1).alias("cluster"), F.lit(math.inf).alias("up"), F.lit(0.0).alias("low")]
    return rows.select("vec_id", v.alias("v"), F.when(large, F.col("x")).alias("x"), *state)


def cluster_vectors(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", report: list[int] | None = None) -> DataFrame:
    """Columns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector.

    ``report`` gets the number of vectors that each pass compared with all centroids.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "clusters")
    state = scratch.save(_vectors(df, id_col, vector_col, dims), "vectors")
    own = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.select("vec_id", "v", "x", own.alias("h")).orderBy("h", "vec_id", "v", "x").limit(k).collect()  # k rows
    centroids = [list(r.v) if r.v else integers(r.x) for r in first]
    if not centroids:
        return state.select("vec_id", "cluster", *[F.lit(None).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit(None).cast("string").alias("centroid_sha256"))
    sums, counts, before = [[0] * dims for _ in centroids], [0] * len(centroids), None
    for r in range(rounds + 1):
        done = scratch.save(_round(state, centroids, before, r == rounds), f"round{r}")
        scratch.drop(state)
        state, scans, before = done.where(F.col("of").isNull()), 0, [list(c) for c in centroids]
        state._spanguard_path = done._spanguard_path
        found = done.where(F.col("of").isNotNull()).groupBy("of", "pos", "digit").agg(F.sum(F.col("amount").cast("decimal(20,0)")).alias("amount"))
        for s in found.collect():  # centroids x (dimensions + 1) x digits
            amount = int(s.amount) * BASE**s.digit
            if s.pos == SCANS:
                scans += amount
            elif s.pos == COUNT:
                counts[s.of] += amount
            else:
                sums[s.of][s.pos] += amount
        if r < rounds:
            centroids = [[t // n for t in sums[j]] if (n := counts[j]) else c for j, c in enumerate(centroids)]
        _log.info("pass %d: %d full scans", r, scans)
        if report is not None:
            report.append(scans)
    inertia = {r.cluster: None if r.missing else int(r.total) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("missing")).collect()}
    total = None if None in inertia.values() else _long(sum(inertia.values()))
    facts = [(j, None if (t := inertia.get(j)) is None else _long(t), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return state.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
