"""Near-duplicate vectors by NN-descent.

Equal vectors of a label are one vertex with a multiplicity. Neighbour lists begin with the best
of small blocks (leaves of random-projection trees, a label at a time) and are refined by
joining neighbours of neighbours: around each vertex, all that list it or are listed by it are
compared with each other, and every one keeps its best. A list full of links is saturated and
doubles, up to ``LONGEST``. Pairs that have met before don't meet again, and only what is nearer
than a list's last is handed on. Rounds end when no link is new. A link that no list has room for has
two saturated ends, so these are compared with each other exactly (``bridge``): each joins the cell
of a vertex that it links with, and of cells in unlike components those are compared whose
centres are near enough for their members to reach the threshold. An audit compares a bounded sample
with all vectors exactly; below ``AUDIT`` recall, more trees and rounds follow, and if four of
them don't reach it, all vertices are bridged, which misses nothing.

Links at the threshold give components. Two linked vectors always share one, so every vector's
links are then counted exactly within its component, between blocks of near vectors, without a
row for each link (``count_links``).

Defined results: a null label, a null or zero vector, and a vector with null, infinite or NaN
components links with nothing; vectors of other lengths than the label's others are only
compared with those of their own length; null ids have component null and kept true; repeated
rows are copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import Scratch, map_batches, rows_of, run_batches
from .components import components

TREES, LEAF, LIST, ROUNDS, BLOCK, AUDIT = 6, 128, 8, 6, 512, 0.99
#: Vectors that are compared with all others to measure recall, at most.
AUDIT_ROWS = 256
#: Length that a saturated list may reach; links beyond it are found by ``bridge``.
LONGEST = 24
_CODE = 40
_log = logging.getLogger(__name__)


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    m = m.astype(np.float64)
    return m / np.sqrt((m * m).sum(1))[:, None]


def _matrix(col: pa.Array) -> np.ndarray:
    values, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    return _unit(values[at[0] : at[-1]].reshape(len(at) - 1, -1))


def _by_group(rows: DataFrame, finish, columns: str, schema: str) -> DataFrame:
    """``finish(columns, matrix of unit vectors)`` of each group g of rows g, ``columns``, v, as one batch of ``schema``."""
    names = ["g", *columns.split()]

    def run(batches):
        held: list = []

        def done():
            cols = {c: np.concatenate([h[0][c] for h in held]) for c in names}
            out = finish(cols, _unit(np.concatenate([h[1] for h in held]).reshape(len(cols["g"]), -1)))
            if out is not None and len(out[0]):
                fields = [f.split() for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}[k]) for x, (_, k) in zip(out, fields)], names=[f for f, _ in fields])

        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            values, at = batch.column("v").values.to_numpy(zero_copy_only=False), batch.column("v").offsets.to_numpy()
            edges = np.flatnonzero(np.diff(cols["g"])) + 1
            for i, j in zip(np.append(0, edges), np.append(edges, len(cols["g"]))):
                if i < j:
                    if held and held[-1][0]["g"][0] != cols["g"][i]:
                        yield from done()
                        held = []
                    held.append(({c: x[i:j] for c, x in cols.items()}, values[at[i] : at[j]]))
        if held:
            yield from done()

    return run_batches(rows.repartition("g").sortWithinPartitions("g").select(*names, "v"), run, schema)


def _codes(vectors: DataFrame, trees: int, seed: int) -> DataFrame:
    """Bits of random hyperplanes for each tree: rows x, part, t, code."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes = np.empty((batch.num_rows, trees), np.int64)
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                m = _matrix(batch.column("v").take(pa.array(rows)))
                for t in range(trees):
                    planes = np.random.default_rng([seed, t, int(d)]).normal(size=(int(d), _CODE))
                    codes[rows, t] = ((m @ planes) > 0) @ (1 << np.arange(_CODE, dtype=np.int64))
            x = np.repeat(np.arange(batch.num_rows), trees)
            return pa.RecordBatch.from_arrays([batch.column("x").take(pa.array(x)), batch.column("part").take(pa.array(x)), pa.array(np.tile(np.arange(trees, dtype=np.int32), batch.num_rows)), pa.array(codes.ravel())], names=["x", "part", "t", "code"])

        return step

    return map_batches(vectors.select("x", "part", "v"), make, "x long, part long, t int, code long")


def _best(groups: DataFrame) -> DataFrame:
    """Rows x, y, s: who of each group g of rows g, x, k, least, fresh, v is nearer to x than ``least``, the best k of them.

    Of two members at least one has to be fresh; the others have met before.
    """

    def finish(cols, m):
        x, k, fresh = cols["x"], cols["k"], cols["fresh"] > 0
        if len(x) < 2:
            return None
        s = m @ m.T
        s[(x[:, None] == x[None]) | ~(fresh[:, None] | fresh[None])] = -2
        top = int(k.max())
        floor = cols["least"]
        if top < len(x):
            floor = np.maximum(floor, np.nextafter(-np.partition(-s, top - 1, 1)[:, top - 1], -3))
        i, j = np.nonzero((s > floor[:, None]) & (s > -2))
        return x[i], x[j], s[i, j]

    return _by_group(groups, finish, "x k least fresh", "x long, y long, s double")


def _merged(found: DataFrame, ks: DataFrame | None = None) -> DataFrame:
    """Lists x, k, l of the best of rows x, y, s, o (1: it was in the list before), no more than k."""
    each = found.groupBy("x", "y").agg(F.max("s").alias("s"), F.max("o").alias("o"))
    lists = each.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("s", "y", "o")), asc=False).alias("l"))
    lists = lists.withColumn("k", F.lit(LIST)) if ks is None else lists.join(ks, "x")
    return lists.select("x", "k", F.slice("l", F.lit(1), F.col("k")).alias("l"))


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("x", F.explode("l").alias("e")).select("x", "e.y", "e.s", F.lit(1).alias("o"))


def _round(lists: DataFrame, vectors: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """One refinement: around each vertex, its new neighbours meet each other and those it had before."""
    pairs = lists.select("x", F.explode("l").alias("e")).select("x", "e.y", (1 - F.col("e.o")).alias("fresh"))
    around = pairs.select(F.col("x").alias("w"), F.col("y").alias("x"), "fresh").unionByName(pairs.select(F.col("y").alias("w"), "x", "fresh"))
    around = scratch.save(around.groupBy("w", "x").agg(F.max("fresh").alias("fresh")), "around", 2 * LONGEST * rows_of(lists))
    sizes = around.groupBy("w").agg(F.count("*").alias("n"), F.max("fresh").alias("any")).where("any = 1 and n > 1")
    sizes = scratch.save(sizes.select("w", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "sizes", rows_of(lists))
    # who is listed by very many meets them in blocks
    groups = around.join(sizes, "w").select(F.xxhash64("w", F.pmod(F.xxhash64("x", "w"), "parts")).alias("g"), "x", "fresh")
    last = F.element_at("l", -1)["s"]
    ks = lists.select("x", F.when((F.size("l") >= F.col("k")) & (last >= threshold), F.least(F.col("k") * 2, F.lit(LONGEST))).otherwise(F.col("k")).alias("k"), F.when(F.size("l") >= F.col("k"), last).otherwise(F.lit(-2.0)).alias("at"))
    ks = scratch.save(ks.select("x", "k", F.when(F.col("at") >= threshold, F.lit(-2.0)).otherwise(F.col("at")).alias("least")), "limits", rows_of(lists))
    found = _best(groups.join(ks.join(vectors.select("x", "v"), "x"), "x")).withColumn("o", F.lit(0))
    return scratch.save(_merged(found.unionByName(_entries(lists)), ks.select("x", "k")), "lists", 4 * rows_of(lists))


def _links(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.select("x", F.explode("l").alias("e")).where(F.col("e.s") >= threshold).select(F.least("x", "e.y").alias("u"), F.greatest("x", "e.y").alias("v")).distinct()


def _sides(cols, m):
    """The members of a group's first and second block."""
    b, c = cols["b"][0], cols["c"][0]
    rows = np.flatnonzero(cols["own"] == b)
    return rows, rows if b == c else np.flatnonzero(cols["own"] == c), b == c


def _cell_pairs(cells: DataFrame, threshold: float) -> DataFrame:
    """Rows p, q, u, v, s: cells and roots whose members may link, in each group g of rows g, b, c, own, cell, root, least, v."""

    def finish(cols, m):
        i, j, same = _sides(cols, m)
        s = m[i] @ m[j].T
        wide = np.arccos(np.clip(cols["least"], -1, 1))
        # the slack is far above the rounding of arccos
        may = np.arccos(np.clip(s, -1, 1)) <= wide[i][:, None] + wide[j][None] + np.arccos(threshold) + 1e-6
        may &= cols["root"][i][:, None] != cols["root"][j][None]
        a, z = np.nonzero(np.triu(may) if same else may)
        return cols["cell"][i[a]], cols["cell"][j[z]], cols["root"][i[a]], cols["root"][j[z]], s[a, z]

    return _by_group(cells, finish, "b c own cell root least", "p long, q long, u long, v long, s double")


def _linked_cells(sides: DataFrame, threshold: float) -> DataFrame:
    """Rows g of the groups of rows g, first, v in which a vector of the first cell links with one of the second."""

    def finish(cols, m):
        first = cols["first"] > 0
        return [cols["g"][: int(bool((m[first] @ m[~first].T >= threshold).any()))]]

    return _by_group(sides, finish, "first", "g long")


def _spread(cells: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """Rows of ``cells`` dealt to blocks of their ``key``, a copy in the group g of each pair b, c of blocks."""
    spread = cells.join(blocks, key).withColumn("own", F.pmod(F.xxhash64("cell", F.lit(6)), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.withColumn("b", F.least("own", "other")).withColumn("c", F.greatest("own", "other")).withColumn("g", F.xxhash64(key, "b", "c"))


def bridge(lists: DataFrame, vectors: DataFrame, roots: DataFrame, scratch: Scratch, threshold: float, whole: bool = False) -> DataFrame:
    """``roots`` joined by all links between saturated vertices, or between any if ``whole``."""
    if whole:
        lists = vectors.select("x").join(lists, "x", "left")
        roots = scratch.save(vectors.select(F.col("x").alias("node")).join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    else:
        lists = lists.where((F.size("l") >= F.col("k")) & (F.element_at("l", -1)["s"] >= threshold))
    # the linked vertex of least hash leads, so a cell stays in one component and no member is farther than the threshold
    own = F.struct(F.xxhash64("x").alias("h"), F.col("x").alias("y"), F.lit(1.0).alias("s"))
    linked = F.transform(F.filter("l", lambda e: e["s"] >= threshold), lambda e: F.struct(F.xxhash64(e["y"]).alias("h"), e["y"].alias("y"), e["s"].alias("s")))
    leads = F.when(F.col("l").isNull(), F.array(own)).otherwise(F.concat(F.array(own), linked))
    led = lists.select("x", F.array_min(leads).alias("lead")).select("x", F.col("lead.y").alias("lead"), F.col("lead.s").alias("s"))
    led = scratch.save(led.join(roots, led.x == roots.node).select("x", "lead", "s", "root"), "led")
    parts = led.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    members = scratch.save(led.join(parts, "lead").withColumn("cell", F.xxhash64("lead", F.pmod(F.xxhash64("x", F.lit(5)), "parts"))), "members")
    cells = members.groupBy("cell", "lead", "root").agg(F.min("s").alias("least")).join(vectors.select(F.col("x").alias("lead"), "part", "v"), "lead")
    cells = scratch.save(cells.select("cell", "root", "least", "part", "v"), "cells")
    blocks = cells.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.min("root").alias("a"), F.max("root").alias("z")).where("a <> z").select("part", "blocks")
    pairs = scratch.save(_cell_pairs(_spread(cells, "part", blocks), threshold), "pairs")

    # linked centres join most components, the nearest cells of two components most of the others
    for step in ("centres", "nearest", "rest"):
        if not rows_of(pairs):
            break
        if step == "centres":
            found = pairs.where(F.col("s") >= threshold)
        else:
            some = pairs
            if step == "nearest":
                some = pairs.groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("z")).agg(F.max_by(F.struct("p", "q", "u", "v"), "s").alias("e")).select("e.*")
            some = scratch.save(some.select(F.xxhash64("p", "q").alias("g"), "p", "q", "u", "v"), "some")
            sides = some.select("g", F.lit(1).alias("first"), F.col("p").alias("cell")).unionByName(some.select("g", F.lit(0).alias("first"), F.col("q").alias("cell")))
            sides = sides.join(members.select("cell", "x"), "cell").join(vectors.select("x", "v"), "x")
            found = _linked_cells(sides, threshold).join(some, "g")
        found = scratch.save(found.select("u", "v").distinct(), "bridges")
        if not rows_of(found):
            continue
        names = scratch.save(components(found, scratch).select("node", F.col("root").alias("to")), "names")
        moved = lambda df, c: df.join(names.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        roots = scratch.save(moved(roots, "root"), "roots")
        pairs = scratch.save(moved(moved(pairs, "u"), "v").where("u <> v"), "pairs")
    return roots


def _blocks(members: DataFrame) -> DataFrame:
    """Rows cell, n, mass, least, v: each block's vectors, with multiplicities, and its centre with the least cosine to it."""

    def finish(cols, m):
        centre = m.mean(0)
        size = np.sqrt(centre @ centre)
        centre = centre / size if size > 1e-9 else m[0]
        return [cols["g"][0]], [len(m)], [cols["m"].sum()], [(m @ centre).min()], [centre]

    return _by_group(members.withColumnRenamed("cell", "g"), finish, "m", "g long, n long, mass long, least double, v array<double>").withColumnRenamed("g", "cell")


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """Rows p, q, whole, n, mass: blocks of a component of which some members may link (whole 0) or all do (1).

    What the angles of two centres and of the members farthest from them decide needs no vector.
    """

    def finish(cols, m):
        i, j, same = _sides(cols, m)
        apart = np.arccos(np.clip(m[i] @ m[j].T, -1, 1))
        wide = np.arccos(np.clip(cols["least"], -1, 1))
        reach = wide[i][:, None] + wide[j][None] + 1e-6
        may, whole = apart <= reach + np.arccos(threshold), apart + reach <= np.arccos(threshold)
        a, z = np.nonzero(np.triu(may) if same else may)
        p, q = i[a], j[z]
        return cols["cell"][p], cols["cell"][q], whole[a, z].astype(np.int32), cols["mass"][p], cols["mass"][q]

    return _by_group(blocks, finish, "b c own cell least mass", "p long, q long, whole int, mp long, mq long")


def _count_links(members: DataFrame, threshold: float) -> DataFrame:
    """Rows x, n: weighted links in each group g of rows g, first, last, x, m, v: of the first with the last side."""

    def finish(cols, m):
        i, j = np.flatnonzero(cols["first"]), np.flatnonzero(cols["last"])
        same = len(i) == len(j) and (i == j).all()
        near = m[i] @ m[j].T >= threshold
        if same:
            np.fill_diagonal(near, False)
            return cols["x"], near @ cols["m"]
        return np.append(cols["x"][i], cols["x"][j]), np.append(near @ cols["m"][j], near.T @ cols["m"][i])

    return _by_group(members, finish, "first last x m", "x long, n long")


def count_links(grouped: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """Rows x, n: weighted links of every vertex x with others of its root, from rows root, x, part, m, v.

    A component is dealt to blocks of near vectors (hyperplane codes, split by hash where many are
    equal). Pairs of blocks that can hold no link are left out, pairs of which all members link are
    counted by their masses, and only for the others do vectors meet.
    """
    sizes = scratch.save(grouped.groupBy("root").agg(F.count("*").alias("n")).withColumn("bits", F.least(F.lit(_CODE), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK)))).cast("int")), "sizes", rows_of(grouped))
    coded = grouped.join(sizes, "root")
    small = coded.where("bits = 0").select(F.col("root").alias("g"), F.lit(1).alias("first"), F.lit(1).alias("last"), "x", "m", "v")
    counted = [_count_links(small, threshold)]
    wide = coded.where("bits > 0")
    if sizes.where("bits > 0").isEmpty():
        return counted[0]
    codes = _codes(wide, 1, 77).select("x", "code")
    wide = scratch.save(wide.join(codes, "x").withColumn("leaf", F.xxhash64("root", F.expr("code % shiftleft(1L, bits)"))).select("root", "leaf", "x", "m", "v"), "wide")
    parts = wide.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    members = scratch.save(wide.join(parts, "leaf").withColumn("cell", F.xxhash64("leaf", F.pmod(F.xxhash64("x", F.lit(4)), "parts"))).select("root", "cell", "x", "m", "v"), "members")
    centres = _blocks(members.select("cell", "m", "v")).join(members.select("cell", "root").distinct(), "cell")
    centres = scratch.save(centres, "centres")
    many = centres.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    pairs = scratch.save(_block_pairs(_spread(centres.select("root", "cell", "least", "mass", "v"), "root", many), threshold), "block-pairs")
    sure = pairs.where("whole = 1")
    own = sure.where("p = q").select(F.col("p").alias("cell"), F.col("mp").alias("n"), F.lit(1).alias("self"))
    far = sure.where("p <> q").select(F.inline(F.array(F.struct(F.col("p").alias("cell"), F.col("mq").alias("n")), F.struct(F.col("q").alias("cell"), F.col("mp").alias("n"))))).withColumn("self", F.lit(0))
    sure = scratch.save(own.unionByName(far).groupBy("cell").agg(F.sum("n").alias("n"), F.max("self").alias("self")), "sure", rows_of(centres))
    counted.append(members.join(sure, "cell").select("x", (F.col("n") - F.col("self") * F.col("m")).alias("n")))
    some = pairs.where("whole = 0").select(F.xxhash64("p", "q").alias("g"), "p", "q")
    side = lambda c, first, last: F.struct(F.col(c).alias("cell"), F.lit(first).alias("first"), F.lit(last).alias("last"))
    sides = some.select("g", F.inline(F.when(F.col("p") == F.col("q"), F.array(side("p", 1, 1))).otherwise(F.array(side("p", 1, 0), side("q", 0, 1)))))
    counted.append(_count_links(sides.join(members.select("cell", "x", "m", "v"), "cell").select("g", "first", "last", "x", "m", "v"), threshold))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def audit(vectors: DataFrame, roots: DataFrame, threshold: float) -> float:
    """Share of the links of a bounded sample, found by comparing it with all, whose ends share a root."""
    sample = vectors.orderBy(F.xxhash64("x", F.lit(2))).limit(AUDIT_ROWS).select("x", "part", "v").collect()
    if not sample:
        return 1.0
    by = {}
    for r in sample:
        by.setdefault(r.part, ([], []))[0].append(r.x)
        by[r.part][1].append(r.v)
    by = {p: (np.array(x), np.array(v)) for p, (x, v) in by.items()}

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, parts, xs = [], np.array(batch.column("part").to_pylist()), np.array(batch.column("x").to_pylist())
            for p, (qx, qv) in by.items():
                rows = np.flatnonzero(parts == p)
                if len(rows):
                    i, j = np.nonzero(_matrix(batch.column("v").take(pa.array(rows))) @ qv.T >= threshold)
                    out += [(int(a), int(b)) for a, b in zip(xs[rows[i]], qx[j]) if a != b]
            return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in (0, 1)], names=["x", "q"])

        return step

    true = map_batches(vectors.select("x", "part", "v"), make, "x long, q long")
    rx, rq = roots.select(F.col("node").alias("x"), F.col("root").alias("rx")), roots.select(F.col("node").alias("q"), F.col("root").alias("rq"))
    n, hit = true.join(rx, "x", "left").join(rq, "q", "left").agg(F.count("*"), F.count_if(F.coalesce(F.col("rx") == F.col("rq"), F.lit(False)))).first()
    return hit / n if n else 1.0


def near_vectors(rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows vec_id, n_links, component_id, kept."""
    scratch = Scratch(rows.sparkSession, "vectors")
    kind = rows.schema[vector_col].dataType.elementType
    v = F.col(vector_col) if isinstance(kind, FloatType) else F.transform(F.col(vector_col), lambda e: e.cast("double"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)).where(F.forall("v", fine)).withColumn("size", size).where((F.col("size") > 0) & (F.col("size") < F.lit(float("inf"))))
    keyed = usable.select("vec_id", F.xxhash64("label", "v").alias("x"), F.xxhash64("label", F.size("v")).alias("part"), "v")
    keyed = scratch.save(keyed, "rows")
    classes = scratch.save(keyed.groupBy("x").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("m")), "classes", rows_of(keyed))
    vectors = scratch.save(keyed.join(classes, ["x", "vec_id"]).select("x", "vec_id", "part", "m", "v").dropDuplicates(["x"]), "vectors")
    counts = scratch.save(vectors.groupBy("part").agg(F.greatest(F.lit(0), F.least(F.lit(_CODE), F.ceil(F.log2(F.count("*") / LEAF)))).cast("int").alias("bits")), "labels", rows_of(vectors))

    lists, seed, known = None, 1, -1
    while True:
        coded = _codes(vectors, TREES, seed).join(counts, "part").select("x", F.xxhash64("part", "t", F.expr("code % shiftleft(1L, bits)")).alias("leaf"))
        coded = scratch.save(coded, "leaves")
        sizes = coded.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
        leaf = F.xxhash64("leaf", F.pmod(F.xxhash64("x", "leaf"), "parts")).alias("g")
        groups = coded.join(scratch.save(sizes, "sizes", rows_of(coded)), "leaf").select(leaf, "x", F.lit(LIST).alias("k"), F.lit(-2.0).alias("least"), F.lit(1).alias("fresh"))
        found = _best(groups.join(vectors.select("x", "v"), "x")).withColumn("o", F.lit(0))
        ks = None
        if lists is not None:
            ks = vectors.select("x").join(lists.select("x", "k"), "x", "left").select("x", F.coalesce("k", F.lit(LIST)).alias("k"))
            found = found.unionByName(_entries(lists))
        lists = scratch.save(_merged(found, ks), "lists", 4 * rows_of(vectors))
        for _ in range(ROUNDS):
            now = _links(lists, threshold).count()
            if now == known:
                break
            known = now
            lists = _round(lists, vectors, scratch, threshold)
        roots = scratch.save(components(_links(lists, threshold), scratch), "roots")
        roots = bridge(lists, vectors, roots, scratch, threshold)
        recall = audit(vectors, roots, threshold)
        _log.info("links of the audited vectors that are found: %.4f", recall)
        if recall >= AUDIT:
            break
        if seed >= 4:
            roots = bridge(lists, vectors, roots, scratch, threshold, whole=True)
            break
        seed, known = seed + 1, -1

    grouped = scratch.save(roots.join(vectors, roots.node == vectors.x).select("root", "x", "part", "vec_id", "m", "v"), "grouped", rows_of(vectors))
    sizes = scratch.save(grouped.groupBy("root").agg(F.min("vec_id").alias("component_id")), "components", rows_of(grouped))
    counted = count_links(grouped, scratch, threshold).groupBy("x").agg(F.sum("n").alias("n"))
    named = grouped.select("x", "root").join(sizes.select("root", "component_id"), "root").join(counted, "x", "left").select("x", "n", "component_id")
    named = scratch.save(named, "named", rows_of(grouped))
    per = keyed.select("vec_id", "x").join(classes.select("x", "m", F.col("vec_id").alias("first")), "x").join(named, "x", "left").select("vec_id", "x", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component_id", "first").alias("c"))
    x = F.xxhash64("label", "v")
    per = per.groupBy("vec_id", "x").agg(F.max("n").alias("n"), F.max("c").alias("c")).withColumnRenamed("vec_id", "i")
    # one id may stand on rows that link and rows that don't
    out = rows.select("vec_id", x.alias("key")).join(per, (F.col("vec_id") == F.col("i")) & (F.col("key") == F.col("x")), "left")
    c = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), F.coalesce(F.col("vec_id") == c, F.lit(True)).alias("kept"))
