"""Clusters of similar names: each is filed under the first earlier leader that is similar enough, else it leads.

Similarity is twice the longest common subsequence over both lengths, of a name's words in sorted
order (its form). The rule is sequential: whether a name leads depends on all leaders before it. It is kept exactly, but no
task holds more than a bounded part of a group:

- Names of one form share their fate, so forms are clustered, each at its first name's place.
- A group of at most ``SMALL`` forms is one array, clustered in one go; many groups share a task.
- A larger group goes on in rounds. The first forms of it that are undecided, ``SMALL`` at first and twice as many in each
  round up to ``MOST``, are clustered among themselves. Their leaders then meet every undecided form of the group, dealt in
  parts of ``PART`` to all tasks. A form that is similar to one is decided by the first; the others have no leader so far.

So a form meets leaders only, never all forms of its group: where names are alike, few rounds end it. Before two forms are
compared, an upper bound of the common subsequence from their lengths and characters tells whether they can be similar.

Defined results: null names are in no cluster and aren't returned; a null group is a group; names without a word are similar to each
other only; repeated rows are one; names at the same place are ordered by name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions import text as T
from ..scratch import Scratch, rows_of
from ..session import ship

#: Forms of a group that one task clusters, at first and at most (so many that Spark limits groups before it
#: shuffles them), and forms of a large group that meet leaders together.
SMALL, MOST, PART = 250, 1000, 4096
#: Parts of a group whose first forms are found apart.
SALTS = 16
_CLASSES = 64


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    if not a or not b:
        return float(not a and not b)
    # a row of the table as bits: those that are 0 are where the length grows
    at: dict[str, int] = {}
    for i, ch in enumerate(b):
        at[ch] = at.get(ch, 0) | 1 << i
    row = full = (1 << len(b)) - 1
    for ch in a:
        u = row & at.get(ch, 0)
        row = (row + u | row - u) & full
    return 2 * (len(b) - row.bit_count()) / (len(a) + len(b))


def _counts(form: str) -> np.ndarray:
    """Characters by class of code point; what two forms have in common by class is no less than their common subsequence."""
    return np.bincount(np.frombuffer(form.encode("utf-32-le"), np.uint32) % _CLASSES, minlength=_CLASSES).astype(np.int32)


class Leaders:
    """Forms in order that others are compared with."""

    def __init__(self, threshold: float, forms: list[str] = ()):
        self.threshold, self.forms = threshold, []
        self.sizes, self.counts = np.empty(max(len(forms), 8), np.int64), np.empty((max(len(forms), 8), _CLASSES), np.int32)
        for f in forms:
            self.add(f)

    def add(self, form: str) -> int:
        n = len(self.forms)
        if n == len(self.sizes):
            self.sizes, self.counts = np.resize(self.sizes, 2 * n), np.resize(self.counts, (2 * n, _CLASSES))
        self.forms.append(form)
        self.sizes[n], self.counts[n] = len(form), _counts(form)
        return n

    def first(self, form: str) -> int | None:
        """The first leader that is similar enough."""
        n = len(self.forms)
        if not form:
            return next((i for i in np.flatnonzero(self.sizes[:n] == 0) if ratio(form, "") >= self.threshold), None)
        most = np.minimum(self.counts[:n], _counts(form)).sum(axis=1)
        for i in np.flatnonzero(2 * most / (self.sizes[:n] + len(form)) >= self.threshold):
            if ratio(form, self.forms[i]) >= self.threshold:
                return int(i)
        return None


def cluster_forms(forms: list[str], threshold: float) -> list[int]:
    """For each form the place of the one that it is filed under: the sequential rule."""
    leaders, places, out = Leaders(threshold), [], []
    for i, form in enumerate(forms):
        found = leaders.first(form)
        if found is None:
            leaders.add(form)
            places.append(i)
        out.append(i if found is None else places[found])
    return out


def sorted_words(normalized: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(normalized, r"\s+"), lambda w: w != "")), " ")


def _clustered(threshold: float):
    @F.pandas_udf(ArrayType(IntegerType()))
    def places(forms: pd.Series) -> pd.Series:
        return forms.map(lambda f: cluster_forms(list(f), threshold))

    return places


def _in_order(forms: DataFrame) -> DataFrame:
    """A row for each group with its forms in order as the array ``f``; for groups of a bounded size only."""
    return forms.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "form"))).alias("f"))


def _first_of_groups(forms: DataFrame, n: int) -> DataFrame:
    """The first ``n`` forms of each group, found in parts of a group first."""
    order = [F.col("pos"), F.col("name")]
    part = F.pmod(F.xxhash64("form"), F.lit(SALTS))
    some = forms.withColumn("_part", part).withColumn("_k", F.row_number().over(Window.partitionBy("g", "_part").orderBy(*order))).where(F.col("_k") <= n)
    return some.withColumn("_k", F.row_number().over(Window.partitionBy("g").orderBy(*order))).where(F.col("_k") <= n).drop("_part", "_k")


def _meet(open_forms: DataFrame, leaders: DataFrame, threshold: float) -> DataFrame:
    """Undecided forms with the name of the first of their group's leaders that is similar, or null."""

    def first(forms: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
        if not len(forms):
            return forms.assign(cluster=pd.Series(dtype=object))
        known = Leaders(threshold, list(heads["forms"].iloc[0]) if len(heads) else [])
        names = list(heads["names"].iloc[0]) if len(heads) else []
        found = [known.first(f) for f in forms["form"]]
        return forms.assign(cluster=[None if i is None else names[i] for i in found])

    each = leaders.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = lambda df: df.groupBy("g", "part")
    schema = open_forms.drop("cluster").schema.add("cluster", "string")
    return keyed(open_forms.drop("cluster")).cogroup(keyed(each)).applyInPandas(first, schema)


def fuzzy_name_clusters(names: DataFrame, group: str, name: str, order: str | None = None, threshold: float = 0.8, normalizer: Callable[[Column], Column] = T.normalize_ascii) -> DataFrame:
    """Columns ``group``, ``name``, cluster: of each distinct name the one that it is filed under.

    Names of a group come in the order of ``order`` (the least of a repeated name's), by default of the names.
    """
    spark = names.sparkSession
    ship(spark)
    scratch = Scratch(spark, "fuzzy")
    kind, group_type = names.schema[name].dataType.simpleString(), names.schema[group].dataType
    # a key without nulls, as grouping in Python wouldn't match those of both sides
    rows = names.select(F.struct(F.col(group).alias("v")).alias("g0"), F.col(name).alias("name"), F.col(order or name).alias("pos")).where(F.col("name").isNotNull())
    rows = rows.select(F.to_json("g0").alias("g"), "g0", "name", "pos").groupBy("g", "name").agg(F.min("pos").alias("pos"), F.first("g0").alias("g0"))
    rows = scratch.save(rows.withColumn("form", sorted_words(normalizer(F.col("name")))), "names")
    forms = rows.groupBy("g", "form").agg(F.min(F.struct("pos", "name")).alias("m")).select("g", "form", F.col("m.pos").alias("pos"), F.col("m.name").alias("name"))
    forms = scratch.save(forms, "forms")
    large = scratch.save(forms.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > SMALL), "large")

    small = _in_order(forms.join(large, "g", "left_anti"))
    places = _clustered(threshold)(F.transform("f", lambda x: x["form"]))
    pairs = F.transform("f", lambda x, i: F.struct(x["form"].alias("form"), F.get(F.col("f"), F.get(F.col("p"), i))["name"].alias("cluster")))
    decided = [small.withColumn("p", places).select("g", F.inline(pairs))]

    parts = large.select("g", (F.floor((F.col("n") - 1) / PART) + 1).cast("int").alias("parts"))
    open_forms, batch, step = None, SMALL, 0
    if rows_of(large):
        open_forms = forms.join(parts, "g").withColumn("part", F.pmod(F.xxhash64("form"), F.col("parts")).cast("int"))
    while open_forms is not None:
        heads = _in_order(_first_of_groups(open_forms, batch)).withColumn("p", _clustered(threshold)(F.transform("f", lambda x: x["form"])))
        heads = heads.select("g", F.filter("f", lambda x, i: F.get(F.col("p"), i) == i).alias("f"))
        heads = heads.select("g", F.transform("f", lambda x: x["form"]).alias("forms"), F.transform("f", lambda x: x["name"]).alias("names"))
        heads = scratch.save(heads.join(parts, "g"), f"leaders{step}")
        met = scratch.save(_meet(open_forms, heads, threshold), f"met{step}")
        decided.append(met.where(F.col("cluster").isNotNull()).select("g", "form", "cluster"))
        rest = met.where(F.col("cluster").isNull())
        open_forms = None if rest.isEmpty() else rest
        batch, step = min(MOST, 2 * batch), step + 1

    found = decided[0]
    for d in decided[1:]:
        found = found.unionByName(d)
    out = rows.join(found, ["g", "form"]).select(F.col("g0.v").cast(group_type).alias(group), F.col("name").cast(kind).alias(name), F.col("cluster").cast(kind).alias("cluster"))
    return out
