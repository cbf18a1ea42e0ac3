"""Sampling, duplicates and last-wins rules that keep an order given by key columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified_head(df: DataFrame, field: str, n: int, row_id: str, missing: str = "unknown") -> DataFrame:
    """The first ``max(1, n // groups)`` rows of each group; groups as first seen, ``n`` rows at most.

    A group never needs more than ``n`` rows, and Spark's rank limit drops the rest before the shuffle.
    """
    df = df.withColumn("_group", F.coalesce(F.col(field).cast("string"), F.lit(missing)))
    groups = df.groupBy("_group").agg(F.min(row_id).alias("_first"))
    per = max(1, n // max(1, groups.count()))
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy("_group").orderBy(row_id))).where(F.col("_nth") <= per)
    return ranked.join(groups, "_group").orderBy("_first", row_id).limit(n).drop("_group", "_first", "_nth")


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key, the first by ``order``: an aggregation, so no task holds a key's rows."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def head(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value isn't null, nor only white space."""
    return df.where(F.col(column).rlike(r"(?U)\S"))


def counts_with_share(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value and their percentage of all."""
    per = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return per.crossJoin(F.broadcast(total)).select(column, "n", F.round(F.col("n") * 100 / F.col("total"), 4).alias("pct"))


def join_by_row(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Rows of equal row id side by side; tables of different sizes are an error."""
    a, b = left.count(), right.count()
    if a != b:
        raise ValueError(f"{a} rows on one side, {b} on the other")
    return left.join(right, row_id)
