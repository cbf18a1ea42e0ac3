"""The guard: scored prompts to classes, decisions and rationales, and their statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import guard as G


@dataclass(frozen=True)
class GuardSettings:
    t_low: float = V.T_LOW
    t_high: float = V.T_HIGH


def decisions(prompts: DataFrame, settings: GuardSettings = GuardSettings(), scorer: Callable[[Column], Column] | None = G.stub_score) -> DataFrame:
    """Adds p1 (unless there), raw_label, flags, assigned_class, decision, needs_review, rationale."""
    df = prompts if "p1" in prompts.columns else prompts.withColumn("p1", scorer(F.col("text")))
    df = df.withColumn("raw_label", G.raw_label(F.col("p1"))).withColumn("flags", G.flags(F.col("text")))
    df = df.withColumn("_d", G.decision(F.col("p1"), F.col("flags"), settings.t_low, settings.t_high))
    return df.withColumn("rationale", G.rationale(F.col("p1"), F.col("flags"), F.col("_d"))).select(*df.columns[:-1], "_d.*", "rationale")


def results_table(decided: DataFrame) -> DataFrame:
    """The four columns of the results table under their published names."""
    return decided.select(*V.RESULT_COLUMNS).withColumnsRenamed(V.RESULT_COLUMNS)


def statistics(decided: DataFrame) -> DataFrame:
    """One row: decisions, and how many rows have flags."""
    d = F.col("decision")
    c = decided.agg(F.count("*").alias("total"), F.count_if(d == V.PASS).alias("passed"), F.count_if(d == V.BLOCK).alias("blocked"), F.count_if(d == V.REVIEW).alias("reviewed"), F.count_if(F.size("flags") > 0).alias("flagged"))
    return c.withColumn("flagged_pct", F.round(F.when(F.col("total") > 0, F.col("flagged") * 100 / F.col("total")).otherwise(0.0), 4))
