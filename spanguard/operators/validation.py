"""Validation: rows of (rule, n) for every rule that is broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import is_card


def broken(df: DataFrame, rules: dict[str, Column], all_rules: bool = False) -> DataFrame:
    """One pass over the rows for all rules; ``all_rules`` also gives those that hold."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, c in rules.items()])
    out = counts.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])))
    return out if all_rules else out.where("n > 0")


def missing_columns(df: DataFrame, needed) -> list[str]:
    return [c for c in needed if c not in df.columns]


def blank(c: str) -> Column:
    return F.coalesce(F.col(c) == "", F.lit(True))


def record_rules(df: DataFrame) -> dict[str, Column]:
    """Rules of an output document record."""
    fields = ("entity_id", "label", "start", "end", "score", "needs_review")
    hole = lambda e: F.greatest(*[e[f].isNull().cast("int") for f in fields]) > 0
    return {
        "doc_id_empty": blank("doc_id"),
        "entities_missing": F.col("entities").isNull(),
        "entity_field_missing": F.exists(F.coalesce(F.col("entities"), F.array().cast(df.schema["entities"].dataType)), hole),
        "text_missing": F.col("anonymized_text").isNull(),
    }


def decision_rules() -> dict[str, Column]:
    """Rules of the guard's table (text, assigned_class, decision, rationale)."""
    return {
        "class_invalid": ~F.coalesce(F.col("assigned_class").isin(V.SAFE, V.INJECTION), F.lit(False)),
        "decision_invalid": ~F.coalesce(F.col("decision").isin(V.PASS, V.BLOCK, V.REVIEW), F.lit(False)),
        "review_without_rationale": F.coalesce(F.col("decision") == V.REVIEW, F.lit(False)) & blank("rationale"),
        "class_empty": blank("assigned_class"),
    }


def review_rules() -> dict[str, Column]:
    """Rules of the merged review table."""
    vulnerable = F.coalesce(F.col("verdict") == "vulnerable", F.lit(False))
    return {
        "verdict_null": F.col("verdict").isNull(),
        "verdict_invalid": F.col("verdict").isNotNull() & ~F.col("verdict").isin(*V.VERDICTS),
        "vulnerable_without_cwe": vulnerable & blank("cwe_id"),
        "vulnerable_without_fix": vulnerable & blank("fixed_code"),
    }


def sought(label: Column, original: Column, least: int = 5) -> Column:
    """Whether a leak check looks for a value: e-mails and cards of some length."""
    return (F.length(original) >= least) & ((label == "EMAIL") | ((label == "CARD_NUMBER") & is_card(original)))


def beside_originals(records: DataFrame, originals: DataFrame, least: int = 5) -> DataFrame:
    """Original e-mails and cards (doc_id, label, original) beside the text of their document, and whether it is ``leaked``."""
    worth = originals.where(sought(F.col("label"), F.col("original"), least))
    return worth.join(records.select("doc_id", "anonymized_text"), "doc_id").withColumn("leaked", F.contains("anonymized_text", "original"))


def leaks(records: DataFrame, originals: DataFrame, least: int = 5) -> DataFrame:
    """Original e-mails and cards (doc_id, label, original) that still stand in the final text of their document."""
    return beside_originals(records, originals, least).where("leaked").drop("leaked")
