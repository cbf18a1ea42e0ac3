"""Text reports of evaluations, from small frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import guard as G
from ..operators import metrics as M
from ..sources.writers import write_markdown


def span_report(gold: DataFrame, pred: DataFrame, top: int = 15) -> str:
    """Overall scores and document counts, and the labels of most support with the rest as one row."""
    overall, labels = M.evaluate_spans(gold, pred)
    return write_markdown(overall, "Spans") + "\n" + write_markdown(M.top_labels(labels, top).orderBy("nth"), "Labels")


def guard_report(rows: DataFrame, low: float = V.T_LOW, high: float = V.T_HIGH) -> str:
    """Metrics, confusion, zones and harmful prompts of rows label, p1."""
    rows = rows.withColumn("gold", G.gold_class(F.col("label"))).withColumn("pred", G.model_class(G.raw_label(F.col("p1"))))
    parts = {"Metrics": M.binary_metrics(rows), "Confusion": M.confusion(rows), "Zones": M.zones(rows, low, high), "Harmful prompts": M.harmful(rows, low)}
    return "\n".join(write_markdown(df, title) for title, df in parts.items())


def review_report(stage1: DataFrame, stage2: DataFrame) -> str:
    """Verdicts of both stages and the final distribution with shares."""
    from ..operators.tables import counts_with_share
    from .review import final_distribution

    final = final_distribution(stage1, stage2).select(F.inline(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n")) for v in ("secure", "vulnerable", "uncertain")])))
    total = F.sum("n").over(M.Window.partitionBy())
    shares = final.withColumn("pct", F.round(F.when(total > 0, F.col("n") * 100 / total).otherwise(0.0), 1))
    return "\n".join([write_markdown(counts_with_share(stage1, "verdict"), "Stage 1"), write_markdown(counts_with_share(stage2, "verdict"), "Stage 2"), write_markdown(shares, "Final")])
