"""Evaluation: label counts of spans, binary metrics, confusion, zones, calibration."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import guard


class Throughput:
    """Rows and rows a second of an action: ``with Throughput(df) as t: t.df.write...``, then ``t.report()``."""

    def __init__(self, df: DataFrame, name: str = "rows"):
        self.seen = Observation(name)
        self.df = df.observe(self.seen, F.count(F.lit(1)).alias("n"))

    def __enter__(self) -> "Throughput":
        self.began = time.time()
        return self

    def __exit__(self, *failed) -> None:
        self.seconds = time.time() - self.began

    def report(self) -> dict:
        n = self.seen.get["n"]
        return {"rows": n, "elapsed_seconds": round(self.seconds, 2), "rows_per_second": round(n / self.seconds, 1) if self.seconds else 0.0}


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    """a / b, 0 where b is 0."""
    return F.round(F.when(b > 0, a / b).otherwise(0.0), digits)


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    f1 = F.round(F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0), 6)
    return [ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), f1.alias("f1")]


def label_matches(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Rows doc_id, label, tp, fp, fn of documents in both tables (doc_id, labels array).

    Both sides are counts of (doc_id, label) with a sign, summed in one aggregation.
    """
    both = gold.select("doc_id").distinct().join(pred.select("doc_id").distinct(), "doc_id")
    one = lambda df, g, p: df.select("doc_id", F.explode("labels").alias("label"), F.lit(g).alias("g"), F.lit(p).alias("p"))
    counts = one(gold, 1, 0).unionByName(one(pred, 0, 1)).withColumn("label", F.lower("label")).groupBy("doc_id", "label").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    zero = F.lit(0).cast("long")
    return counts.join(both, "doc_id", "left_semi").select("doc_id", "label", F.least("g", "p").alias("tp"), F.greatest(F.col("p") - F.col("g"), zero).alias("fp"), F.greatest(F.col("g") - F.col("p"), zero).alias("fn"))


def per_label(matches: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    sums = matches.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return sums.select("label", "tp", "fp", "fn", *prf(tp, fp, fn), (tp + fn).alias("support"))


def overall(matches: DataFrame) -> DataFrame:
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return matches.agg(s("tp"), s("fp"), s("fn")).select("tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def document_overlap(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: documents in both, in gold only, in pred only."""
    sides = gold.select("doc_id", F.lit(1).alias("s")).unionByName(pred.select("doc_id", F.lit(2).alias("s"))).groupBy("doc_id").agg(F.bit_or("s").alias("s"))
    return sides.agg(F.count_if(F.col("s") == 3).alias("docs_matched"), F.count_if(F.col("s") == 1).alias("docs_gt_only"), F.count_if(F.col("s") == 2).alias("docs_pred_only"))


def evaluate_spans(gold: DataFrame, pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(overall with document counts, per label)."""
    m = label_matches(gold, pred)
    return overall(m).crossJoin(F.broadcast(document_overlap(gold, pred))), per_label(m)


def top_labels(labels: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` labels of most support and the rest as one; labels are few, so the rank needs one task."""
    nth = F.row_number().over(Window.orderBy(F.desc("support"), "label"))
    ranked = labels.withColumn("nth", F.least(nth, F.lit(n + 1)))
    name = F.when(F.col("nth") > n, F.lit("(other)")).otherwise(F.col("label"))
    return ranked.groupBy("nth", name.alias("label")).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")]).select("nth", "label", "tp", "fp", "fn", "support")


def binary_metrics(rows: DataFrame, gold: str = "gold", pred: str = "pred", label: str = "label") -> DataFrame:
    """Rows with classes ``gold`` and ``pred`` and the data set's ``label``: one row of metrics."""
    g, p = F.col(gold) == V.INJECTION, F.col(pred) == V.INJECTION
    c = rows.agg(
        F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn"),
        F.count_if(F.col(label) == 2).alias("harmful"), F.count_if((F.col(label) == 2) & ~p).alias("leaked"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("tp", "fp", "fn", "tn", *prf(tp, fp, fn), ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), F.round(F.when(F.col("harmful") > 0, 1 - F.col("leaked") / F.col("harmful")).otherwise(0.0), 6).alias("harmful_recall_safe"))


def confusion(rows: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """All four cells, zeros included."""
    cells = rows.agg(*[F.count_if((F.col(gold) == g) & (F.col(pred) == p)).alias(f"c{i}{j}") for i, g in enumerate((V.SAFE, V.INJECTION)) for j, p in enumerate((V.SAFE, V.INJECTION))])
    cell = lambda i, j, g, p: F.struct(F.lit(g).alias("gold"), F.lit(p).alias("pred"), F.col(f"c{i}{j}").alias("n"))
    return cells.select(F.inline(F.array(*[cell(i, j, g, p) for i, g in enumerate((V.SAFE, V.INJECTION)) for j, p in enumerate((V.SAFE, V.INJECTION))])))


def zones(rows: DataFrame, low=V.T_LOW, high=V.T_HIGH, p1: str = "p1") -> DataFrame:
    p = F.col(p1)
    c = rows.agg(F.count("*").alias("total"), F.count_if(p < low).alias("safe"), F.count_if(p >= high).alias("block"), F.count_if((p >= low) & (p < high)).alias("review"))
    pct = lambda x: F.round(F.when(F.col("total") > 0, F.col(x) * 100 / F.col("total")).otherwise(0.0), 4).alias(f"{x}_pct")
    return c.select("total", "safe", "review", "block", pct("safe"), pct("review"), pct("block"))


def harmful(rows: DataFrame, low=V.T_LOW, p1: str = "p1", label: str = "label") -> DataFrame:
    """What becomes of harmful prompts; without any, only their number is given."""
    p = F.col(p1)
    c = rows.where(F.col(label) == 2).agg(F.count("*").alias("total_harmful"), F.count_if(p < low).alias("leaked"), F.count_if((p >= low) & (p < 0.5)).alias("review"), F.count_if(p >= 0.5).alias("block"))
    some = F.col("total_harmful") > 0
    part = lambda x: F.when(some, F.col(x)).alias(x)
    pct = lambda x: F.when(some, F.round(F.col(x) * 100 / F.col("total_harmful"), 4)).alias(f"{x}_pct")
    return c.select("total_harmful", part("leaked"), part("review"), part("block"), pct("leaked"), pct("review"), pct("block"))


def steps(start: float, stop: float, step: float) -> list[float]:
    """start + i * step below stop, with the sums' own rounding."""
    out, i = [], 0
    while start + i * step < stop - step * 1e-9:
        out.append(start + i * step)
        i += 1
    return out


def calibration_grid(rows: DataFrame, p1: str = "p1", label: str = "label") -> DataFrame:
    """Scores of all pairs of thresholds: t_low, t_high, recall_harmful, f1, score.

    One pass counts the rows of each cell between neighbouring thresholds; there are some hundred
    cells at most, whatever the input, and only they meet the pairs. Thresholds are compared
    before they are rounded.
    """
    p, lab = F.col(p1), F.col(label)
    lows, highs = steps(*V.GRID_LOW), steps(*V.GRID_HIGH)
    reached = lambda ts: sum(((p >= t).cast("int") for t in ts), F.lit(0))
    gold = F.coalesce(guard.gold_class(lab) == V.INJECTION, F.lit(False))
    cells = rows.where(p.isNotNull()).select(F.coalesce(lab == 2, F.lit(False)).alias("harm"), gold.alias("gold"), reached(lows).alias("a"), reached(highs).alias("b"), (p >= 0.5).alias("half"))
    cells = cells.groupBy("harm", "gold", "a", "b", "half").agg(F.count("*").alias("c"))
    pairs = [F.struct(F.lit(i).alias("i"), F.lit(lo).alias("t_low"), F.lit(j).alias("j"), F.lit(hi).alias("t_high")) for i, lo in enumerate(lows) for j, hi in enumerate(highs)]
    grid = rows.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    # what is called an injection: at or above t_high, or from t_low on and at least one half
    low, called = F.col("a") > F.col("i"), (F.col("a") > F.col("i")) & ((F.col("b") > F.col("j")) | F.col("half"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("c"))), F.lit(0))
    met = grid.join(F.broadcast(cells), F.lit(True), "left").groupBy("t_low", "t_high")
    sums = met.agg(total(F.col("harm")).alias("h"), total(F.col("harm") & ~low).alias("k"), total(F.col("gold")).alias("g"), total(called).alias("p"), total(called & F.col("gold")).alias("tp"))
    recall = F.when(F.col("h") > 0, 1 - F.col("k") / F.col("h")).otherwise(1.0)
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("p") + F.col("g"))).otherwise(0.0)
    return sums.select("t_low", "t_high", F.round(recall, 6).alias("recall_harmful"), F.round(f1, 6).alias("f1"), (V.RECALL_WEIGHT * recall + V.F1_WEIGHT * f1).alias("score"))


def calibrate(rows: DataFrame, p1: str = "p1", label: str = "label") -> DataFrame:
    """The best pair of thresholds, the smallest of ties."""
    best = calibration_grid(rows, p1, label).orderBy(F.desc(F.round("score", 12)), "t_low", "t_high").limit(1)
    return best.select(F.round("t_low", 2).alias("t_low"), F.round("t_high", 2).alias("t_high"), F.round("score", 4).alias("calibration_score"))
