"""The review cascade: cheap triage of all, costly analysis of what is flagged, one merged table."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import replies as R
from ..operators import models
from ..operators.ledger import Ledger, ask_once
from ..operators.tables import keep_first, keep_last, not_blank

DETAILS = ("cwe_id", "mechanism", "fixed_code", "justification")


@dataclass(frozen=True)
class StageSettings:
    """How a stage calls its model; a client's factory that takes an argument gets these."""

    instructions: str
    temperature: float
    max_output_tokens: int
    #: Bounds of the pauses between tries, in seconds.
    wait: tuple[float, float]
    #: Calls at once in the whole cluster, and tries of each.
    concurrency: int = 10
    attempts: int = 3
    model: str = ""


@dataclass(frozen=True)
class ReviewSettings:
    triage: StageSettings = StageSettings(models.TRIAGE_INSTRUCTIONS, 0.0, 200, (1.0, 10.0))
    analysis: StageSettings = StageSettings(models.ANALYSIS_INSTRUCTIONS, 0.3, 2000, (2.0, 15.0))
    #: Share of failed calls above which a stage is an error.
    most_failed: float = 0.5
    sample: int | None = None

    def sampled(self, n: int = 100) -> "ReviewSettings":
        """A trial run: the first rows, one call at a time, none tried again."""
        one = lambda s: replace(s, concurrency=1, attempts=1)
        return replace(self, triage=one(self.triage), analysis=one(self.analysis), sample=n)


def clean(code: DataFrame, key: str = "unique_id", order: str = "row_id") -> DataFrame:
    """Rows with code, the first of each id."""
    return keep_first(not_blank(code, "code"), key, order)


def triage(rows: DataFrame, reply: Column) -> DataFrame:
    """unique_id, verdict, parse_error; ``reply`` is the model's answer."""
    return rows.select("unique_id", R.triage_reply(reply).alias("r")).select("unique_id", "r.*")


def flagged(stage1: DataFrame, code: DataFrame) -> DataFrame:
    """The rows of code that triage didn't call secure."""
    return code.join(stage1.where(F.col("verdict").isin(*V.FLAGGED_VERDICTS)), "unique_id", "left_semi")


def analyse(rows: DataFrame, reply: Column, known: DataFrame) -> DataFrame:
    """unique_id and the checked analysis; ``known`` has the dictionary's cwe_id."""
    parsed = rows.select("unique_id", R.analysis_reply(reply).alias("r")).select("unique_id", "r.*")
    return downgrade(parsed, known)


def check_cwe(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Adds cwe_reason: empty, bad_format, not_in_dict or nothing. A small dictionary is broadcast by its size."""
    ids = known.select(F.col("cwe_id"), F.lit(True).alias("_known")).distinct()
    return rows.join(ids, "cwe_id", "left").withColumn("cwe_reason", R.cwe_reason(F.col("cwe_id"), F.col("_known"))).drop("_known")


def downgrade(analysis: DataFrame, known: DataFrame) -> DataFrame:
    """Vulnerable rows with an id that isn't valid become uncertain, with the reason."""
    checked = check_cwe(analysis, known)
    bad = ~F.col("parse_error") & (F.col("verdict") == "vulnerable") & (F.col("cwe_id") != "") & (F.col("cwe_reason") != "")
    out = checked.withColumn("invalid_cwe_id", F.when(bad, F.lit(True))).withColumn("cwe_invalid_reason", F.when(bad, F.col("cwe_reason"))).withColumn("verdict", F.when(bad, "uncertain").otherwise(F.col("verdict")))
    return out.select(*analysis.columns, "invalid_cwe_id", "cwe_invalid_reason")


def latest(stage: DataFrame, order: str = "line") -> DataFrame:
    """The last row of each id."""
    return keep_last(stage, "unique_id", order).drop(order)


def merge(stage1: DataFrame, stage2: DataFrame, code: DataFrame, order: str = "line") -> DataFrame:
    """One row for each id of stage 1: the analysis where there is one, else the triage's verdict.

    The last row of an id by ``order`` wins on each side; a side without that column has an id once.
    """
    s1, s2, c = (keep_last(df, "unique_id", order) if order in df.columns else df for df in (stage1, stage2, code))
    b = s2.select("unique_id", F.lit(True).alias("_there"), F.col("verdict").alias("_verdict"), *DETAILS)
    joined = s1.select("unique_id", F.col("verdict").alias("_first")).join(b, "unique_id", "left").join(c.select("unique_id", "code"), "unique_id", "left")
    return joined.select("unique_id", F.coalesce("code", F.lit("")).alias("code"), F.when(F.col("_there"), F.coalesce("_verdict", "_first")).otherwise(F.col("_first")).alias("verdict"), *[F.coalesce(d, F.lit("")).alias(d) for d in DETAILS])


def final_distribution(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """Secure of both stages, vulnerable and uncertain of the second."""
    a = stage1.agg(F.count_if(F.col("verdict") == "secure").alias("s1"))
    b = stage2.agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in V.VERDICTS])
    return a.crossJoin(b).select((F.col("s1") + F.col("secure")).alias("secure"), "vulnerable", "uncertain")


def cascade(code: DataFrame, first: Callable[[DataFrame], DataFrame], second: Callable[[DataFrame], DataFrame], known: DataFrame, between: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The whole cascade. ``first`` and ``second`` add a column ``reply`` by calling a model.

    ``between`` writes a stage and reads it back, so a paid call isn't made twice.
    """
    rows = clean(code)
    stage1 = between(triage(first(rows), F.col("reply")), "stage1")
    stage2 = between(analyse(second(flagged(stage1, rows)), F.col("reply"), known), "stage2")
    return merge(stage1, stage2, rows)


def asking(client: Callable, stage: StageSettings, ledger: Ledger, most_failed: float = 0.5) -> Callable[[DataFrame], DataFrame]:
    """Adds ``reply`` to rows by paid calls, each made once as the ledger remembers it."""
    make = (lambda: client(stage)) if inspect.signature(client).parameters else client
    ask = lambda rows: ask_once(rows, make, stage.instructions, ledger, concurrency=stage.concurrency, attempts=stage.attempts, wait=stage.wait, most_failed=most_failed)
    return lambda rows: rows.join(ask(rows), "unique_id", "left")


def run_cascade(code: DataFrame, client: Callable, known: DataFrame, folder: str, between: Callable[[DataFrame, str], DataFrame], settings: ReviewSettings = ReviewSettings()) -> DataFrame:
    """The cascade by a paid model: both stages ask through the ledger in ``folder``, so what stopped goes on where it was.

    ``code`` has an id once and no blank code; ``settings.sample`` takes the first ids.
    """
    rows = code if settings.sample is None else code.orderBy("unique_id").limit(settings.sample)
    ledger = Ledger(code.sparkSession, folder)
    stage1 = between(triage(asking(client, settings.triage, ledger, settings.most_failed)(rows), F.col("reply")), "stage1")
    found = flagged(latest(stage1) if "line" in stage1.columns else stage1, rows)
    stage2 = between(analyse(asking(client, settings.analysis, ledger, settings.most_failed)(found), F.col("reply"), known), "stage2")
    return merge(stage1, stage2, rows)
