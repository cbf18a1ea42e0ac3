"""Command lines: anonymize, guard, evaluate and review."""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import replace

from pyspark.sql import functions as F

from .functions import fixed_values as V
from .functions import guard as G
from .operators import metrics, models, validation
from .operators.ledger import Ledger
from .plans import guard, pii, review
from .session import build_session
from .sources import readers, writers
from .sources.order import number_rows


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spanguard")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("anonymize", help="documents to an audit and a final artifact")
    a.add_argument("--input", default="data/documents", help="JSON lines or Parquet; {split} in it stands for --split")
    a.add_argument("--output-dir", default="output/anonymize")
    a.add_argument("--format", choices=("jsonl", "parquet"), default="jsonl")
    a.add_argument("--split", default="test", help="of Parquet with a column split, its rows; and the name in --input")
    a.add_argument("--batch-size", type=int, help="windows that a model gets at once, given to the tagger as batch_size")
    a.add_argument("--device", default="auto", help="given to the tagger's loader")
    a.add_argument("--tagger", help="package.module:function, called with the device (and batch_size=, if given), that returns a tagger")
    a.add_argument("--verbose", "-v", action="store_true")
    a.add_argument("--max-samples", type=int)
    a.add_argument("--stratify-by")
    a.add_argument("--min-score", type=float, default=V.MIN_SCORE)
    a.add_argument("--high-confidence", type=float, default=V.HIGH_CONFIDENCE)
    a.add_argument("--no-audit", action="store_true", help="write the final artifact only")
    g = sub.add_parser("guard", help="prompts to decisions")
    g.add_argument("--input", required=True)
    g.add_argument("--output-dir", required=True)
    g.add_argument("--thresholds")
    g.add_argument("--test-sample", type=int, help="the first rows only, by row_id where there is one")
    g.add_argument("--train-sample", type=int, help="the first rows of the train split only, by row_id")
    g.add_argument("--calibrate", action="store_true", help="find the thresholds on the labels of the train split first")
    g.add_argument("--evaluate", action="store_true", help="metrics of the rows' labels too")
    e = sub.add_parser("guard-evaluate", help="metrics of scored prompts (label, p1)")
    e.add_argument("--predictions", required=True)
    e.add_argument("--thresholds")
    e.add_argument("--calibrate", action="store_true")
    s = sub.add_parser("evaluate", help="span metrics of an audit artifact")
    s.add_argument("--audit", required=True)
    s.add_argument("--dataset", required=True)
    r = sub.add_parser("review", help="the cascade: by a model, or on replies that were collected before")
    r.add_argument("--code", required=True)
    r.add_argument("--stage1", help="lines of the first stage; with --client they are written if not given")
    r.add_argument("--stage2", help="lines of the second stage; with --client they are written")
    r.add_argument("--output-dir", required=True)
    r.add_argument("--client", help="package.module:function that returns an async call of (instructions, input)")
    r.add_argument("--cwe", help="JSON array of the known ids")
    r.add_argument("--sample", type=int, help="a trial of the first ids: one call at a time, none tried again")
    r.add_argument("--concurrency", type=int, help="calls at once in the whole cluster")
    r.add_argument("--ledger", help="folder of answered calls, which are not asked again; by default in the output")
    return p


def run_anonymize(spark, o) -> dict:
    began = time.time()
    source = o.input.replace("{split}", o.split)
    docs = readers.read_jsonl(spark, source, readers.DOCUMENTS) if o.format == "jsonl" else readers.read_documents(spark, source)
    if "split" in docs.columns:
        docs = docs.where(F.col("split") == o.split)
    if o.verbose:
        spark.sparkContext.setLogLevel("INFO")
    if o.max_samples:
        docs = readers.stratified_head(docs, o.stratify_by, o.max_samples, "uid") if o.stratify_by else docs.orderBy("uid").limit(o.max_samples)
    settings = pii.PiiSettings(min_score=o.min_score, high_confidence=o.high_confidence)
    # the plan runs once: both artifacts are projections of what is written first
    work = f"{o.output_dir}/records"
    more = {"batch_size": o.batch_size} if o.batch_size else {}
    run = pii.Anonymizer(models.client_of(o.tagger, o.device, **more), settings).load() if o.tagger else lambda d: pii.anonymize(d, settings)
    run(docs).write.mode("overwrite").parquet(work)
    records = spark.read.parquet(work)
    if not o.no_audit:
        writers.write_jsonl(records, f"{o.output_dir}/audit")
    final = pii.sanitized(records)
    writers.write_jsonl(final, f"{o.output_dir}/final")
    out = pii.summary(records, settings, time.time() - began).first().asDict()
    if out["total_documents"] <= writers.FILE_ROWS:  # what one file may hold; the lines have all
        writers.write_json_array(final, f"{o.output_dir}/final.json")
        writers.write_spreadsheet(final, f"{o.output_dir}/final.xlsx")
    writers.write_json(spark, out, f"{o.output_dir}/summary.json")
    return out


def _calibrated(spark, train, path: str | None, wanted: bool) -> tuple[float, float]:
    """Thresholds found on the train split's labels if wanted, else those of the file or the defaults."""
    if not wanted:
        return readers.read_thresholds(spark, path)
    if "label" not in train.columns or train.isEmpty():
        raise SystemExit("--calibrate needs labelled rows with split = train: thresholds aren't tuned on the rows that they decide")
    best = metrics.calibrate(_classed(train)).first()
    return best.t_low, best.t_high


def _classed(rows):
    return rows.withColumn("gold", G.gold_class(F.col("label"))).withColumn("pred", G.model_class(G.raw_label(F.col("p1"))))


def run_guard(spark, o) -> dict:
    began = time.time()
    rows = number_rows(spark.read.parquet(o.input), "_line")
    by = "row_id" if "row_id" in rows.columns else "_line"
    train, test = readers.splits_of(rows, o.train_sample, by) if "split" in rows.columns else (rows.limit(0), rows)
    if o.test_sample:
        test = test.orderBy(by).limit(o.test_sample)
    # both splits are scored in one pass; without calibration the train split isn't needed
    prompts = test.withColumn("_part", F.lit("test"))
    if o.calibrate:
        prompts = prompts.unionByName(train.withColumn("_part", F.lit("train")))
    scored = prompts if "p1" in prompts.columns else prompts.withColumn("p1", G.stub_score(F.col("text")))
    with metrics.Throughput(scored.withColumn("raw_label", G.raw_label(F.col("p1")))) as t:
        # the model's scores are written once, and everything else reads them
        t.df.write.mode("overwrite").parquet(f"{o.output_dir}/scored")
    every = spark.read.parquet(f"{o.output_dir}/scored")
    scored = every.where("_part = 'test'").drop("_part")
    # in the order of the input's files and rows: what is sorted by ranges is written in parts of that order
    writers.write_jsonl(scored.orderBy("_line").select("text", "p1", "raw_label"), f"{o.output_dir}/raw_predictions")
    low, high = _calibrated(spark, every.where("_part = 'train'"), o.thresholds, o.calibrate)
    decided = guard.decisions(scored, guard.GuardSettings(low, high))
    decided.write.mode("overwrite").parquet(f"{o.output_dir}/decisions")
    decided = spark.read.parquet(f"{o.output_dir}/decisions")
    table = guard.results_table(decided)
    writers.write_csv(table, f"{o.output_dir}/results")
    out = guard.statistics(decided).first().asDict() | {"broken_rules": {r.rule: r.n for r in validation.broken(decided, validation.decision_rules()).collect()}}
    out |= {"t_low": low, "t_high": high, "elapsed_seconds": round(time.time() - began, 2), "inference": t.report()}
    if out["total"] <= writers.FILE_ROWS:
        out["workbook"] = writers.write_spreadsheet(table, f"{o.output_dir}/results.xlsx")
    if o.evaluate:
        out["metrics"] = metrics.binary_metrics(_classed(scored)).first().asDict()
    writers.write_json(spark, {"t_low": low, "t_high": high}, f"{o.output_dir}/thresholds.json")
    writers.write_json(spark, out, f"{o.output_dir}/summary.json")
    return out


def run_guard_evaluate(spark, o) -> dict:
    rows = spark.read.parquet(o.predictions)
    low, high = readers.read_thresholds(spark, o.thresholds)
    rows = _classed(rows)
    out = {"metrics": metrics.binary_metrics(rows).first().asDict(), "zones": metrics.zones(rows, low, high).first().asDict(), "harmful": metrics.harmful(rows, low).first().asDict()}
    out["confusion"] = [r.asDict() for r in metrics.confusion(rows).collect()]
    return out | ({"thresholds": metrics.calibrate(rows).first().asDict()} if o.calibrate else {})


def run_evaluate(spark, o) -> dict:
    gold, errors = readers.gold_spans(spark.read.parquet(o.dataset))
    overall, labels = metrics.evaluate_spans(gold, readers.predicted_spans(spark, o.audit))
    return overall.first().asDict() | errors.first().asDict() | {"per_label": [r.asDict() for r in labels.orderBy(F.desc("support"), "label").collect()]}


def _review_settings(o) -> review.ReviewSettings:
    found = review.ReviewSettings()
    if o.sample:
        found = found.sampled(o.sample)
    if o.concurrency:
        found = replace(found, triage=replace(found.triage, concurrency=o.concurrency), analysis=replace(found.analysis, concurrency=o.concurrency))
    return found


def run_review(spark, o) -> dict:
    code, settings = readers.read_code(spark, o.code), _review_settings(o)
    if settings.sample:
        code = code.orderBy("unique_id").limit(settings.sample)

    def between(df, name):
        writers.write_jsonl(df, f"{o.output_dir}/{name}")
        return readers.read_stage(spark, f"{o.output_dir}/{name}", readers.STAGE1 if name == "stage1" else readers.STAGE2)

    if o.client:
        if not o.cwe:
            raise SystemExit("--client needs --cwe")
        client, known = models.named(o.client), readers.read_cwe(spark, o.cwe)
        if o.stage1:
            stage1 = readers.read_stage(spark, o.stage1, readers.STAGE1)
            ask = review.asking(client, settings.analysis, Ledger(spark, o.ledger or f"{o.output_dir}/ledger"), settings.most_failed)
            stage2 = between(review.analyse(ask(review.flagged(review.latest(stage1), code)), F.col("reply"), known), "stage2")
            merged = review.merge(stage1, stage2, code)
        else:
            merged = review.run_cascade(code, client, known, o.ledger or f"{o.output_dir}/ledger", between, settings)
    elif not o.stage1 or not o.stage2:
        raise SystemExit("--stage1 and --stage2 are needed where there is no --client")
    else:
        merged = review.merge(readers.read_stage(spark, o.stage1, readers.STAGE1), readers.read_stage(spark, o.stage2, readers.STAGE2), code)
    merged.write.mode("overwrite").parquet(f"{o.output_dir}/merged")
    merged = spark.read.parquet(f"{o.output_dir}/merged").orderBy("unique_id")
    writers.write_csv(merged, f"{o.output_dir}/results")
    if merged.count() <= writers.FILE_ROWS:
        writers.write_spreadsheet(merged, f"{o.output_dir}/results.xlsx")
    return {r.rule: r.n for r in validation.broken(merged, validation.review_rules()).collect()}


RUN = {"anonymize": run_anonymize, "guard": run_guard, "guard-evaluate": run_guard_evaluate, "evaluate": run_evaluate, "review": run_review}


def main(args: list[str] | None = None) -> dict:
    o = parser().parse_args(args)
    out = RUN[o.command](build_session(o.master), o)
    print(json.dumps(out, ensure_ascii=False, default=str))
    return out


if __name__ == "__main__":
    main()
