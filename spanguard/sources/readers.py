"""Readers with explicit schemas; nothing is inferred."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.replies import parse_spans
from ..operators.tables import keep_first, keep_last, not_blank, stratified_head  # noqa: F401
from ..plans.pii import RECORD
from .order import number_rows

DOCUMENTS = "uid string, doc_id string, text string, document_type string, document_format string, domain string, locale string, spans string"
PREDICTIONS = "doc_id string, entities array<struct<label:string,start:int,end:int,score:double>>"
SCORES = "text string, p1 double, raw_label int"
STAGE1 = "unique_id long, verdict string, parse_error boolean"
STAGE2 = "unique_id long, verdict string, cwe_id string, mechanism string, fixed_code string, justification string, parse_error boolean, invalid_cwe_id boolean, cwe_invalid_reason string"


def read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage's lines with their ``line``; of the lines of an id the last one counts."""
    return number_rows(read_jsonl(spark, path, schema))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, a bad one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Output records, held to their schema."""
    return read_jsonl(spark, path, RECORD)


def read_documents(spark: SparkSession, path: str, n: int | None = None, stratify_by: str | None = None, row_id: str = "uid") -> DataFrame:
    """Documents as Parquet; a stratified sample if both ``n`` and a field are given, else the first ``n``."""
    df = spark.read.parquet(path)
    if n is None:
        return df
    return stratified_head(df, stratify_by, n, row_id) if stratify_by else df.orderBy(row_id).limit(n)


def read_splits(spark: SparkSession, path: str, train_sample: int | None = None, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(train, test) of prompts with a ``split`` column."""
    return splits_of(spark.read.parquet(path), train_sample, row_id)


def splits_of(df: DataFrame, train_sample: int | None = None, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    train = df.where(F.col("split") == "train")
    return train if train_sample is None else train.orderBy(row_id).limit(train_sample), df.where(F.col("split") == "test")


def gold_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id and the labels of all its spans, one row with the number of texts that can't be parsed) of uid, spans."""
    parsed = rows.select(F.col("uid").alias("doc_id"), parse_spans("spans").alias("s"))
    good = parsed.where("s is not null").groupBy("doc_id").agg(F.transform(F.flatten(F.collect_list("s")), lambda s: s["label"]).alias("labels"))
    return good, parsed.agg(F.count_if(F.col("s").isNull()).alias("parse_errors"))


def predicted_spans(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, labels of a JSONL of records; the last line of a document wins, no entities are none."""
    last = keep_last(number_rows(read_jsonl(spark, path, PREDICTIONS)), "doc_id", "line")
    return last.select("doc_id", F.coalesce(F.transform("entities", lambda e: e["label"]), F.array().cast("array<string>")).alias("labels"))


def read_code(spark: SparkSession, path: str) -> DataFrame:
    """unique_id, code of a CSV with quoted line ends: rows with code, the first of each id."""
    rows = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').schema("unique_id long, code string").csv(path)
    rows = number_rows(rows, "row_id").where(~F.coalesce(F.col("code").isin(*V.MISSING), F.lit(False)))
    return keep_first(not_blank(rows, "code"), "unique_id", "row_id").drop("row_id")


def read_cwe(spark: SparkSession, path: str) -> DataFrame:
    """cwe_id of a JSON array of strings."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("cwe_id")).distinct()


def read_thresholds(spark: SparkSession, path: str | None) -> tuple[float, float]:
    """t_low and t_high of a JSON file, or the defaults where there is none."""
    if path:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            found = json.loads(spark.read.text(path, wholetext=True).first().value)
            return found.get("t_low", V.T_LOW), found.get("t_high", V.T_HIGH)
    return V.T_LOW, V.T_HIGH
