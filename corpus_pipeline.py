"""A pipeline over ``documents`` whose stages each apply one operator of ``spanguard.llm``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of documents; the last one returns the documents' ids. Between stages the rows are
written to the shared folder, so a lost executor costs one stage at most.

All stages give an empty table for an empty one, keep repeated rows and repeated ids that they have
no reason to drop, and pass columns of any further name on as they are; nulls in columns other than
a stage's own inputs don't matter. Long texts are treated whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanguard.llm import catalog, decontaminate, language, neardup, pieces, substrings
from spanguard.llm.common import Scratch, table

#: A repeated passage goes if it has more words than these.
WORDS = 50


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language isn't found: null, empty or letterless text, or a score under 0.5.

    Equal texts have one score, so ties and repeated rows share their fate. Rows of which none is labelled are an
    error, as no language could be found; an empty table stays empty.
    """
    sample = [(r.lang, r.text) for r in language.training_rows(docs).collect()]
    if not sample and not docs.isEmpty():
        raise ValueError("no document has text and lang: there is nothing to learn languages from")
    return language.keep_identified(docs, language.train(sample))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 on five words stays, the one of the least id.

    Rows without an id or a word all stay; of repeated rows and of equal ids with linked texts one stays.
    """
    return neardup.drop_near_duplicates(docs, k=5, percent=80)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur more than once are cut out, whatever white space stands between the words; all documents stay.

    Null texts stay null; a text that is one repeated passage becomes empty, wherever it stands.
    """
    return substrings.strip_repeats(docs, length=WORDS + 1, unit="words")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none and stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows doc_id, n_tokens, ids, decoded of every document that is left; a null text has no ids."""
    out = pieces.encode_documents(docs, catalog.tokenizer_bytes("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language_stage),
    ("near-duplicates", near_duplicate_stage),
    ("repeated-passages", repeated_passage_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

#: A trained network and piece encoding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
