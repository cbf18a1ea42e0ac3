"""The pipeline's stages against brute force on a small table."""

import random

import corpus_pipeline as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.test_operators import HARD, near_by_force, overlap_by_force, passages_by_force, prose

from spanguard.llm import catalog


def test_empty_tables(spark, docs_of, tmp_path):
    """Every stage, of an empty table and of one with columns of the names that operators use inside."""
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clash = {c: f"own {c}" for c in ("i", "h", "th", "row", "id", "words", "runs", "sk", "label", "u", "cut", "near", "hits")}
    for docs in (docs_of([]), docs_of([None, "", "one more text of some words", "one more text of some words"])):
        for name, value in clash.items():
            docs = docs.withColumn(name, F.lit(value))
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            assert all(x[c] == v for x in out.collect() for c, v in clash.items())
        assert P.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_stages(spark, docs_of, tmp_path):
    r = random.Random(21)
    passage, item = prose(r, 70), prose(r, 30)
    texts = [prose(r, 80) for _ in range(40)] + ["one copied document " + prose(r, 60)] * 3 + HARD
    texts += [prose(r, 30) + " " + passage + " " + prose(r, 30) for _ in range(4)] + [prose(r, 20) + " " + item + " " + prose(r, 20) for _ in range(2)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = lambda df: {x.doc_id: x.text for x in df.collect()}
    at = rows(docs)
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        before, at = at, rows(docs)
        assert len(at) == docs.count()
        ids = sorted(before)
        if name == "language":
            assert set(before) - set(at) >= {43, 44, 45, 46} and all(i in at for i in range(40))
        elif name == "near-duplicates":
            want = near_by_force([before[i] for i in ids], 5, 80)[1]
            assert set(at) == {ids[c] for c in want} and all(at[i] == before[i] for i in at)
        elif name == "repeated-passages":
            assert at == dict(zip(ids, passages_by_force([before[i] for i in ids], P.WORDS + 1))) and not any(passage[:300] in t for t in at.values())
        else:
            assert set(at) == {i for i in ids if not overlap_by_force(before[i], item)} and len(ids) - len(at) == 2
    out = {x.doc_id: x for x in P.STAGES[-1][1](spark, docs, str(tmp_path)).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_proto=catalog.tokenizer_bytes("piece_bpe_32k.model"))
    assert {i: (x.ids, x.decoded) for i, x in out.items()} == {i: (sp.encode(t), sp.decode(sp.encode(t))) for i, t in at.items()}
    assert sorted(out) == sorted(x.doc_id for x in P.run(spark, str(tmp_path)).collect())


def test_passages_of_short_words(spark, docs_of):
    """51 words of one letter are a passage, 50 aren't."""
    r = random.Random(22)
    letters = [r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(51)]
    texts = [prose(r, 9) + " " + " ".join(letters) + " " + prose(r, 9), prose(r, 9) + "\n" + "  ".join(letters), prose(r, 9) + " " + " ".join(letters[:50]) + " end"]
    out = {x.doc_id: x.text for x in P.repeated_passage_stage(spark, docs_of(texts), "").collect()}
    assert [len(out[i].split()) for i in range(3)] == [18, 9, 60] and out[2] == texts[2]


def test_no_labels(spark, docs_of):
    """Without a labelled document nothing can be learnt, and no document is dropped for it."""
    with pytest.raises(ValueError):
        P.language_stage(spark, docs_of(["some text of words"]).withColumn("lang", F.lit(None).cast("string")), "")


def test_run_on_the_small_tables(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"] and 150 < out.count() < 200
