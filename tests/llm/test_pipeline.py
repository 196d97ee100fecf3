"""The pipeline: its stages on awkward tables, and run() against stage-by-stage brute force."""

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import AWKWARD, awkward, empty
from tests.llm.test_similar import slow_heads
from tidemark.llm import quality, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "near-duplicates", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = table(spark, SF, "labels")
    rows = [r.asDict() for r in docs.collect()]
    score = toxicity.fit(docs, labels, 5, 0).score([r["text"] for r in rows])
    rows = [r for r, s in zip(rows, score, strict=True) if s < 0.5]
    left = spark.createDataFrame(rows, docs.schema)
    score = quality.fit(left, labels, 4, 2).score([r["text"] for r in rows])
    rows = [r for r, s in zip(rows, score, strict=True) if s >= 0.7]
    keep = slow_heads([(r["doc_id"], r["text"]) for r in rows])
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p["doc_id"] for p in pieces} == keep
    for d in keep:
        mine = [p for p in pieces if p["doc_id"] == d]
        assert sum(p["length"] for p in mine) == mine[0]["doc_tokens"]


@pytest.mark.parametrize(("sf", "most"), [("/root/testdata/sf0.01", 0.16), ("/root/testdata/sf0.1", 0.06)])
def test_clean_documents_stay_and_toxic_ones_go(spark, sf, most):
    """40 labelled toxic documents to learn from at the smaller size, 360 at the larger."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    clean = [d for d, t in labels.items() if not t]
    assert np.mean([d in kept for d in clean]) > 0.99
    assert np.mean([d in kept for d, t in labels.items() if t]) < most


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_awkward_tables(spark, stage):
    docs = awkward(spark)
    for name in ("row", "_score", "_text", "node", "none", "id", "_word", "_bits", "half", "y"):
        docs = docs.withColumn(name, docs["score"])
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns and got.count() <= docs.count()
    assert all(r["_word"] == 0.5 for r in got.collect())
    assert not stage(spark, empty(spark), SF).count()


def test_one_of_each_group_stays(spark):
    got = corpus_pipeline.drop_near_duplicates(spark, awkward(spark), SF).collect()
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(slow_heads([(d, t or "") for d, t, _ in AWKWARD if d is not None]))
    assert sum(r["doc_id"] is None for r in got) == 1
