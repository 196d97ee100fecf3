"""Near-duplicates of the pipeline against all pairs' exact similarity."""

import numpy as np

import corpus_pipeline
from tidemark.llm import similar


def slow_heads(rows):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets, parent = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    return {min(d for k, (d, _) in enumerate(rows) if find(k) == c) for c in {find(k) for k in range(len(rows))}}


def test_near_copies_fall_and_chains_of_unlike_texts_stay(spark, monkeypatch):
    monkeypatch.setattr(similar, "SAMPLE", 20)
    r = np.random.default_rng(5)
    word = lambda n: [f"w{k}" for k in r.integers(0, 5000, n)]
    line, rows = word(12), []
    for _ in range(6):
        base = word(int(r.integers(30, 300)))
        for edits in (0, 0, 1, 2, 3, 4, 5, 6, 8):
            text = list(base)
            for at in r.choice(len(text), min(edits, len(text) // 8), replace=False):
                text[at] = f"x{r.integers(10**6)}"
            rows.append((len(rows), " ".join(line + text)))
    rows += [(len(rows) + k, " ".join(line + word(20))) for k in range(30)]
    rows = [(d, t) for d, t in np.array(rows, object)[r.permutation(len(rows))]]
    docs = spark.createDataFrame([(int(d), t) for d, t in rows], "doc_id long, text string")
    got = [x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got) == sorted(slow_heads(rows))


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got) == sorted(slow_heads(rows))
