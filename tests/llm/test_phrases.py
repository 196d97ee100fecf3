"""Phrase mining against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward, empty
from tidemark.llm import phrases


def slow(rows, min_count, top):
    out = {}
    for lang in {g or "und" for _, g in rows}:
        f = Counter()
        for text, g in rows:
            if (g or "und") != lang:
                continue
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\n-\r]", low):
                w = [x for x in re.split(r"[ \t]+", piece) if x]
                f.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        n = sum(v for g, v in f.items() if len(g) == 1)
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        inside = lambda g, h: len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        found = []
        for g, a in cand.items():
            if any(inside(g, h) and 100 * b >= 100 * a for h, b in cand.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, n, -s)
    return out


def got(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def table(spark, rows):
    return spark.createDataFrame([(t, g, 1, "x") for t, g in rows], "text string, lang string, rank int, phrase string")


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    r = np.random.default_rng(seed)
    words = ["a", "B", "é", "日本", "of", "the", "\x1c", "x\xa0y", "New", "york"]
    ends = [" ", "  ", "\t", ". ", "\n", "\x0b", "!?", " "]
    rows = [("".join(words[i] + ends[min(7, j)] for i, j in zip(r.integers(0, 10, n), r.geometric(0.5, n) - 1, strict=True)), g) for n, g in zip(r.integers(0, 60, 80), r.choice(["en", "de", None, "und"], 80), strict=True)]
    rows += [("In New York City hall of the", "en")] * 9 + [(None, "en"), ("", None), (" . ", "fr")]
    assert got(phrases.collocations(table(spark, rows), min_count=6, top=40)) == slow(rows, 6, 40)


def test_unary_paths_and_ties(spark):
    rows = [("one two three four five six", "en")] * 5 + [("one two three", "en"), ("p q. p q; q p", "de"), ("p q", "de"), ("aa bb", "x"), ("cc dd", "x"), ("aa bb", "x"), ("cc dd", "x")]
    found = got(phrases.collocations(table(spark, rows), min_count=2, top=50))
    assert found == slow(rows, 2, 50)
    assert {v[0] for (g, _), v in found.items() if g == "en"} == {"one two three four five", "two three four five six", "one two three"}


def test_awkward_and_empty(spark):
    rows = [(r["text"], r["lang"]) for r in awkward(spark).collect()]
    assert got(phrases.collocations(awkward(spark), min_count=2)) == slow(rows, 2, 2000)
    assert not phrases.collocations(empty(spark)).count()


def test_numbers_beyond_64_bits(spark):
    """1000 * a * n / (l * r) of counts whose products need more."""
    row = spark.createDataFrame([(3_000_000_000, 4_000_000_000_000_000, 7_000_000_001, 9_000_000_007)], "a long, n long, l long, r long")
    d = {c: row[c].cast("decimal(19,0)") for c in "anlr"}
    v = row.select((d["a"] * d["n"] * 1000).alias("o"), (d["l"] * d["r"]).alias("u")).selectExpr("o div u AS s").first()["s"]
    assert v == 1000 * 3_000_000_000 * 4_000_000_000_000_000 // (7_000_000_001 * 9_000_000_007)


def test_saturated_bitmaps_change_nothing(spark, monkeypatch):
    rows = [("the cat sat on the mat. the cat ran", "en"), ("a dog", None)] * 7
    want = slow(rows, 7, 100)
    monkeypatch.setattr(phrases, "bitmap", lambda df, bits=0: np.full(1 << 10, -1, np.int64).view(np.uint64))
    assert got(phrases.collocations(table(spark, rows), min_count=7, top=100)) == want


def test_chunks_end_between_words(spark, monkeypatch):
    blob = b"aa bb  cc\ndd eeeeeeeee f " * 30
    for size in (1, 5, 64):
        monkeypatch.setattr(phrases, "CHUNK", size)
        assert b"".join(phrases._chunks(blob)) == blob and [w for c in phrases._chunks(blob) for w in c.split()] == blob.split()
    v = phrases._Vocabulary(np.full(1 << 10, -1, np.int64).view(np.uint64))
    monkeypatch.setattr(phrases, "CHUNK", 3)
    monkeypatch.setattr(phrases, "WORDS", 2)
    codes = v.read("en", blob)
    assert [v.words[c] for c in codes if c] == blob.split()


def test_hashes_are_those_of_the_columns(spark):
    v = phrases._Vocabulary(np.full(1 << 10, -1, np.int64).view(np.uint64))
    v.read("dé", b"w\xc3\xb6rter x")
    want = [r["h"] for r in spark.createDataFrame([("dé", "wörter"), ("dé", "x")], "g string, w string").selectExpr("xxhash64(g, w) AS h").collect()]
    assert np.array(v.hashes[1:], np.uint64).view(np.int64).tolist() == want
