"""Clustering against plain distances in whole numbers of any size."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tidemark.llm import centroids


def slow(rows, k=8, rounds=10, dim=64, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: (i is None, "" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest())
    c = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    apart = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w, strict=True))
    near = lambda v: min(range(len(c)), key=lambda j: (apart(v, c[j]), j))
    for _ in range(rounds):
        of = [near(v) for _, v in kept]
        c = [[sum(x) // len(x) for x in zip(*members, strict=True)] if (members := [v for (_, v), o in zip(kept, of, strict=True) if o == j]) else c[j] for j in range(len(c))]
    last = [(i, near(v), apart(v, c[near(v)])) for i, v in kept]
    total = sum(d for *_, d in last)
    return [(i, j, d, sum(e for _, m, e in last if m == j), total, hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in last]


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, v int")


def same(df, want):
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)


def test_awkward_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(r.normal(0, 0.3, (60, 64)))]
    rows += [(60, None), (61, []), (62, [0.5] * 63), (63, [0.1] * 65), (64, [None] + [0.1] * 63), (65, [float("nan")] * 64), (66, [float("inf")] * 64), (66, [float("-inf")] + [0.0] * 63)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [0.0] * 64), *((100 + i, [-0.25] * 64) for i in range(20))]
    same(centroids.cluster(table(spark, rows)), slow(rows))


def test_ties_and_planes(spark):
    """Few different values, so that many vectors lie on the planes between centroids."""
    r = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(r.integers(-1, 2, (120, 4)).astype(float).tolist())]
    same(centroids.cluster(table(spark, rows), k=5, dim=4, scale=1), slow(rows, 5, 10, 4, 1))
    same(centroids.cluster(table(spark, rows), k=5, dim=4, scale=3), slow(rows, 5, 10, 4, 3))


def test_few_none_and_copies(spark):
    few = [(3, [0.5] * 64), (1, [0.25] * 64)]
    same(centroids.cluster(table(spark, few)), slow(few))
    copies = [(i, [0.125] * 64) for i in range(30)]
    same(centroids.cluster(table(spark, copies)), slow(copies))
    assert not centroids.cluster(table(spark, few).limit(0)).count()


def test_wide_components(spark):
    r = np.random.default_rng(3)
    wide = [(i, v) for i, v in enumerate((r.uniform(-1, 1, (50, 64)) * 8192).tolist())]
    same(centroids.cluster(table(spark, wide, "double")), slow(wide))
    with pytest.raises(PySparkException, match="beyond"):
        centroids.cluster(table(spark, [(1, [1e30] * 64)], "double")).collect()


def test_widest_components():
    r = np.random.default_rng(5)
    c, x = (np.where(r.integers(0, 2, (n, 64)) == 1, 1, -1) * centroids.LIMIT for n in (8, 40))
    t = centroids.Tournament(c.tolist())
    best = t.winners(x)
    d = [[sum((a - b) ** 2 for a, b in zip(v, w, strict=True)) for w in c.tolist()] for v in x.tolist()]
    assert best.tolist() == [row.index(min(row)) for row in d] and t.distances(x, best).tolist() == [min(row) for row in d]


def test_tournament_is_nearest():
    r = np.random.default_rng(4)
    for _ in range(50):
        c, x = r.integers(-3, 4, (6, 3)), r.integers(-4, 5, (200, 3))
        t = centroids.Tournament(c.tolist())
        best = t.winners(x)
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (best == d.argmin(axis=1)).all() and (t.distances(x, best) == d.min(axis=1)).all()


@pytest.mark.parametrize("name", ["op12_centroids", "op13_phrases"])
def test_registered_queries_equal_their_sql(spark, name):
    from tests.compare import compare, connect
    from tidemark.llm import registry

    sf = "/root/testdata/sf0.01"
    why, rows = compare(spark, connect(sf), name, registry.queries()[name], registry.oracle_sql()[name], sf)
    assert rows > 0 and not why, why
