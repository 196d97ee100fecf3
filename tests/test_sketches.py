"""Stored sketches, slope selection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import slopes
from tidemark.operators import panel, sketches


def facts(spark, path):
    r = np.random.default_rng(7)
    rows = [(f"d{k % 6}", f"e{k % 3}", int(v)) for k, v in enumerate(r.zipf(1.3, 30_000).clip(0, 10**6))]
    df = spark.createDataFrame(rows, "day string, entity string, member long")
    df.write.partitionBy("day").parquet(path)
    return rows, spark.read.parquet(path)


def test_states_are_built_once_and_merge_over_partitions(spark, tmp_path):
    rows, df = facts(spark, str(tmp_path / "facts"))
    state = str(tmp_path / "state")
    build = lambda x: sketches.bottoms(x, ["day", "entity"], "member", 32)
    assert sketches.refresh(df.where("day < 'd3'"), state, "day", build) == ["d0", "d1", "d2"]
    # partitions with states are not read again: their files may be gone
    for f in (tmp_path / "facts" / "day=d0").glob("*.parquet"):
        f.write_bytes(b"gone")
    assert sketches.refresh(df, state, "day", build) == ["d3", "d4", "d5"]
    assert sketches.refresh(df, state, "day", build) == []
    states = spark.read.parquet(state)
    assert states.groupBy("day", "entity").count().agg(F.max("count")).first()[0] == 32
    for some in (["d0", "d1"], ["d5"], [f"d{k}" for k in range(6)]):
        got = {r["entity"]: r["sketch"] for r in sketches.merged_bottoms(states.where(F.col("day").isin(some)), ["entity"], 32).collect()}
        plain = spark.createDataFrame([r for r in rows if r[0] in some], "day string, entity string, member long")
        want = {r["entity"]: r["sketch"] for r in sketches.merged_bottoms(sketches.bottoms(plain, ["entity"], "member", 10**6), ["entity"], 32).collect()}
        assert got == want


@pytest.mark.parametrize("places", [32, 128])
def test_merged_hitters_keep_their_error_bound(spark, tmp_path, places):
    rows, df = facts(spark, str(tmp_path / "facts"))
    state = str(tmp_path / "state")
    sketches.add_states(sketches.hitter_states(df, ["day", "entity"], "member", places), state, "day")
    true = {}
    for _, e, v in rows:
        true[e, v] = true.get((e, v), 0) + 1
    assert len({v for _, v in true}) > 10 * places
    got = {}
    for r in sketches.merged_hitters(spark.read.parquet(state), ["entity"], places * 3 // 4, places).collect():
        got[r["entity"], r["value"]] = r["n"]
        assert r["rows"] == 10_000 and abs(r["n"] - true[r["entity"], r["value"]]) <= r["error"] == sketches.ERROR * 10_000 / places
    heavy = {k for k, n in true.items() if n > 2 * sketches.ERROR * 10_000 / places}
    assert heavy and heavy <= set(got)


def test_slopes_of_every_rank():
    r = np.random.default_rng(0)
    for n in (2, 3, 5, 40, 401):
        for y in (r.normal(size=n), np.zeros(n), r.integers(0, 3, n).astype(float), np.log1p(r.integers(0, 50, n)) - 0.01 * np.arange(n)):
            x = np.cumsum(r.integers(1, 4, n)).astype(float)
            i, j = np.triu_indices(n, 1)
            s = np.sort((y[j] - y[i]) / (x[j] - x[i]))
            for rank in {0, len(s) // 3, len(s) // 2, len(s) - 1}:
                got = slopes.slope_of_rank(x, y, rank)
                assert got == pytest.approx(s[rank], rel=1e-12, abs=1e-14) and np.sign(got) == np.sign(s[rank])


def test_theil_sen_has_no_pairs_in_its_plan(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(f"e{e}", i, float(v)) for e, n in enumerate((1, 2, 3, 30, 700)) for i, v in enumerate(r.normal(size=n))] + [("null", 0, None), ("null", 1, 2.0)]
    df = spark.createDataFrame(rows, "entity string, i int, y double")
    got = panel.theil_sen(df, ["entity"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("ArrowEvalPython") == 1
    want = {}
    for e in {x[0] for x in rows}:
        p = [(i, v) for k, i, v in rows if k == e and v is not None]
        pairs = [(b - a) / (j - i) for n, (i, a) in enumerate(p) for j, b in p[n + 1 :]]
        if pairs:
            want[e] = float(np.median(pairs))
    found = {x["entity"]: x["theil_sen"] for x in got.collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], rel=1e-11) for k in want)
