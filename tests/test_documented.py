"""Resolution guard, prospect ids, backtest."""

import datetime
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import backtest, resolution

SCHEMA = "record_id string, owner string, core string, digest string, external_id string, size int, lang string"


def resolve(spark, rows, **how):
    r = spark.createDataFrame(rows, SCHEMA)
    return {x["record_id"]: x for x in resolution.review_band(r, resolution.clusters(r, ["size", "lang"], **how)).collect()}


def test_a_chain_stays_apart(spark):
    chain = [("a", "o", "n1", "D", None, None, None), ("b", "o", "n2", "D", "X", None, None), ("c", "o", "n3", None, "X", 1, "en"), ("d", "o", "n3", None, None, 1, "en")]
    pair = [("p", "o", "m", "E", None, None, None), ("q", "o", "m", "E", None, None, None)]
    got = resolve(spark, chain + pair)
    assert [got[k]["cluster_id"] for k in "abcd"] == list("abcd") and {got[k]["state"] for k in "abcd"} == {"vetoed"}
    assert [got[k]["cluster_id"] for k in "pq"] == ["p", "p"] and got["q"]["state"] == "merged" and not got["q"]["review"]
    # with room for four it is one cluster
    got = resolve(spark, chain + pair, max_records=4)
    assert {got[k]["cluster_id"] for k in "abcd"} == {"a"}


def test_absent_attributes_and_owners(spark):
    rows = [("a", "o", "n", None, None, 1, None), ("b", "o", "n", None, None, 1, None), ("c", "o", "n", None, None, 1, "en"), ("d", "o", "n", None, None, 1, "en"), ("e", "o", "n", None, None, 2, "en"), ("f", "o", "z", "D", None, 1, "en"), ("g", "other", "y", "D", None, 1, "en"), ("h", None, None, None, None, None, None)]
    got = resolve(spark, rows)
    assert got["a"]["cluster_id"] == "a" and got["b"]["state"] == "single" and got["a"]["review"]
    assert got["d"]["cluster_id"] == "c" and got["e"]["state"] == "single" and got["e"]["review"]
    assert got["f"]["state"] == got["g"]["state"] == "vetoed" and got["f"]["owners"] == 2 and got["g"]["review"]
    assert got["h"]["state"] == "single" and not got["h"]["review"]


def slow(rows, most, owners):
    keys = {}
    for rec, _, core, digest, ext, size, lang in rows:
        for k in (("d", digest) if digest else None, ("x", ext) if ext else None, ("c", core, size, lang) if None not in (core, size, lang) else None):
            if k:
                keys.setdefault(k, []).append(rec)
    parent = {r[0]: r[0] for r in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for group in keys.values():
        for a, b in itertools.pairwise(group):
            parent[find(a)] = find(b)
    out = {}
    for r in rows:
        whole = [x for x in rows if find(x[0]) == find(r[0])]
        state = "single" if len(whole) == 1 else "merged" if len(whole) <= most and len({x[1] for x in whole}) <= owners else "vetoed"
        out[r[0]] = (min(x[0] for x in whole) if state == "merged" else r[0], state)
    return out


@pytest.mark.parametrize(("seed", "most"), [(0, 2), (1, 3), (2, 4), (3, 5)])
def test_random_registers(spark, seed, most):
    r = np.random.default_rng(seed)
    pick = lambda head, n, none: None if r.random() < none else f"{head}{r.integers(n)}"
    rows = [(f"r{i:03}", pick("o", 3, 0) if i % 5 == 0 else "o0", pick("n", 60, 0.1), pick("d", 90, 0.4), pick("x", 100, 0.5), int(r.integers(3)), pick("l", 2, 0.3)) for i in range(120)] + [(f"h{i}", "o0", None, "hot", None, None, None) for i in range(40)]
    got = resolve(spark, rows, max_records=most)
    assert {k: (v["cluster_id"], v["state"]) for k, v in got.items()} == slow(rows, most, 1)


def test_prospects_expire(spark):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    rec = spark.createDataFrame([(k, day(0)) for k in "abcdefg"] + [("new", day(40)), ("future", day(90))], "record_id string, first_seen timestamp")
    res = spark.createDataFrame([("a", "a", "merged"), ("b", "a", "merged"), ("c", "c", "vetoed"), ("d", "d", "vetoed"), ("e", "e", "single"), ("f", "f", "single"), ("g", "g", "single"), ("new", "new", "single"), ("future", "future", "single")], "record_id string, cluster_id string, state string")
    ev = spark.createDataFrame([("b", "hard_id", day(30)), ("c", "hard_id", day(5)), ("d", "human", day(5)), ("e", "hard_id", day(31)), ("f", "hard_id", day(-1)), ("g", "guess", day(3)), ("new", "human", day(61))], "record_id string, kind string, at timestamp")
    got = lambda n: {r["record_id"]: (r["id_state"], r["id"][0]) for r in resolution.promoted(rec, res, ev, F.lit(day(n))).collect()}
    late = got(60)
    assert {k: v[0] for k, v in late.items()} == {"a": "permanent", "b": "permanent", "c": "expired", "d": "permanent", "e": "expired", "f": "expired", "g": "expired", "new": "prospect"}
    assert late["a"][1] == "e" and late["c"][1] == "p"
    assert got(20)["a"][0] == "prospect" and got(20)["e"][0] == "prospect"
    ids = {r["record_id"]: r["id"] for r in resolution.promoted(rec, res, ev, F.lit(day(60))).collect()}
    assert ids["a"] == ids["b"] and len(set(ids.values())) == len(ids) - 1


def exact(a, b, c, d):
    rows, columns, n = a + b, a + c, a + b + c + d
    return sum(math.comb(columns, x) * math.comb(n - columns, rows - x) for x in range(a, min(rows, columns) + 1)) / math.comb(n, rows)


def test_fisher_equals_the_hypergeometric_sum(spark):
    r = np.random.default_rng(1)
    tables = [tuple(int(x) for x in r.integers(0, top, 4)) for top in (3, 10, 40, 400, 3000) for _ in range(25)] + [(0, 0, 0, 0), (5, 0, 0, 5), (0, 7, 0, 9), (29, 51, 11, 69), (900, 100, 100, 900), (0, 3000, 3000, 0), (16, 9, 6, 4)]
    df = spark.createDataFrame([(*t, i) for i, t in enumerate(tables)], "a long, b long, c long, d long, i int")
    got = {x["i"]: x["p"] for x in df.select("i", backtest.fisher_greater(*(F.col(k) for k in "abcd")).alias("p")).collect()}
    for i, t in enumerate(tables):
        assert got[i] == pytest.approx(exact(*t), rel=1e-8, abs=1e-300), t


def test_no_looking_ahead(spark):
    activity = [("fast", p, 5.0 if p > 2 else 1.0) for p in range(5)] + [("wakes", 0, 1.0), ("wakes", 5, 99.0)] + [("famous", p, 5.0 if p > 2 else 1.0) for p in range(5)] + [("unborn", 6, 9.0)]
    clock = [("fast", 7, 10.0), ("wakes", 6, 10.0), ("famous", 1, 10.0), ("unborn", 7, 10.0)]
    schema = "entity_id string, pos long, value double"
    s = backtest.signals(spark.createDataFrame(activity, schema), [4], 2)
    o = backtest.reached(spark.createDataFrame(clock, schema), 10.0)
    got = {r["lag"]: r for r in backtest.lead_tables(s, o, [2, 3, 9], [4.0], 8).collect()}
    # "wakes" is slow at the cutoff whatever comes later, "famous" and "unborn" are no cases, a lag beyond the last period is left out
    assert sorted(got) == [2, 3]
    assert tuple(got[3][k] for k in "abcd") == (1, 0, 1, 0) and tuple(got[2][k] for k in "abcd") == (0, 1, 1, 0)
    assert got[3]["precision"] == 1.0 and got[3]["risk_ratio"] == 1.0 and got[3]["odds_ratio"] is None
