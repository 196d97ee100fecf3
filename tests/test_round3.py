"""What the third review found."""

import re

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import census as census_ops
from tidemark.operators import cohort, manifests
from tidemark.plans import base as plans_base
from tidemark.plans import census, dependents, scoring
from tidemark.streaming import timers


def half_even(z1, z2):
    """Momentum in tenths from two scores in thousandths, in whole numbers."""
    m = max(0, min(16_000, 8_000 + z1 + z2))
    return m // 16 + (2 * (m % 16) > 16 or (m % 16 == 8 and m // 16 % 2))


def test_momentum_ties_are_exact(spark):
    z = [(a, b) for a in range(-3000, 3001, 7) for b in (-2665, -1999, -607, 40, 333, 1001, 2998)] + [(-607, -2665)]
    some = spark.createDataFrame(z, "a int, b int").withColumns({"axis1_z": F.col("a") / 1000, "axis2_z": F.col("b") / 1000})
    fixed = {"incumbent": F.lit(False), "cohort_n": F.lit(9), "axis1_slope": F.lit(1.0), "axis2_slope": F.lit(1.0), "axis2_status": F.lit("present"), "recent": F.lit(9.0)}
    got = cohort.gate(some.withColumns(fixed), cohort.Methodology()).select("a", "b", "momentum").collect()
    assert [(r["a"], r["b"], r["momentum"]) for r in got if r["momentum"] != half_even(r["a"], r["b"]) / 10] == []
    assert {r["momentum"] for r in got if (r["a"], r["b"]) == (-607, -2665)} == {29.6}


class Store:
    """State and timers of one key, in memory."""

    def __init__(self):
        self.one, self.many, self.timers = None, {}, set()

    getValueState = getMapState = lambda self, *_: self
    exists = lambda self: self.one is not None
    get = lambda self: self.one
    registerTimer = lambda self, t: self.timers.add(t)
    listTimers = lambda self: iter(self.timers)
    deleteTimer = lambda self, t: self.timers.discard(t)
    containsKey = lambda self, k: k in self.many
    getValue = lambda self, k: self.many[k]
    iterator = lambda self: iter(self.many.items())
    removeKey = lambda self, k: self.many.pop(k)

    def update(self, v):
        self.one = v

    def updateValue(self, k, v):
        self.many[k] = v


class Clock:
    def __init__(self, day):
        self.getCurrentWatermarkInMs = lambda: day * timers.DAY


def test_observations_of_a_key_are_handled_together():
    store, p = Store(), timers._Standing(16)
    p.init(store)
    day = lambda n: pd.Timestamp("1970-01-01") + pd.Timedelta(days=n)

    def send(rows, now):
        frame = pd.DataFrame(rows, columns=["target", "supersedes", "captured_at", "status", "value"])
        return sorted(tuple(r) for out in p.handleInputRows((7,), iter([frame[:3], frame[3:]]), Clock(now)) for r in out.itertuples(index=False))

    assert len(send([(f"o{i}", None, day(i % 4), "active", float(i)) for i in range(100)], 0)) == 100
    assert len(store.many) == 100 and len(store.timers) == 3
    assert send([("o1", "o1", day(3), "retracted", None), ("o2", "o2", day(1), "retracted", None)], 2) == [("o1", "retracted", 1.0)]
    # the last rows of o4, o8, ... are of day 0: they have expired on day 16, whether or not they were removed
    assert [(r[0], r[1], r[2] == r[2]) for r in send([("o4", "o4", day(16), "retracted", None), ("o3", "o3", day(16), "retracted", None)], 16)] == [("o3", "retracted", True), ("o4", "retracted", False)]
    list(p.handleExpiredTimer((7,), Clock(18), None))
    assert len(store.many) == 25 + 2 and store.one == (27,)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_manifests_are_read_beside_their_rows_and_once(spark):
    sf = "/root/testdata/sf0.001"
    assert "Exchange" not in plan(census.classified(spark, sf)) and "ArrowEvalPython" in plan(census.classified(spark, sf))
    assert plan(census.ag_22(spark, sf)).count("EvalPython") == 1
    rows = spark.range(700).select("id", F.lit("requirements.txt").alias("file"), F.concat(F.lit("Some_Thing>=1\nb"), F.col("id").cast("string")).alias("text"))
    got = manifests.parse_manifests(rows.coalesce(1)).collect()  # more than two slices of one batch
    assert [(r["id"], r["own_name"], r["deps"]) for r in got] == [(i, None, [f"b{i}", "some-thing"]) for i in range(700)]


def test_series_are_dealt_once_by_entity(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(plans_base, "TASK_ROWS", 2_000)
    for df in (scoring.st_12(spark, sf), scoring.st_14(spark, sf), scoring.st_15(spark, sf)):
        text = plan(df)
        assert "hashpartitioning(entity_id#" in text and text.count("REPARTITION_BY_NUM") == text.count("Exchange hashpartitioning") and "pos#" not in "".join(re.findall(r"hashpartitioning\(.*?\)", text))
    base = plan(plans_base.scores(spark, sf))
    assert "lineitem" not in base  # the series are read once, for the stored rows


def test_facts_are_dealt_by_order_and_counted_where_packages_are(spark, monkeypatch):
    """A task of ``ag_11`` holds a fixed number of rows, and its groups are not dealt once more."""
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(plans_base, "TASK_ROWS", 500)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    tasks = -(-lines // 500)
    text = plan(dependents.ag_11(spark, sf))
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\d+)\), (\w+)", text)) >= {("l_orderkey", str(tasks), "REPARTITION_BY_NUM"), ("package", str(tasks), "REPARTITION_BY_NUM")}
    assert "hashpartitioning(entity" not in text and text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM")
    assert "hashpartitioning(l_orderkey" in plan(dependents.facts(spark, sf))
    got = {tuple(r)[:4]: r["n"] for r in dependents.ag_11(spark, sf).collect()}
    monkeypatch.setattr(plans_base, "TASK_ROWS", 250_000)
    assert got == {tuple(r)[:4]: r["n"] for r in dependents.ag_11(spark, sf).collect()} and 0 < sum(got.values()) <= lines


def test_title_pairs_count_at_their_first_common_token(spark):
    e = spark.createDataFrame([(1, "Fast Parser", "org/fast-parser"), (2, "other", "x/other")], "entity_id int, name string, repo string")
    w = spark.createDataFrame([(k, f"Fast parser: number {k}", 2020, 0) for k in range(40)], "work_id int, title string, year int, cited int")
    got = census_ops.title_candidates(e, w)
    assert sorted((r["entity_id"], r["work_id"]) for r in got.collect()) == [(1, k) for k in range(40)]
    assert not re.search(r"keys?=\[(entity_id#\w+, work_id|work_id#\w+, entity_id)", plan(got))


def test_entities_of_one_repository_are_linked_once(spark):
    e = spark.range(50).select(F.col("id").alias("entity_id"), F.when(F.col("id") % 2 == 0, "org/big-thing").otherwise("org/lone").alias("repo"))
    p = spark.createDataFrame([("b", "bigthing", ["https://h/org/big-thing"], False), ("a", "big_thing", ["https://h/org/big-thing"], None), ("a", "big-thing", ["https://h/else"], False), ("c", "lone", [], True), ("a", "lone", ["https://h/org/lone"], None)], "system string, package string, links array<string>, errored boolean")
    got = census_ops.first_linked_package(e, p, ["a", "b"])
    assert {tuple(r)[1:] for r in got.where("entity_id % 2 = 0").collect()} == {("a", "big_thing", "matched")} and got.count() == 50
    assert {tuple(r)[1:] for r in got.where("entity_id % 2 = 1").collect()} == {("a", "lone", "matched")}
    assert "Window" not in plan(got)
