"""Places, ranks, chains and shards from the stored layout, whatever the executor does with partitions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import identity, placement

DOCS = "/root/testdata/sf0.1/documents.parquet"


@pytest.fixture(params=["true", "false"])
def adaptive(spark, request):
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    yield request.param
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_positions_of_documents_with_their_texts(spark, adaptive):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    placed = placement.positioned(docs.repartition(13), ["doc_id"])
    ids = sorted(r[0] for r in docs.select("doc_id").collect())
    assert [r["doc_id"] for r in placed.select("doc_id", "pos").orderBy("pos").collect()] == ids
    assert sorted(r["pos"] for r in placed.select("pos").collect()) == list(range(len(ids)))
    assert placed.agg(F.sum(F.length("text"))).first()[0] == docs.agg(F.sum(F.length("text"))).first()[0]


def test_chain_and_shards_of_documents(spark, adaptive):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    rows = {r["doc_id"]: (r["expected"], r["text"]) for r in identity.chain(docs, "text", "doc_id").collect()}
    want, before = {}, identity.GENESIS
    for r in docs.orderBy("doc_id").collect():
        want[r["doc_id"]] = (before, r["text"])
        before = hashlib.sha256(r["text"].encode()).hexdigest()
    assert rows == want and sum(e == identity.GENESIS for e, _ in rows.values()) == 1
    sizes = [r["count"] for r in identity.shards(docs, ["doc_id"], 7).groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [1429] * 4 + [1428] * 3


def test_ranks_in_one_group_of_all_rows(spark, adaptive):
    rows = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 100 < 97, "hot").when(F.col("id") % 100 == 97, "cold").alias("g"), F.lit(1).alias("r"), F.repeat(F.lit("x"), 400).alias("pad"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    got = placement.ranked(rows, ["g"], [F.desc("id")], "place", "n")
    assert got.columns == ["id", "g", "r", "pad", "place", "n"]
    by = {}
    for r in sorted(got.drop("pad").collect(), key=lambda r: -r["id"]):
        by.setdefault(r["g"], []).append((r["place"], r["n"]))
    assert {g: len(v) for g, v in by.items()} == {"hot": 19_400, "cold": 200, None: 400}
    assert all(v == [(i, len(v)) for i in range(len(v))] for v in by.values())


def test_a_hot_group_spreads_over_partitions_and_no_window_sees_it(spark):
    rows = spark.range(40_000).select("id", F.lit("one").alias("g"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid = placement.laid_out(rows, ["g", "id"])
        sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 20_000
        plan = placement.ranked(rows, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if " Window " in line]
        assert windows and all("_part" in line or "_n" in line for line in windows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_and_ties(spark):
    none = spark.createDataFrame([], "g string, v int, pos long")
    assert not placement.ranked(none, ["g"], ["v"]).count() and not placement.positioned(none.drop("pos"), ["v"]).count()
    same = spark.createDataFrame([("a", 1)] * 5 + [("b", None)] * 3, "g string, v int")
    got = [(r["g"], r["place"]) for r in placement.ranked(same, ["g"], ["v"]).collect()]
    assert sorted(got) == [("a", i) for i in range(5)] + [("b", i) for i in range(3)]


def errata(spark, rows):
    return spark.createDataFrame(rows, "snapshot_id string, day_a int, hash_a string, day_b int, hash_b string")


def test_errata_excuse_contents_only_day_by_day(spark):
    b = spark.createDataFrame([("a", 1, "H1"), ("a", 2, "H2"), ("a", 3, "H2"), ("a", 3, "H2"), ("b", 1, "H1"), ("b", 2, "H2")], "snapshot_id string, day int, payload string")
    got = lambda e: sorted(tuple(r) for r in identity.collisions(b, errata(spark, e)).collect())
    assert got([("a", 1, "H1", 2, "H2")]) == [("a", 1, "H1", 3, "H2"), ("b", 1, "H1", 2, "H2")]
    assert got([("a", 1, "H1", 2, "H2"), ("a", 3, "H2", 1, "H1"), ("b", 2, "H2", 1, "H1")]) == []
    # another id, another hash, a day that is not there, and the same erratum twice excuse nothing
    assert got([("c", 1, "H1", 2, "H2"), ("a", 1, "H2", 2, "H1"), ("a", 1, "H1", 9, "H2"), ("a", 1, "H1", 2, "H2"), ("a", 1, "H1", 2, "H2")]) == [("a", 1, "H1", 3, "H2"), ("b", 1, "H1", 2, "H2")]
    assert len(identity.collisions(b).collect()) == 2
