"""Published sets, fact stores."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.sources import bundles, facts

PARTS = ["rows", "counts"]


def parts(spark, n):
    return {"rows": spark.range(n).select("id", F.col("id").cast("string").alias("text")), "counts": spark.createDataFrame([(n,)], "n long")}


def test_half_sets_and_tampered_sets_are_passed_over(spark, tmp_path):
    root = str(tmp_path)
    names = {day: bundles.publish(spark, root, day, parts(spark, n), {"day": day}) for n, day in enumerate(["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"], 10)}
    newest = lambda: bundles.newest_complete(spark, root, PARTS)[0]
    at = lambda day: Path(root) / "sets" / names[day]
    bundles.write_set(spark, root, parts(spark, 99), {})  # never pointed to
    assert newest() == "2024-01-29"
    next(at("2024-01-29").glob("rows/part-*")).unlink()
    assert newest() == "2024-01-22"
    shutil.rmtree(at("2024-01-22") / "manifest")
    assert newest() == "2024-01-15"
    # as many bytes, other rows: only the digest tells
    spark.read.parquet(str(at("2024-01-15") / "rows")).coalesce(1).write.parquet(str(tmp_path / "other"))
    sets = bundles.defects(spark, str(at("2024-01-15")), PARTS)
    assert not sets
    listed = spark.read.schema(bundles.MANIFEST).json(str(at("2024-01-15") / "manifest")).withColumn("digest", F.when(F.col("part") == "rows", "00").otherwise(F.col("digest"))).collect()
    shutil.rmtree(at("2024-01-15") / "manifest")
    spark.createDataFrame(listed, bundles.MANIFEST).write.json(str(at("2024-01-15") / "manifest"))
    assert bundles.defects(spark, str(at("2024-01-15")), PARTS) == ["rows: other rows"] and newest() == "2024-01-08"
    assert bundles.newest_complete(spark, root, ["rows"])[0] == "2024-01-08"
    with pytest.raises(ValueError, match="no complete set.*absent: not listed"):
        bundles.newest_complete(spark, root, ["absent"])


def test_a_day_is_published_once(spark, tmp_path):
    root = str(tmp_path)
    first = bundles.publish(spark, root, "d", parts(spark, 2), {"a": "b"})
    with pytest.raises(ValueError, match="published already"):
        bundles.publish(spark, root, "d", parts(spark, 3), {})
    day, at = bundles.newest_complete(spark, root, PARTS)
    assert (day, at) == ("d", f"{root}/sets/{first}") and spark.read.parquet(f"{at}/rows").count() == 2
    with pytest.raises(ValueError, match="no complete set"):
        bundles.newest_complete(spark, f"{root}/none", PARTS)


SCHEMA = "system string, package long, dependent struct<system:string,id:long>, depth int, snapshot date"


def test_facts_are_pruned_by_listing_literal_and_join(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.range(900).select(F.lit("own").alias("system"), (F.col("id") % 50).alias("package"), F.struct(F.lit("x").alias("system"), F.col("id").alias("id")).alias("dependent"), F.lit(1).alias("depth"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("snapshot"))
    facts.write_facts(rows, path)
    assert facts.partitions(spark, path) == [f"2024-01-0{k}" for k in range(1, 10)]
    assert facts.newest(spark, path, "2024-01-07", 2) == ["2024-01-06", "2024-01-05"]
    table = facts.read_facts(spark, path, SCHEMA)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    one = facts.at(table, ["2024-01-03"]).select("dependent.id")
    assert "PartitionFilters: [isnotnull(snapshot" in plan(one).replace("PartitionFilters: [snapshot", "PartitionFilters: [isnotnull(snapshot") and "ReadSchema: struct<dependent:struct<id:bigint>>" in plan(one)
    assert len(one.inputFiles()) and one.count() == 100
    calendar = spark.createDataFrame([(f"2024-01-0{k}", k) for k in range(1, 10)], "d string, k int").select(F.col("d").cast("date").alias("snapshot"), "k").where("k % 4 = 0")
    joined = facts.of_calendar(table, calendar)
    assert "dynamicpruning" in plan(joined).lower() and joined.count() == 200
    facts.write_facts(rows.where("id < 9"), path)
    assert table.sparkSession.read.schema(SCHEMA).parquet(path).count() == 909
    # the listing does not need a readable file
    for f in Path(path).glob("snapshot=2024-01-09/*.parquet"):
        f.write_bytes(b"broken")
    assert facts.partitions(spark, path)[-1] == "2024-01-09"


def test_scratch_tables_go_with_their_scope(spark):
    from tidemark.sources.scratch import scratch, scratch_scope, stored

    with scratch_scope(spark):
        t = stored(spark.range(5), "x")
        inside = Path(t.inputFiles()[0].removeprefix("file:")).parent
        with scratch_scope(spark):
            other = Path(stored(spark.range(3), "y").inputFiles()[0].removeprefix("file:")).parent
        assert t.count() == 5 and inside.exists() and not other.exists()
        scratch(spark, "never written")
    assert not inside.exists()
