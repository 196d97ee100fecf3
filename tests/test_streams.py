"""Sinks that are broken off and run again, timers, late rows."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException

from tidemark.plans.integrity import rocksdb
from tidemark.streaming import exactly_once, timers


def day(n, hours=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n, hours=hours)


def feed(spark, tmp_path, schema, batches, build, mode="append"):
    """Run a stream batch by batch over one checkpoint; returns the rows of each run."""
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    seen, runs = 0, []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        got = build(spark.readStream.schema(schema).parquet(src))
        ledger = exactly_once.BatchLedger(spark, out)
        got.writeStream.outputMode(mode).option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(ledger.sink(lambda b, _: {"rows": b})).start().awaitTermination()
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in got.schema)
        found = ledger.read("rows", names).where(f"batch >= {seen}").drop("batch").collect()
        seen = ledger.newest() + 1
        runs.append(sorted(tuple(r) for r in found))
    return runs


@pytest.mark.parametrize("at", ["in the second table", "before the entry", "after the entry"])
def test_a_killed_batch_is_visible_once(spark, tmp_path, at):
    ledger, dead = exactly_once.BatchLedger(spark, str(tmp_path / "out")), []

    def die(where):
        def run(epoch):
            if where == at and epoch == 1 and not dead:
                dead.append(epoch)
                raise RuntimeError("killed")

        return run

    def tables(b, epoch):
        yield "a", b
        die("in the second table")(epoch)
        yield "b", b.where("id % 2 = 0")

    sink = ledger.sink(lambda b, e: type("T", (), {"items": lambda _: tables(b, e)})(), die("before the entry"), die("after the entry"))
    src = str(tmp_path / "in")
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).write.mode("append").parquet(src)
        for _ in range(2):
            before = sorted(r["id"] for r in ledger.read("a", "id long").collect())
            assert before == list(range(len(before))) and len(before) % 10 == 0
            try:
                spark.readStream.schema("id long").parquet(src).writeStream.option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
            except StreamingQueryException:
                assert dead
    assert dead and ledger.newest() == 2
    assert sorted(r["id"] for r in ledger.read("a", "id long").collect()) == list(range(30))
    assert sorted(r["id"] for r in ledger.read("b", "id long").collect()) == list(range(0, 30, 2))
    assert len(list((tmp_path / "out" / "ledger").glob("0*"))) == exactly_once.KEEP


def test_an_unentered_batch_does_not_show(spark, tmp_path):
    ledger = exactly_once.BatchLedger(spark, str(tmp_path))
    assert ledger.newest() == -1 and not ledger.read("rows", "id long").count()
    spark.range(3).write.parquet(f"{tmp_path}/rows/batch=0")
    assert not ledger.read("rows", "id long").count()
    ledger.enter(0)
    assert ledger.read("rows", "id long").count() == 3
    with pytest.raises(Exception, match="exists"):
        ledger.enter(0)


def test_late_rows_are_judged_by_the_batches_before(spark, tmp_path):
    tables = exactly_once.split_late(str(tmp_path), "ts", 86_400)
    frame = lambda *days: spark.createDataFrame([(day(n),) for n in days], "ts timestamp")
    got = lambda rows, epoch: {k: sorted(r["ts"] for r in v.collect()) for k, v in tables(rows, epoch).items()}
    assert got(frame(5, 1), 0) == {"rows": [day(1), day(5)], "late": []}
    for _ in range(2):  # run again: judged the same
        assert got(frame(3, 4, 9), 1) == {"rows": [day(4), day(9)], "late": [day(3)]}
    assert got(frame(), 2) == {"rows": [], "late": []}
    assert got(frame(7, 8), 3) == {"rows": [day(8)], "late": [day(7)]}


def test_silent_entity_is_reported_once_while_others_go_on(spark, tmp_path):
    batches = [[("a", day(0)), ("a", day(1)), ("b", day(0))], [("b", day(9))], [("b", day(10)), ("a", day(9, 5))], [("b", day(20))], [("b", day(21))]]
    with rocksdb(spark):
        runs = feed(spark, tmp_path, "entity_id string, captured_at timestamp", batches, lambda x: timers.silent_entities(x, 3))
    told = sorted(r for run in runs for r in run)
    assert told == [("a", day(4), 2), ("a", day(12, 5), 1), ("b", day(3), 1), ("b", day(13), 2)] or [r for r in told if r[0] == "a"] == [("a", day(4), 2), ("a", day(12, 5), 1)]


def test_standing_changes_and_expiry(spark, tmp_path):
    schema = "observation_id string, supersedes string, captured_at timestamp, status string, value double"
    first = [("o1", None, day(0), "active", 1.0), ("o2", None, day(0), "active", 2.0), ("o2-r", "o2", day(0), "retracted", 9.0)]
    later = [("o1-r", "o1", day(2), "retracted", None), ("o3", None, day(60), "active", 3.0)]
    gone = [("o2-x", "o2", day(60), "active", None), ("o3-s", "o3", day(61), "active", None)]
    with rocksdb(spark):
        runs = feed(spark, tmp_path, schema, [first, later, gone], lambda x: timers.standing_changes(x, 30), "update")
    assert runs[0] == [("o1", "active", 1.0), ("o2", "retracted", 2.0)]
    assert runs[1] == [("o1", "retracted", 1.0), ("o3", "active", 3.0)]
    assert [r for r in runs[2] if r[0] == "o3"] == [] and [r[:2] for r in runs[2]] == [("o2", "active")] and runs[2][0][2] is None
