"""Exactly-once batch sinks: what a micro-batch writes is visible once, however often the batch runs.

A batch writes into a folder of its own number, replacing what an earlier attempt left there, and is then entered in a
ledger by creating a file (which succeeds once). Readers see the batches up to the newest entry, so neither a half-written
batch nor a second copy of one shows. Numbers come from the stream's checkpoint, which counts on after a restart; a ledger
therefore belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = 2  # entries that stay in the ledger: numbers are contiguous, the newest one stands for all before


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def newest(self) -> int:
        """The newest batch that is entered, -1 for none; a listing of ``KEEP`` files."""
        p, fs = self._files(f"{self.path}/ledger")
        return max((int(f.getPath().getName()) for f in fs.listStatus(p)), default=-1) if fs.exists(p) else -1

    def enter(self, epoch: int) -> None:
        p, fs = self._files(f"{self.path}/ledger/{epoch:012d}")
        fs.create(p, False).close()
        old, fs = self._files(f"{self.path}/ledger/{epoch - KEEP:012d}")
        fs.delete(old, False)

    def sink(self, tables: Callable[[DataFrame, int], dict[str, DataFrame]], before: Callable[[int], None] = lambda _: None, after: Callable[[int], None] = lambda _: None) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that writes ``tables(batch, number)``, all of them or none.

        ``before`` and ``after`` run around the ledger's entry; tests break a stream there.
        """

        def run(batch: DataFrame, epoch: int) -> None:
            if epoch <= self.newest():
                return  # the entry was made, but the stream died before it knew
            for name, rows in tables(batch, epoch).items():
                rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={epoch}")
            before(epoch)
            self.enter(epoch)
            after(epoch)

        return run

    def read(self, name: str, schema: str) -> DataFrame:
        """Rows of a table's entered batches, with their ``batch`` (a partition column)."""
        p, fs = self._files(f"{self.path}/{name}")
        if not fs.exists(p):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{name}").where(F.col("batch") <= self.newest())


def split_late(marks: str, time: str = "captured_at", late_seconds: int = 86_400) -> Callable[[DataFrame, int], dict[str, DataFrame]]:
    """Tables ``rows`` and ``late`` of a batch: late are rows more than ``late_seconds`` behind the newest row of earlier batches.

    The newest time up to a batch is stored under ``marks`` by the batch's number: a batch reads the one before it, so it is judged
    as before when it runs again.
    """

    def run(batch: DataFrame, epoch: int) -> dict[str, DataFrame]:
        spark = batch.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{marks}/{epoch - 1}")
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        seen = spark.read.schema("newest timestamp").parquet(f"{marks}/{epoch - 1}").first()["newest"] if there else None
        newest = batch.agg(F.greatest(F.max(time).cast("timestamp"), F.lit(seen).cast("timestamp")).alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{marks}/{epoch}")
        late = F.coalesce(F.col(time) < F.lit(seen).cast("timestamp") - F.make_dt_interval(secs=F.lit(late_seconds)), F.lit(False))
        return {"rows": batch.where(~late), "late": batch.where(late)}

    return run


def refusing(tables: Callable[[DataFrame, int], dict[str, DataFrame]], failed, limit: float = 0.20) -> Callable[[DataFrame, int], dict[str, DataFrame]]:
    """``tables`` of batches whose share of failed rows is at most ``limit``; any other batch raises, and nothing of it is written."""

    def run(batch: DataFrame, epoch: int) -> dict[str, DataFrame]:
        rate = batch.agg(F.avg(failed.cast("double"))).first()[0]
        if rate is not None and rate > limit:
            raise ValueError(f"batch {epoch} refused: {rate:.0%} of its rows failed")
        return tables(batch, epoch)

    return run
