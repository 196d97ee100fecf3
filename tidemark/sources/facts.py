"""A fact table stored by snapshot: listed from its folders, read by partition.

``facts(snapshot, system, package, dependent struct<system, id>, depth, ...)``: the nested dependent is stored as it is, and a query reads the fields
it names. A day's scan prunes by a literal, a join prunes at run time by the snapshots of the other side.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "snapshot"


def write_facts(facts: DataFrame, path: str) -> None:
    """Append by snapshot; each snapshot's rows are spread over tasks by package, so a large one is written by several."""
    facts.repartition(PARTITION, F.pmod(F.xxhash64("package"), F.lit(8))).sortWithinPartitions(PARTITION, "package").write.mode("append").partitionBy(PARTITION).parquet(path)


def read_facts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def partitions(spark: SparkSession, path: str) -> list[str]:
    """Snapshots in ascending order, from the listing of the folders: no data file is opened."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return sorted(unquote(n.removeprefix(f"{PARTITION}=")) for n in names if n.startswith(f"{PARTITION}=") and "__HIVE_DEFAULT_PARTITION__" not in n)


def newest(spark: SparkSession, path: str, before: str, n: int) -> list[str]:
    """The newest ``n`` snapshots before a moment, newest first."""
    return [x for x in reversed(partitions(spark, path)) if x < before][:n]


def at(facts: DataFrame, snapshots: list[str]) -> DataFrame:
    """Rows of some snapshots: a predicate on the partition column."""
    return facts.where(F.col(PARTITION).isin(*(F.lit(x).cast(facts.schema[PARTITION].dataType) for x in snapshots)))


def of_calendar(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of the snapshots of ``calendar(snapshot, ...)`` with its columns; Spark prunes the fact table by them at run time."""
    return facts.join(calendar, PARTITION)
