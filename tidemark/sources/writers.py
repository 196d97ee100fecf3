"""Writers: append-only ledgers, idempotent and verified writes, flat projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.identity import same_table


def append_history(rows: DataFrame, path: str, partition: str = "period") -> None:
    rows.write.mode("append").partitionBy(partition).parquet(path)


def new_only(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key was never captured: what an idempotent append writes."""
    return rows.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def append_once(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Append what is new; writing the same rows again adds nothing."""
    spark = rows.sparkSession
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    (new_only(rows, spark.read.parquet(path), keys) if there else rows.dropDuplicates(keys)).write.mode("append").parquet(path)


def write_or_verify(rows: DataFrame, path: str) -> bool:
    """Write a new table; for one that exists, check that it is equal (else ValueError). Returns whether it wrote."""
    spark = rows.sparkSession
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        rows.write.parquet(path)
        return True
    if not same_table(rows, spark.read.parquet(path).select(*rows.columns)):
        raise ValueError(f"{path} holds other rows")
    return False


def flat_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def feed_json(items: DataFrame, path: str) -> None:
    """A feed's items as JSON lines, spread by id."""
    items.write.mode("overwrite").json(path)


def frontier(rows: DataFrame, path: str, day: str) -> None:
    """One denominator row a date; a date that is there already is an error."""
    rows.agg(F.count("*").alias("candidates")).withColumn("day", F.lit(day)).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{day}")
