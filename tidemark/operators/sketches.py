"""Set and frequency sketches that are stored per partition and merged over any of them; old partitions are not read again.

``bottom``: the k least fingerprints of a group's members. The bottom of a union is the bottom of the parts' bottoms, so a
merge is exact. ``hitters``: Spark's top-k state over ``places`` values; a merged estimate is off by at most ``ERROR / places`` of
the group's rows, however many values it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.dependents import fingerprint64

ERROR = 3.5  # fixed value: of the frequent-items sketch behind the state, for places that are a power of two


def bottoms(rows: DataFrame, keys: list[str], member: str, k: int = 64) -> DataFrame:
    """(keys, fp): at most ``k`` rows a group, its least fingerprints; the cut runs before the groups meet."""
    distinct = rows.select(*keys, fingerprint64(member).alias("fp")).distinct()
    return least(distinct, keys, k)


def least(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` least distinct ``fp`` of each group, cut first inside salts so that no task sorts a whole large group."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("fp"), F.lit(16)))
    part = Window.partitionBy(*keys, "_salt").orderBy("fp")
    some = salted.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= k).drop("_rn", "_salt")
    return some.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("fp"))).where(F.col("_rn") <= k).drop("_rn")


def merged_bottoms(states: DataFrame, keys: list[str], k: int = 64) -> DataFrame:
    """(keys, sketch) of the union over all partitions in ``states``."""
    return least(states.select(*keys, "fp").distinct(), keys, k).groupBy(*keys).agg(F.array_sort(F.collect_list("fp")).alias("sketch"))


def hitter_states(rows: DataFrame, keys: list[str], value: str, places: int = 256) -> DataFrame:
    """(keys, state, rows): a top-k state a group, of bounded size."""
    return rows.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate({value}, {places})").alias("state"), F.count(value).alias("rows"))


def merged_hitters(states: DataFrame, keys: list[str], k: int, places: int = 256) -> DataFrame:
    """(keys, rows, value, n, error): estimated counts of the ``k`` most frequent values of each group over all partitions in ``states``."""
    one = states.groupBy(*keys).agg(F.expr(f"approx_top_k_combine(state, {places})").alias("state"), F.sum("rows").alias("rows"))
    top = one.select(*keys, "rows", F.explode(F.expr(f"approx_top_k_estimate(state, {k})")).alias("_t"))
    return top.select(*keys, "rows", F.col("_t.item").alias("value"), F.col("_t.count").alias("n"), (F.col("rows") * ERROR / places).alias("error"))


def add_states(states: DataFrame, path: str, partition: str) -> None:
    """Store the states of new partitions beside those that are there."""
    states.write.mode("append").partitionBy(partition).parquet(path)


def stored_partitions(spark: SparkSession, path: str, partition: str) -> list[str]:
    """Partitions that have states, from the listing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(n.split("=", 1)[1] for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(f"{partition}="))


def refresh(facts: DataFrame, path: str, partition: str, build) -> list[str]:
    """Build and store the states (``build(rows)``) of those partitions of ``facts`` that have none yet; returns them.

    ``facts`` is read with a predicate on its partition column, so partitions with states are pruned. A partition is taken to be final.
    """
    spark = facts.sparkSession
    have = stored_partitions(spark, path, partition)
    new = facts.where(~F.col(partition).cast("string").isin(have)) if have else facts
    add_states(build(new), path, partition)
    return [x for x in stored_partitions(spark, path, partition) if x not in have]
