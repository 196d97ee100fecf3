"""The observation log as streams: weekly periods, last capture wins, duplicates, finality, staleness.

Every function takes a streaming (or batch) DataFrame with an event-time column and returns one; the caller starts the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONDAY = "4 days"  # the epoch is a Thursday


def weekly(df: DataFrame, time: str = "captured_at") -> DataFrame:
    """``week``: the Monday-based tumbling window of a row."""
    return df.withColumn("week", F.window(time, "7 days", "7 days", MONDAY))


def last_in_week(df: DataFrame, keys: list[str], value: str, time: str = "captured_at", late: str = "1 day", tie: str = "observation_id") -> DataFrame:
    """The last capture of each key and week; rows later than ``late`` behind the watermark are dropped."""
    src = df.withWatermark(time, late) if df.isStreaming else df
    got = src.groupBy(F.window(time, "7 days", "7 days", MONDAY).alias("week"), *keys).agg(F.max_by(value, F.struct(time, tie)).alias(value), F.max(time).alias(time), F.count("*").alias("captures"))
    return got.withColumn("week_start", F.col("week.start")).drop("week")


def once(df: DataFrame, keys: list[str], time: str = "captured_at", late: str = "1 day") -> DataFrame:
    """Each observation id once (within the watermark on a stream)."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def standing(df: DataFrame) -> DataFrame:
    """Batch view: the latest status of each original observation; a flip points at it through ``supersedes``."""
    target = F.coalesce("supersedes", "observation_id")
    got = df.groupBy(target.alias("observation_id")).agg(F.max_by("status", F.struct("captured_at", F.col("supersedes").isNotNull())).alias("status"), F.max_by("value", F.col("supersedes").isNull()).alias("value"))
    return got.where("status <> 'retracted'")


def final_partitions(df: DataFrame, time: str = "captured_at", late: str = "1 day") -> DataFrame:
    """Daily partitions with their counts; in append mode one appears only when the watermark has passed it, that is once it has a successor."""
    src = df.withWatermark(time, late) if df.isStreaming else df
    return src.groupBy(F.window(time, "1 day").alias("w")).agg(F.count("*").alias("rows"), F.approx_count_distinct("entity_id").alias("entities")).select(F.to_date("w.start").alias("day"), "rows", "entities")


def provisional(days: DataFrame) -> DataFrame:
    """Batch form: every day but the newest is final."""
    top = days.agg(F.max("day").alias("_t"))
    return days.join(F.broadcast(top)).withColumn("state", F.when(F.col("day") == F.col("_t"), "PROVISIONAL").otherwise("FINAL")).drop("_t")


def silent_sessions(df: DataFrame, keys: list[str], gap: str, time: str = "captured_at", late: str = "1 day") -> DataFrame:
    """Runs of activity that ended: a key silent for ``gap``."""
    src = df.withWatermark(time, late) if df.isStreaming else df
    return src.groupBy(F.session_window(time, gap).alias("s"), *keys).agg(F.count("*").alias("rows")).select(*keys, F.col("s.start").alias("from"), F.col("s.end").alias("silent_since"), "rows")


def visible_at(df: DataFrame, cutoff, time: str = "captured_at") -> DataFrame:
    """Rows that an older view may show: later captures never change it."""
    return df.where(F.col(time) <= F.to_timestamp(F.lit(cutoff)))
