"""Point-in-time reads: what was visible at a cutoff, the newest record before it, and last-one-wins choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def visible(captured: Column | str, cutoff) -> Column:
    """True iff a capture moment (text or timestamp) is not after the cutoff; an unreadable moment is never visible."""
    c = F.col(captured) if isinstance(captured, str) else captured
    return F.coalesce(F.try_to_timestamp(c.cast("string")) <= F.to_timestamp(F.lit(cutoff)), F.lit(False))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by ``order`` (give a full tie-break)."""
    desc = [c.desc_nulls_last() for c in order]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*desc))).where("_rn = 1").drop("_rn")


def newest_not_after(rows: DataFrame, asof, date: str) -> DataFrame:
    """All rows of the newest ``date`` that is not after ``asof`` (one scalar, then a pruned read)."""
    top = rows.where(F.col(date) <= F.lit(asof)).agg(F.max(date).alias("_top"))
    return rows.join(F.broadcast(top), F.col(date) == F.col("_top")).drop("_top")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, carry: list[str]) -> DataFrame:
    """For every left row the newest right row of its key not after its time; no right row: nulls.

    Both sides are merged into one ordered stream per key and the last right record is carried forward, so a key's
    rows are sorted once and never paired with each other. Equal times match; of equal right times the greatest record wins.
    """
    kept = F.struct(F.col(right_time).alias(right_time), *carry)
    a = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.select(kept.alias("r")).schema["r"].dataType).alias("_r"))
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("l")).schema["l"].dataType).alias("_l"), kept.alias("_r"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    got = a.unionByName(b).withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    return got.select("_l.*", *(F.col(f"_m.{c}").alias(c) for c in [right_time, *carry]))


def primary_or_fallback(primary: DataFrame, fallback: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The primary record of a key if it has one, else the latest fallback."""
    both = primary.withColumn("_p", F.lit(1)).unionByName(fallback.withColumn("_p", F.lit(0)))
    return latest(both, [key], [F.col("_p"), *order]).withColumn("source", F.when(F.col("_p") == 1, "primary").otherwise("fallback")).drop("_p")


def universe(rows: DataFrame, key: str, date: str, record: str) -> DataFrame:
    """First and last date of each entity, its latest record, and whether it is in the newest snapshot."""
    newest = rows.agg(F.max(date).alias("_n"))
    got = rows.groupBy(key).agg(F.min(date).alias("first_seen"), F.max(date).alias("last_seen"), F.max_by(record, date).alias("latest"))
    return got.join(F.broadcast(newest)).withColumn("state", F.when(F.col("last_seen") == F.col("_n"), "current").otherwise("superseded")).drop("_n")


def distinct_periods(history: DataFrame, key: str = "entity_id", period: str = "period") -> DataFrame:
    """Distinct periods per entity and how many are repeated (an error to report)."""
    n = history.groupBy(key, period).agg(F.count("*").alias("_n"))
    return n.groupBy(key).agg(F.count("*").alias("periods"), F.count_if(F.col("_n") > 1).alias("duplicates"))
