"""Robust statistics as grouped aggregates joined back to the rows, so a large group is never one task's window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAD_SCALE = 1.4826


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def upper_median(c: str) -> Column:
    """The upper of the two middle values (the middle one for odd counts)."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c} DESC)")


def clamp(c: Column, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def _centre(df: DataFrame, keys: list[str], value: str, middle) -> DataFrame:
    """(keys, med, mad) per group, nulls of ``value`` left out."""
    some = df.where(F.col(value).isNotNull())
    med = some.groupBy(*keys).agg(middle(value).alias("_med"))
    dev = some.join(med, keys).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    return med.join(dev.groupBy(*keys).agg(middle("_dev").alias("_mad")), keys)


def robust_z(df: DataFrame, keys: list[str], value: str, out: str, *, floor: float | None = 1e-9, upper: bool = False, bound: float = 3.0) -> DataFrame:
    """Median/MAD z clamped to ``bound``. A zero MAD divides by ``floor``, or gives 0 where ``floor`` is None.

    ``upper`` takes the upper median instead of the mean of the middle two.
    """
    stats = _centre(df, keys, value, upper_median if upper else F.median)
    scale = F.col("_mad") * MAD_SCALE
    z = (F.col(value) - F.col("_med")) / F.when(scale == 0, F.lit(floor)).otherwise(scale)
    if floor is None:
        z = F.when(F.col(value).isNotNull(), F.coalesce(z, F.lit(0.0)))
    return df.join(stats, keys, "left").withColumn(out, clamp(z, -bound, bound)).drop("_med", "_mad")


def residualize(df: DataFrame, keys: list[str], z: str, size: str, out: str, *, least: int = 4, bound: float | None = None) -> DataFrame:
    """``z`` minus its within-group regression on ``size``; groups under ``least`` rows keep ``z``. Zero variance: no slope."""
    some = df.where(F.col(z).isNotNull())
    stats = some.groupBy(*keys).agg(F.count("*").alias("_n"), F.avg(size).alias("_ms"), F.covar_pop(size, z).alias("_cov"), F.var_pop(size).alias("_var"))
    fit = F.col(z) - F.col("_cov") / F.when(F.col("_var") == 0, F.lit(1e-9)).otherwise(F.col("_var")) * (F.col(size) - F.col("_ms"))
    got = F.when(F.col("_n") < least, F.col(z)).otherwise(fit)
    if bound is not None:
        got = clamp(got, -bound, bound)
    return df.join(stats, keys, "left").withColumn(out, F.when(F.col(z).isNotNull(), got)).drop("_n", "_ms", "_cov", "_var")
