"""Does an early signal lead a later outcome? 2x2 tables per cutoff, lag and cut, with a guard against looking ahead.

The signal of a cutoff is made of rows up to it, the outcome of the first period in which a cumulative clock of another kind
reaches a level. An entity that is there already at the cutoff is no case, and a lag that ends beyond the last period is
not evaluable. Counting multiplies entities by cutoffs only; the grid of lags and cuts is counted in columns and laid out
after aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def signals(activity: DataFrame, cutoffs: list[int], width: int) -> DataFrame:
    """(entity_id, cutoff, growth): sum of the ``width`` periods up to a cutoff less the sum of the ``width`` before. ``activity(entity_id, pos, value)``.

    An entity without any row up to a cutoff is no case of it.
    """
    near = activity.select("entity_id", "pos", "value", F.explode(F.array(*map(F.lit, cutoffs))).alias("cutoff")).where(F.col("pos") <= F.col("cutoff"))
    back = F.col("cutoff") - F.col("pos")
    part = F.when(back < width, F.col("value")).when(back < 2 * width, -F.col("value")).otherwise(0)
    return near.groupBy("entity_id", "cutoff").agg(F.sum(part).alias("growth"))


def reached(clock: DataFrame, level: float) -> DataFrame:
    """(entity_id, reached): the first period in which the running sum of ``clock(entity_id, pos, value)`` is at ``level``."""
    run = F.sum("value").over(Window.partitionBy("entity_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return clock.withColumn("_run", run).where(F.col("_run") >= level).groupBy("entity_id").agg(F.min("pos").alias("reached"))


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series from 16 on (error below 1e-13), from a table of fixed values below."""
    small, total = [0.0], 0.0
    import math

    for i in range(1, 16):
        total += math.log(i)
        small.append(total)
    x = F.greatest(n, F.lit(16)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    return F.when(n < 16, F.element_at(F.array(*map(F.lit, small)), (F.least(n, F.lit(15)) + 1).cast("int"))).otherwise(series)


def fisher_greater(a: Column, b: Column, c: Column, d: Column) -> Column:
    """One-sided exact p: the chance of ``a`` or more with these margins.

    Terms more than 40 standard deviations from the mean vanish in a double and are not summed, so the sum is as long as the
    root of the number of cases.
    """
    rows, columns, n = a + b, a + c, a + b + c + d
    some = F.greatest(n, F.lit(1))
    mean = rows * columns / some
    spread = F.sqrt(mean * (1 - rows / some) * (1 - columns / some) * n / F.greatest(n - 1, F.lit(1))) * 40 + 60
    lo = F.greatest(a, F.floor(mean - spread), F.lit(0))
    hi = F.least(rows, columns, F.greatest(F.ceil(mean + spread), a + 60))
    fixed = log_factorial(rows) + log_factorial(n - rows) + log_factorial(columns) + log_factorial(n - columns) - log_factorial(n)
    term = lambda x: F.exp(fixed - log_factorial(x) - log_factorial(rows - x) - log_factorial(columns - x) - log_factorial(n - rows - columns + x))
    return F.least(F.lit(1.0), F.aggregate(F.sequence(lo, hi), F.lit(0.0), lambda acc, x: acc + term(x)))


def lead_tables(signal: DataFrame, outcome: DataFrame, lags: list[int], cuts: list[float], last: int) -> DataFrame:
    """One row per cutoff, lag and cut: the four counts, base rate, precision, risk ratio, odds ratio and Fisher's p.

    ``signal(entity_id, cutoff, growth)``, ``outcome(entity_id, reached)``. Ratios with a zero below them are null.
    """
    cases = signal.join(outcome, "entity_id", "left").where(F.col("reached").isNull() | (F.col("reached") > F.col("cutoff")))
    grid = [(lag, cut) for lag in lags for cut in cuts]
    counts = []
    for i, (lag, cut) in enumerate(grid):
        fast, came = F.col("growth") >= cut, F.coalesce(F.col("reached") <= F.col("cutoff") + lag, F.lit(False))
        counts += [F.count_if(x).alias(f"{k}{i}") for k, x in zip("abcd", (fast & came, fast & ~came, ~fast & came, ~fast & ~came), strict=True)]
    one = cases.groupBy("cutoff").agg(*counts)
    cells = F.array(*(F.struct(F.lit(lag).alias("lag"), F.lit(float(cut)).alias("cut"), *(F.col(f"{k}{i}").alias(k) for k in "abcd")) for i, (lag, cut) in enumerate(grid)))
    rows = one.select("cutoff", F.inline(cells)).where(F.col("cutoff") + F.col("lag") <= last)
    a, b, c, d = (F.col(k) for k in "abcd")
    over = lambda x, y: x / F.nullif(y, F.lit(0))
    return rows.select(
        "cutoff", "lag", "cut", *"abcd", over(a + c, a + b + c + d).alias("base_rate"), over(a, a + b).alias("precision"), over(a * (c + d), c * (a + b)).alias("risk_ratio"),
        over(a * d, b * c).alias("odds_ratio"), fisher_greater(a, b, c, d).alias("p"),
    )
