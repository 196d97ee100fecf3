"""Weekly scoring: cohort z scores free of size, the two-axis gate, status, momentum, percentile, and cohort summaries."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import MAD_SCALE, clamp
from tidemark.operators.placement import ranked
from tidemark.operators.series import trailing, yearly_momentum
from tidemark.sources.scratch import stored


@dataclass(frozen=True)
class Methodology:
    """Thresholds of one version of the method."""

    version: str = "m1"
    rising_z: float = 1.0
    activity_floor: float = 5.0
    min_cohort: int = 5
    z_min: int = 3
    bound: float = 3.0


def cohort_z(rows: DataFrame, axes: list[tuple[str, str, str]], m: Methodology) -> DataFrame:
    """For each (slope, size, out): robust z of the slope within the cohort, then free of robust z of log size.

    Both use the rows that have a slope; a cohort with fewer than ``z_min`` of them gets null. All axes share three
    grouped passes over the cohorts, so the plan grows with neither axes nor rows per cohort.
    """
    x = rows.select("entity_id", "cohort", *(c for v, w, _ in axes for c in (F.col(v).alias(f"v_{v}"), F.when(F.col(v).isNotNull(), F.log1p(F.greatest(F.col(w).cast("double"), F.lit(0.0)))).alias(f"l_{v}"))))
    names = [v for v, _, _ in axes]
    each = lambda f: [c for v in names for c in f(v)]
    mid = x.groupBy("cohort").agg(*each(lambda v: (F.count(f"v_{v}").alias(f"n_{v}"), F.median(f"v_{v}").alias(f"mv_{v}"), F.median(f"l_{v}").alias(f"ml_{v}"))))
    x = x.join(mid, "cohort")
    dev = x.groupBy("cohort").agg(*each(lambda v: (F.median(F.abs(F.col(f"v_{v}") - F.col(f"mv_{v}"))).alias(f"dv_{v}"), F.median(F.abs(F.col(f"l_{v}") - F.col(f"ml_{v}"))).alias(f"dl_{v}"))))

    def z(value: str, centre: str, spread: str):
        scale = F.col(spread) * MAD_SCALE
        return clamp((F.col(value) - F.col(centre)) / F.when(scale == 0, F.lit(1e-9)).otherwise(scale), -m.bound, m.bound)

    x = x.join(dev, "cohort")
    keep = [f"n_{v}" for v in names]
    x = x.select("entity_id", "cohort", *keep, *each(lambda v: (F.when(F.col(f"v_{v}").isNotNull(), z(f"v_{v}", f"mv_{v}", f"dv_{v}")).alias(f"z_{v}"), F.when(F.col(f"v_{v}").isNotNull(), z(f"l_{v}", f"ml_{v}", f"dl_{v}")).alias(f"lz_{v}"))))
    fit = x.groupBy("cohort").agg(*each(lambda v: (F.covar_pop(f"lz_{v}", f"z_{v}").alias(f"c_{v}"), F.var_pop(f"lz_{v}").alias(f"vv_{v}"), F.avg(f"lz_{v}").alias(f"a_{v}"))))
    x = x.join(fit, "cohort")

    def free(v: str):
        var = F.when(F.col(f"vv_{v}") == 0, F.lit(1e-9)).otherwise(F.col(f"vv_{v}"))
        got = F.when(F.col(f"n_{v}") < 4, F.col(f"z_{v}")).otherwise(F.col(f"z_{v}") - F.col(f"c_{v}") / var * (F.col(f"lz_{v}") - F.col(f"a_{v}")))
        return F.when(F.col(f"n_{v}") >= m.z_min, F.bround(got, 3) + F.lit(0.0))

    return rows.join(x.select("entity_id", *(free(v).alias(out) for v, _, out in axes)), "entity_id", "left")


def scored_rows(registry: DataFrame, activity: DataFrame, yearly: DataFrame, last: int, current_year: int, m: Methodology) -> DataFrame:
    """One scored row per registry entity with activity.

    ``registry(entity_id, cohort, size, incumbent)``, ``activity(entity_id, pos, value)``, ``yearly(entity_id, year, n)``.
    """
    rows = registry.join(trailing(activity, last), "entity_id").join(yearly_momentum(yearly, current_year), "entity_id", "left")
    rows = rows.withColumn("axis2_status", F.coalesce("axis2_status", F.lit("absent"))).withColumn("axis2_total", F.coalesce("axis2_total", F.lit(0)))
    rows = stored(rows, "base")  # what the cohorts are compared by is read several times, the series once
    rows = cohort_z(rows, [("axis1_slope", "size", "axis1_z"), ("axis2_slope", "axis2_total", "axis2_z")], m)
    size = rows.groupBy("cohort").agg(F.count("*").alias("cohort_n"))
    return gate(rows.join(size, "cohort"), m)


def weekly_scores(registry: DataFrame, activity: DataFrame, yearly: DataFrame, last: int, current_year: int, m: Methodology) -> DataFrame:
    """:func:`scored_rows` with the percentile of each entity's momentum in its cohort."""
    return percentile(scored_rows(registry, activity, yearly, last, current_year, m))


def gate(rows: DataFrame, m: Methodology) -> DataFrame:
    """Axes present and rising, the badge, status, momentum and confidence."""
    has1, has2 = F.col("axis1_slope").isNotNull(), (F.col("axis2_status") == "present") & F.col("axis2_z").isNotNull()
    up1 = has1 & (F.col("axis1_slope") > 0) & (F.col("axis1_z") >= m.rising_z) & (F.col("recent") >= m.activity_floor)
    up2 = has2 & (F.col("axis2_slope") > 0) & (F.col("axis2_z") >= m.rising_z)
    one = lambda a, b: F.array_compact(F.array(F.when(a, "axis1"), F.when(b, "axis2")))
    rows = rows.withColumn("axes_present", one(has1, has2)).withColumn("convergent_axes", one(F.coalesce(up1, F.lit(False)), F.coalesce(up2, F.lit(False))))
    here, up = F.size("axes_present"), F.size("convergent_axes")
    rising = ~F.col("incumbent") & (F.col("cohort_n") >= m.min_cohort) & (here >= 2) & (up >= 2)
    status = F.when(F.col("incumbent"), "calibration").when(rising, "rising").when(up == 1, "watch").when(here >= 2, "tracked").otherwise("single-axis")
    given = F.when(F.col("axis1_z").isNotNull(), 1).otherwise(0) + F.when(F.col("axis2_z").isNotNull(), 1).otherwise(0)
    # decimals: scores have three places, so every 160th momentum is a tie, which a sum of doubles may miss
    exact = lambda z: F.coalesce(F.col(z).cast("decimal(18,3)"), F.lit(Decimal(0)))
    total = (exact("axis1_z") + exact("axis2_z")) * F.when(given == 2, F.lit(Decimal("6.25"))).otherwise(F.lit(Decimal("12.50")))
    momentum = F.when(given > 0, F.bround(clamp(F.lit(Decimal(50)) + total, Decimal(0), Decimal(100)), 1).cast("double"))
    confidence = F.when((here >= 2) & rising, "high").when(here >= 2, "medium").otherwise("low")
    return rows.withColumn("rising", rising).withColumn("status", status).withColumn("momentum", momentum).withColumn("confidence", confidence)


def percentile(rows: DataFrame, value: str = "momentum", tie: str = "entity_id") -> DataFrame:
    """Position in the cohort by ``value`` (ties in ``tie`` order) on 0..100; a lone row is 50, a null value null.

    The rows are stored in cohort order, so a cohort of any size is ranked by as many tasks as it fills.
    """
    placed = ranked(rows.withColumn("_none", F.col(value).isNull()), ["cohort", "_none"], [value, tie], "_i", "_n")
    got = F.when(F.col("_n") > 1, F.bround(100.0 * F.col("_i") / F.greatest(F.col("_n") - 1, F.lit(1)), 0)).otherwise(50.0)
    return placed.withColumn("percentile", F.when(~F.col("_none"), got).cast("long")).drop("_none", "_i", "_n")


STATUSES = ("rising", "watch", "tracked", "single-axis", "calibration")


def status_counts(rows: DataFrame, keys: list[str] | None = None, fold_single: bool = False) -> DataFrame:
    """One column per status, the entity count and the second axis' presence; ``fold_single`` counts single-axis as tracked."""
    status = F.when(F.col("status") == "single-axis", "tracked").otherwise(F.col("status")) if fold_single else F.col("status")
    names = [s for s in STATUSES if not (fold_single and s == "single-axis")]
    aggs = [F.count("*").alias("entities"), *(F.count_if(status == s).alias(s.replace("-", "_")) for s in names), F.count_if(F.col("axis2_status") == "present").alias("axis2_present")]
    return rows.groupBy(*(keys or [])).agg(*aggs)


def power_funnel(rows: DataFrame, m: Methodology) -> DataFrame:
    """How many entities pass each further condition: measured, two axes, sized cohort, one axis up, both up."""
    a = F.col("axis1_slope").isNotNull()
    b = a & (F.size("axes_present") >= 2)
    c = b & (F.col("cohort_n") >= m.min_cohort)
    d = c & (F.size("convergent_axes") >= 1)
    e = d & (F.size("convergent_axes") >= 2) & ~F.col("incumbent")
    return rows.agg(F.count_if(a).alias("measured"), F.count_if(b).alias("two_axes"), F.count_if(c).alias("sized"), F.count_if(d).alias("one_up"), F.count_if(e).alias("both_up"))


def sensitivity(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """Entities whose smaller z reaches each threshold; the grid is a literal array, exploded after partial counting."""
    least = F.least("axis1_z", "axis2_z")
    two = rows.where(F.size("axes_present") >= 2)
    aggs = [F.count_if(least >= t).alias(f"t{k}") for k, t in enumerate(thresholds)]
    one = two.agg(*aggs)
    return one.select(F.explode(F.arrays_zip(F.array(*map(F.lit, thresholds)).alias("threshold"), F.array(*(F.col(f"t{k}") for k in range(len(thresholds)))).alias("passing"))).alias("g")).select("g.threshold", "g.passing")


def two_axis_coverage(rows: DataFrame) -> DataFrame:
    n = F.count("*")
    return rows.groupBy("cohort").agg(n.alias("entities"), F.count_if(F.size("axes_present") >= 2).alias("two_axis"), (F.count_if(F.size("axes_present") >= 2) / n).alias("coverage"))


def cohort_summary(rows: DataFrame) -> DataFrame:
    """Median and largest momentum and share of all entities per cohort."""
    total = rows.agg(F.count("*").alias("_all"))
    got = rows.groupBy("cohort").agg(F.median("momentum").alias("median_momentum"), F.max("momentum").alias("max_momentum"), F.count("*").alias("entities"))
    return got.join(F.broadcast(total)).withColumn("share", F.col("entities") / F.expr("nullif(_all, 0)")).drop("_all")
