"""Trend fits and second-order signals over long series (entity_id, pos, value); ``pos`` is the place in the series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def log1p(c: str) -> Column:
    return F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0)))


def log_slope(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "value", out: str = "slope") -> DataFrame:
    """Least-squares slope of log1p(max(0, value)) on ``pos``; under three points null, no spread 0."""
    fit = F.coalesce(F.regr_slope(log1p(value), F.col(pos).cast("double")), F.lit(0.0))
    return df.groupBy(*keys).agg(F.when(F.count("*") >= 3, fit).alias(out))


def plain_slope(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "value", out: str = "slope") -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.regr_slope(F.col(value).cast("double"), F.col(pos).cast("double")), F.lit(0.0)).alias(out))


def dated_slope(df: DataFrame, keys: list[str], date: str, value: str, out: str = "slope") -> DataFrame:
    """Slope of log1p(value) on real day offsets; under two points or no spread 0."""
    days = F.datediff(F.col(date), F.lit("1970-01-01")).cast("double")
    return df.groupBy(*keys).agg(F.coalesce(F.regr_slope(log1p(value), days), F.lit(0.0)).alias(out))


def trailing(df: DataFrame, last: int, fit: int = 26, recent: int = 12) -> DataFrame:
    """(entity_id, slope of the last ``fit`` places, sum of the last ``recent`` over ``recent`` whatever the length)."""
    cut = df.where((F.col("pos") <= last) & (F.col("pos") > last - fit))
    y = F.coalesce(F.regr_slope(log1p("value"), F.col("pos").cast("double")), F.lit(0.0))
    near = F.sum(F.when(F.col("pos") > last - recent, F.col("value")).otherwise(0))
    return cut.groupBy("entity_id").agg(F.when(F.count("*") >= 3, y).alias("axis1_slope"), F.bround(near / F.lit(float(recent)), 1).alias("recent"))


def yearly_momentum(yearly: DataFrame, current_year: int) -> DataFrame:
    """(entity_id, axis2_status, axis2_slope, axis2_total) from (entity_id, year, n).

    The total counts every year; the fit leaves out the current one, and the first where four or more are complete.
    """
    complete = F.col("year") < current_year
    w = Window.partitionBy("entity_id")
    rows = yearly.withColumn("_c", F.count(F.when(complete, 1)).over(w)).withColumn(
        "_i", F.row_number().over(w.orderBy("year")) - 1
    )
    skip = F.when(F.col("_c") >= 4, 1).otherwise(0)
    used = complete & (F.col("_i") >= skip)
    slope = F.coalesce(F.regr_slope(F.when(used, log1p("n")), F.when(used, F.col("_i").cast("double"))), F.lit(0.0))
    enough = F.max("_c") >= 3
    return rows.groupBy("entity_id").agg(
        F.when(enough, "present").otherwise("insufficient").alias("axis2_status"),
        F.when(enough, slope).alias("axis2_slope"),
        F.sum("n").alias("axis2_total"),
    )


def recency_swing(df: DataFrame, recent: int = 13, prior: int = 39) -> DataFrame:
    """Slope of the last ``recent`` places against the up to ``prior`` before them, with a label or a reason to withhold."""
    w = Window.partitionBy("entity_id").orderBy(F.desc("pos"))
    rows = df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= recent + prior)
    near, far = F.col("_k") <= recent, F.col("_k") > recent
    x = F.col("pos").cast("double")
    got = rows.groupBy("entity_id").agg(
        F.count("*").alias("n"),
        F.count_if(far).alias("prior_window"),
        F.coalesce(F.regr_slope(F.when(near, log1p("value")), F.when(near, x)), F.lit(0.0)).alias("rs"),
        F.coalesce(F.regr_slope(F.when(far, log1p("value")), F.when(far, x)), F.lit(0.0)).alias("ps"),
    )
    tiny = 1e-6
    flat = F.abs("ps") < tiny
    value = F.col("rs") / F.when(flat, tiny * F.when(F.col("ps") < 0, -1).otherwise(1)).otherwise(F.col("ps"))
    label = (
        F.when(flat & (F.col("rs") > tiny), "accelerating from a flat base").when(flat & (F.col("rs") < -tiny), "recent slope negative on a flat base").when(flat, "flat")
        .when(F.round("v", 9) > 1.15, "accelerating").when(F.round("v", 9) < 0, "recent slope sign differs from prior window")
        .when(F.round("v", 9) < 0.85, "recent slope below prior window").otherwise("steady")
    )
    short = F.when(F.col("n") < recent + 1, "too short for a recent window").when(F.col("prior_window") < 2, "too short for a prior window")
    got = got.withColumn("v", value).withColumn("reason", short)
    ok = F.col("reason").isNull()
    return got.select("entity_id", F.when(ok, F.col("v")).alias("swing"), "prior_window", F.when(ok, label).alias("label"), "reason")


def slope_to_noise(df: DataFrame, least: int = 26) -> DataFrame:
    """Log-linear slope over residual deviation with a 95 % band widened for lag-1 autocorrelation."""
    y, x = log1p("value"), F.col("pos").cast("double")
    fit = df.groupBy("entity_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 0).alias("nz"), F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("b"),
        F.avg(y).alias("my"), F.avg(x).alias("mx"), F.var_pop(x).alias("vx"),
    )
    res = df.join(fit, "entity_id").withColumn("e", y - F.col("my") - F.col("b") * (x - F.col("mx")))
    res = res.withColumn("before", F.lag("e").over(Window.partitionBy("entity_id").orderBy("pos")))
    sums = res.groupBy("entity_id").agg(F.sum(F.col("e") * F.col("e")).alias("ss"), F.sum(F.col("e") * F.col("before")).alias("se"))
    dof = F.greatest(F.lit(1), F.col("n") - 2)
    both = fit.join(sums, "entity_id").withColumn("dof", dof).withColumn("sd", F.sqrt(F.col("ss") / F.col("dof")))
    rho = F.when(F.col("ss") == 0, 0.0).otherwise(F.coalesce(F.col("se"), F.lit(0.0)) / F.col("ss"))
    room = F.when(1 - F.col("rho") == 0, 1e-6).otherwise(1 - F.col("rho"))
    both = both.withColumn("rho", rho).withColumn("wide", F.sqrt(F.greatest(F.lit(1.0), (1 + F.col("rho")) / room)))
    value = F.col("b") / F.col("sd")
    half = 1.96 * F.col("wide") / F.sqrt(F.col("vx") * F.col("n"))
    reason = F.when(F.col("nz") < least, "too few non-zero places").when(F.col("sd") < 1e-12, "no residual variance")
    both = both.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    return both.select("entity_id", F.when(ok, value).alias("ratio"), F.when(ok, value - half).alias("low"), F.when(ok, value + half).alias("high"), F.col("dof").cast("long").alias("dof"), "reason")


def changepoint(df: DataFrame, edge: int = 3, least: int = 8) -> DataFrame:
    """The split with the largest change of slope, from running sums over prefix and suffix; kept if above twice its standard error.

    Ties go to the earliest split; under ``least`` places the answer is withheld.
    """
    x, y = F.col("i"), F.col("value").cast("double")
    w = Window.partitionBy("entity_id").orderBy("pos")
    rows = df.withColumn("i", (F.row_number().over(w) - 1).cast("double"))
    left = w.rowsBetween(Window.unboundedPreceding, -1)
    right = w.rowsBetween(0, Window.unboundedFollowing)

    def sums(win, tag):
        return [F.count("*").over(win).cast("double").alias(f"n{tag}"), *(F.sum(e).over(win).alias(f"{k}{tag}") for k, e in (("x", x), ("y", y), ("xy", x * y), ("xx", x * x), ("yy", y * y)))]

    at = rows.select("entity_id", F.col("i").cast("long").alias("k"), *sums(left, "l"), *sums(right, "r"))
    for t in "lr":
        n = F.col(f"n{t}")
        at = at.withColumn(f"sxx{t}", F.col(f"xx{t}") - F.col(f"x{t}") * F.col(f"x{t}") / n)
        at = at.withColumn(f"sxy{t}", F.col(f"xy{t}") - F.col(f"x{t}") * F.col(f"y{t}") / n)
        at = at.withColumn(f"b{t}", F.when(F.col(f"sxx{t}") == 0, 0.0).otherwise(F.col(f"sxy{t}") / F.col(f"sxx{t}")))
        sse = F.greatest(F.lit(0.0), F.col(f"yy{t}") - F.col(f"y{t}") * F.col(f"y{t}") / n - F.col(f"b{t}") * F.col(f"sxy{t}"))
        at = at.withColumn(f"se{t}", F.sqrt(sse / F.greatest(F.lit(1.0), n - 2)) / F.sqrt(F.when(F.col(f"sxx{t}") == 0, 1.0).otherwise(F.col(f"sxx{t}"))))
    at = at.withColumn("delta", F.round(F.col("br") - F.col("bl"), 9)).withColumn("se", F.sqrt(F.col("sel") ** 2 + F.col("ser") ** 2))
    n = F.col("nl") + F.col("nr")
    ok = (F.col("k") >= edge) & (F.col("k") <= n - edge)
    best = at.groupBy("entity_id").agg(
        F.max(n).cast("long").alias("n"), F.max(F.when(ok, F.struct(F.abs("delta").alias("a"), (-F.col("k")).alias("k"), "delta", "se"))).alias("m")
    )
    seen = (F.col("n") >= least) & (F.abs("m.delta") > 2 * F.col("m.se"))
    state = F.when(F.col("n") < least, "reserved").when(seen, "changepoint").otherwise("none")
    return best.select("entity_id", state.alias("state"), F.when(seen, -F.col("m.k")).alias("split"), F.when(seen, F.col("m.delta")).alias("delta"))


def intensity(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Each value over its series' maximum (0 where that is 0), as ``intensity``."""
    top = df.groupBy(*keys).agg(F.max(value).alias("_top"))
    return df.join(top, keys).withColumn("intensity", F.coalesce(F.col(value) / F.expr("nullif(_top, 0)"), F.lit(0.0))).drop("_top")


#: Signals that are named but never computed from present data, with the reason shown instead.
RESERVED = {"lag": "needs two aligned axes over many periods", "alpha": "needs a market reference", "gate_eta": "a forecast, not a measurement"}


def signal_inventory(swing: DataFrame, noise: DataFrame, change: DataFrame) -> DataFrame:
    """Per entity the names of signals given and of those withheld."""
    got = swing.select("entity_id", F.col("reason").isNull().alias("s")).join(noise.select("entity_id", F.col("reason").isNull().alias("n")), "entity_id").join(
        change.select("entity_id", (F.col("state") != "reserved").alias("c")), "entity_id"
    )
    named = [("swing", F.col("s")), ("slope_to_noise", F.col("n")), ("changepoint", F.col("c"))]
    fixed = [F.lit(k) for k in sorted(RESERVED)]
    return got.select(
        "entity_id", F.array_compact(F.array(*(F.when(c, k) for k, c in named))).alias("shipped"),
        F.concat(F.array_compact(F.array(*(F.when(~c, k) for k, c in named))), F.array(*fixed)).alias("reserved"),
    )
