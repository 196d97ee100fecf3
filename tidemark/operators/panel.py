"""Panels (series, entity, snap, value): corrupt-partition detection, votes with stability vetoes, promotion criteria.

Absent rows stay absent: nothing here fills a panel.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import slopes
from tidemark.functions.stats import residualize, robust_z

FLOOR, Z_FLOOR, MIN_POINTS, CANARY_FLOOR = 5, 1.0, 14, 0.8


def with_index(panel: DataFrame) -> DataFrame:
    """``idx``: the place of a snap in its series' global order (not in the entity's own)."""
    snaps = panel.select("series", "snap").distinct()
    return panel.join(snaps.withColumn("idx", F.row_number().over(Window.partitionBy("series").orderBy("snap"))), ["series", "snap"])


def _moves(panel: DataFrame, steps: tuple[int, ...]) -> DataFrame:
    """Rows with ``prev`` (value one place earlier) and ``next<k>``; missing places give null."""
    x = with_index(panel).select("series", "entity", "snap", "idx", F.col("value").cast("double").alias("value"))
    out = x
    for k in steps:
        other = x.select("series", "entity", (F.col("idx") - k).alias("idx"), F.col("value").alias("prev" if k == -1 else f"next{k}"))
        out = out.join(other, ["series", "entity", "idx"], "left")
    return out


def reversal_share(panel: DataFrame, bound: float) -> DataFrame:
    """Per (series, snap): eligible entities and the share that moved beyond ``bound`` and came back within half of it
    at either of the next two snaps."""
    ratio = lambda c: F.abs(F.log((F.col(c) + 1) / (F.col("prev") + 1)))
    m = _moves(panel, (-1, 1, 2)).where((F.col("prev") >= FLOOR) & (F.col("next1").isNotNull() | F.col("next2").isNotNull()))
    back = F.least(ratio("next1"), ratio("next2"))
    m = m.withColumn("rev", (ratio("value") > bound) & (back < bound / 2))
    return m.groupBy("series", "snap", "idx").agg(F.count("*").alias("eligible"), F.avg(F.col("rev").cast("double")).alias("share"))


def clean_moves(panel: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Per (series, snap): the largest log move from the place before and, with 10 entities or more, the share beyond ln 2.

    Transitions that touch an ``exclude(snap)`` are left out.
    """
    m = _moves(panel, (-1,)).where(F.col("prev") >= FLOOR)
    if exclude is not None:
        bad = with_index(panel).select("series", "snap", "idx").distinct().join(exclude, "snap", "left_semi")
        near = bad.select("series", F.explode(F.array("idx", F.col("idx") + 1)).alias("idx")).distinct()
        m = m.join(near, ["series", "idx"], "left_anti")
    move = F.abs(F.log((F.col("value") + 1) / (F.col("prev") + 1)))
    got = m.groupBy("series", "snap").agg(F.count("*").alias("n"), F.max(move).alias("max_move"), F.avg((move > math.log(2)).cast("double")).alias("_s"))
    return got.select("series", "snap", "n", "max_move", F.when(F.col("n") >= 10, F.col("_s")).alias("big_share"))


def coverage_deviation(panel: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Per series: upper median of entities per snap and the largest relative deviation from it, without ``exclude(snap)``."""
    n = panel.groupBy("series", "snap").agg(F.countDistinct("entity").alias("n"))
    if exclude is not None:
        n = n.join(exclude, "snap", "left_anti")
    med = n.groupBy("series").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC)").alias("median_n"))
    return n.join(med, "series").groupBy("series", "median_n").agg(F.max(F.abs(F.col("n") - F.col("median_n")) / F.col("median_n")).alias("max_deviation"))


def calibrate(panel: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Bounds from clean history (``exclude(snap)`` is left out of all of them): move bound, panel share bound, least coverage."""
    a = clean_moves(panel, exclude).groupBy("series").agg(F.max("max_move").alias("m"), F.max("big_share").alias("s"))
    return a.join(coverage_deviation(panel, exclude), "series").select(
        "series", F.greatest("m", F.lit(math.log(2))).alias("move_bound"), F.greatest(3 * F.coalesce("s", F.lit(0.0)), F.lit(0.10)).alias("share_bound"),
        F.least(F.lit(0.90), 1 - 3 * F.col("max_deviation")).alias("least_coverage"),
    )


ELIGIBLE = 10  # fewer entities than this accuse no snap


def firings(controls: DataFrame, move_bound: float, share_bound: float) -> DataFrame:
    """Negative control: snaps of other series at which the derived rule fires; a rule that fires there is wrong."""
    got = reversal_share(controls, move_bound).where((F.col("eligible") >= ELIGIBLE) & (F.col("share") > share_bound))
    return got.select("series", "snap", "eligible", "share")


def verdicts(panel: DataFrame, move_bound: float, share_bound: float, least_coverage: float, exclude: DataFrame | None = None, floor: int = 0) -> DataFrame:
    """Each snap's state. The first snap and the last have no shape: CLEAN and PROVISIONAL.

    A coverage under ``least_coverage`` of the median (of snaps outside ``exclude``), or under ``floor``, outranks both and CLEAN,
    not SUSPECT_CORRUPT.
    """
    n = with_index(panel).groupBy("series", "snap", "idx").agg(F.countDistinct("entity").alias("n"))
    med = (n.join(exclude, "snap", "left_anti") if exclude is not None else n).groupBy("series").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC)").alias("median_n"))
    ends = n.groupBy("series").agg(F.max("idx").alias("last"))
    rev = reversal_share(panel, move_bound).select("series", "snap", "share", "eligible")
    x = n.join(ends, "series").join(med, "series", "left").join(rev, ["series", "snap"], "left")
    bad = (F.col("eligible") >= ELIGIBLE) & (F.col("share") > share_bound) & (F.col("idx") < F.col("last"))
    thin = F.coalesce(F.col("n") < least_coverage * F.col("median_n"), F.lit(False)) | (F.col("n") < floor)
    state = F.when(bad, "SUSPECT_CORRUPT").when(thin, "INVALID_COVERAGE").when((F.col("idx") == F.col("last")) & (F.col("last") > 1), "PROVISIONAL").otherwise("CLEAN")
    return x.select("series", "snap", F.col("n").alias("coverage"), "eligible", "share", state.alias("status"))


def theil_sen(points: DataFrame, keys: list[str], pos: str = "i", value: str = "y", out: str = "theil_sen") -> DataFrame:
    """Median of all pairwise slopes of each series of two points or more (distinct positions), from one array a series."""
    series = points.where(F.col(pos).isNotNull() & F.col(value).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).cast("double").alias("x"), F.col(value).cast("double").alias("y")))).alias("_p"))

    @F.pandas_udf("double")
    def slope(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([slopes.median_slope(x, y) for x, y in zip(xs, ys, strict=True)], dtype="float64")

    return series.where(F.size("_p") > 1).select(*keys, slope(F.col("_p.x"), F.col("_p.y")).alias(out))


def leave_one_out_flips(points: DataFrame, keys: list[str], pos: str = "i", value: str = "y") -> DataFrame:
    """Does dropping any one point change whether the slope is positive? The rest is counted anew from 0.

    From sums: without point k, later places move down by one, so Σx and Σxy lose what the suffix sums say.
    """
    w = Window.partitionBy(*keys)
    after = w.orderBy(F.desc(pos)).rowsBetween(Window.unboundedPreceding, -1)
    x, y = F.col(pos).cast("double"), F.col(value)
    p = points.select(
        *keys, x.alias("x"), y.alias("y"), F.count("*").over(w).cast("double").alias("n"), F.sum(y).over(w).alias("sy"), F.sum(x * y).over(w).alias("sxy"),
        F.coalesce(F.sum(y).over(after), F.lit(0.0)).alias("tail"),
    )
    full = F.col("sxy") - (F.col("n") - 1) / 2 * F.col("sy")
    m = F.col("n") - 1
    sy, sxy = F.col("sy") - F.col("y"), F.col("sxy") - F.col("x") * F.col("y") - F.col("tail")
    part = sxy - (m - 1) / 2 * sy
    tiny = 1e-9
    flip = (m >= 2) & ((part > tiny) != (full > tiny))
    return p.groupBy(*keys).agg(F.bool_or(flip).alias("flips"))


def votes(panel: DataFrame, cohorts: DataFrame, clean: DataFrame | None = None, keys: list[str] | None = None, min_points: int = MIN_POINTS, veto: bool = True) -> DataFrame:
    """Votes on confirmed-clean snaps only: slope of log1p, residual-first robust z in the cohort, one-way fragility veto.

    ``panel([*keys], entity, snap, value)``; ``keys`` (say a cutoff) evaluates many panels at once.
    """
    keys = keys or []
    rows = panel if clean is None else panel.join(clean, "snap", "left_semi")
    by = [*keys, "entity"]
    w = Window.partitionBy(*by).orderBy("snap")
    pts = rows.select(*by, "snap", "value", (F.row_number().over(w) - 1).cast("double").alias("i"), F.log1p(F.col("value").cast("double")).alias("y"))
    ends = pts.groupBy(*by).agg(F.count("*").alias("points"), F.max_by("value", "snap").alias("latest"), F.min_by("value", "snap").alias("first"), F.coalesce(F.regr_slope("y", "i"), F.lit(0.0)).alias("slope"))
    ok = ends.where((F.col("points") >= min_points) & (F.col("latest") >= FLOOR)).join(cohorts, "entity", "left").withColumn("cohort", F.coalesce("cohort", F.lit("unknown")))
    z = ok.withColumn("_size", F.log1p(F.col("latest").cast("double")))
    z = robust_z(residualize(z, [*keys, "cohort"], "slope", "_size", "_res", least=2), [*keys, "cohort"], "_res", "z", floor=None, upper=True)
    lone = z.groupBy(*keys, "cohort").agg(F.count("*").alias("_m"))
    z = z.join(lone, [*keys, "cohort"]).withColumn("z", F.when(F.col("_m") < 2, 0.0).otherwise(F.col("z")))
    base = (F.col("slope") > 0) & (F.col("z") >= Z_FLOOR)
    if veto:
        some = pts.join(ok.select(*by), by, "left_semi")
        z = z.join(theil_sen(some, by), by, "left").join(leave_one_out_flips(some, by), by, "left")
        unstable = F.coalesce(((F.col("slope") > 0) != (F.col("theil_sen") > 0)) & ~((F.col("slope") == 0) & (F.col("theil_sen") == 0)), F.lit(False)) | F.coalesce("flips", F.lit(False))
        z = z.withColumn("unstable", unstable)
    else:
        z = z.withColumn("theil_sen", F.lit(None).cast("double")).withColumn("unstable", F.lit(False))
    return z.select(*by, "cohort", "points", "latest", "slope", "theil_sen", "z", (F.col("latest") > F.col("first")).alias("endpoint_up"), "unstable", (base & ~F.col("unstable")).alias("rising"))


def verdict_canary(v: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per cohort: how often the slope's sign agrees with the endpoints' direction; held when 3 or more agree too rarely."""
    agree = ((F.round("slope", 6) > 0) == F.col("endpoint_up")).cast("double")
    got = v.groupBy(*(keys or []), "cohort").agg(F.count("*").alias("n"), F.avg(agree).alias("agreement"))
    return got.withColumn("hold", (F.col("n") >= 3) & (F.col("agreement") < CANARY_FLOOR))


def at_cutoffs(panel: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Each row once for every cutoff not before its snap, so one aggregation evaluates all prefixes."""
    return panel.join(F.broadcast(cutoffs), panel["snap"] <= cutoffs["cutoff"])


def flip_and_churn(v: DataFrame, least: int = 5) -> DataFrame:
    """Between consecutive cutoffs: changed votes and changed membership over the union of the eligible; under ``least`` UNEVALUABLE."""
    cuts = v.select("cutoff").distinct()
    step = cuts.withColumn("prev", F.lag("cutoff").over(Window.orderBy("cutoff"))).where("prev IS NOT NULL")
    now = v.join(F.broadcast(step), "cutoff").select("prev", "cutoff", "entity", F.col("rising").alias("now"))
    before = v.select(F.col("cutoff").alias("prev"), "entity", F.col("rising").alias("was")).join(F.broadcast(step), "prev").select("prev", "cutoff", "entity", "was")
    both = now.join(before, ["prev", "cutoff", "entity"], "full_outer")
    flip = F.coalesce("now", F.lit(False)) != F.coalesce("was", F.lit(False))
    gone = F.col("now").isNull() | F.col("was").isNull()
    got = both.groupBy("prev", "cutoff").agg(F.count("*").alias("n"), F.avg(flip.cast("double")).alias("flip"), F.avg(gone.cast("double")).alias("churn"))
    return got.withColumn("state", F.when(F.col("n") < least, "UNEVALUABLE").otherwise("EVALUATED"))


def pooled_correlation(rows: DataFrame, a: str, b: str, least: int = 5) -> DataFrame:
    """Pearson correlation of within-cohort deviations, over cohorts with ``least`` pairs or more."""
    some = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    mean = some.groupBy("cohort").agg(F.count("*").alias("_n"), F.avg(a).alias("_a"), F.avg(b).alias("_b")).where(F.col("_n") >= least)
    dev = some.join(mean, "cohort").select((F.col(a) - F.col("_a")).alias("x"), (F.col(b) - F.col("_b")).alias("y"))
    return dev.agg(F.count("*").alias("n"), F.corr("x", "y").alias("corr")).select("n", F.when(F.col("n") >= least, F.col("corr")).alias("corr"))


#: fixed values: the promotion criteria
CRITERIA = {"coverage_min": 30, "independence_max_abs_r": 0.5, "flip_max": 0.30, "rising_share_lo": 0.0, "rising_share_hi": 0.40}


def promotion(v: DataFrame, axes: DataFrame, correlation: DataFrame, flips: DataFrame, states: DataFrame | None = None, criteria: dict = CRITERIA) -> DataFrame:
    """One row of criteria at the newest cutoff of ``v(cutoff, entity, cohort, rising, slope, endpoint_up)``.

    ``axes(entity, axes_present)``: c1 counts voting entities with another axis. ``correlation(n, corr)``: c2 needs one.
    ``flips``: c3 holds if some transition is evaluated and all evaluated ones flip less than the bound. c4: the panel's rising
    share lies inside the band over two cohorts or more, and no cohort is held by the canary. c5 and c6 hold by construction:
    votes are cast on the least number of clean points and on rows not after their cutoff. ``states(snap, status)``: snaps
    without a verdict (status null) make the whole an ERROR; no clean one makes it NOT_EVALUABLE. A held cohort makes it HOLD.
    """
    newest = v.agg(F.max("cutoff").alias("cutoff"))
    last = v.join(F.broadcast(newest), "cutoff", "left_semi")
    held = verdict_canary(last).agg(F.count_if("hold").alias("held_cohorts"))
    capable = last.join(axes.where("axes_present >= 1").select("entity"), "entity", "left_semi").agg(F.count("*").alias("gate_capable"))
    c = last.agg(F.count("*").alias("voting"), F.count_if("rising").alias("rising"), F.countDistinct(F.when(F.col("rising"), F.col("cohort"))).alias("rising_cohorts"))
    f = flips.agg(F.count_if(F.col("state") == "EVALUATED").alias("evaluated"), F.max(F.when(F.col("state") == "EVALUATED", F.col("flip"))).alias("max_flip"))
    one = c.join(F.broadcast(held)).join(F.broadcast(capable)).join(F.broadcast(correlation.select("corr"))).join(F.broadcast(f))
    if states is not None:
        one = one.join(F.broadcast(states.agg(F.count_if(F.col("status").isNull()).alias("unknown"), F.count_if(F.col("status") == "CLEAN").alias("clean"))))
    else:
        one = one.withColumn("unknown", F.lit(0)).withColumn("clean", F.lit(1))
    share = F.coalesce(F.col("rising") / F.expr("nullif(voting, 0)"), F.lit(0.0))
    c1 = F.col("gate_capable") >= criteria["coverage_min"]
    c2 = F.coalesce(F.abs("corr") < criteria["independence_max_abs_r"], F.lit(False))
    c3 = (F.col("evaluated") > 0) & F.coalesce(F.col("max_flip") < criteria["flip_max"], F.lit(False))
    c4 = (F.col("voting") > 0) & (F.col("held_cohorts") == 0) & (share > criteria["rising_share_lo"]) & (share < criteria["rising_share_hi"]) & (F.col("rising_cohorts") >= 2)
    state = F.when(F.col("unknown") > 0, "ERROR").when(F.col("clean") == 0, "NOT_EVALUABLE").when(F.col("held_cohorts") > 0, "HOLD").otherwise("EVALUATED")
    yes = F.lit(True)
    return one.select(
        "voting", "rising", "rising_cohorts", "held_cohorts", "gate_capable", share.alias("share"), c1.alias("c1_coverage"), c2.alias("c2_independence"), c3.alias("c3_flip"), c4.alias("c4_nondegeneracy"),
        yes.alias("c5_floors"), yes.alias("c6_no_lookahead"), state.alias("status"),
    )


def cohort_shares(v: DataFrame) -> DataFrame:
    """The older form of c4, for diagnosis: each cohort's rising share, and whether a share inside the open band is attainable at all."""
    return v.groupBy("cohort").agg(F.count("*").alias("n"), F.avg(F.col("rising").cast("double")).alias("share")).withColumn("attainable", F.col("n") >= 3)


def shadow_report(points: DataFrame, entities: DataFrame, least: int = MIN_POINTS, floor: int = FLOOR, sized: int = 5) -> DataFrame:
    """One row: what a third axis would do. ``points(entity, day, value)``, ``entities(entity, cohort, axes_present)``.

    An entity with ``least`` points votes: slope over real days, robust z in its cohort (``sized`` voters at least), freed of size.
    """
    from tidemark.operators.series import dated_slope

    own = points.join(entities.select("entity", "cohort"), "entity")
    n = own.groupBy("entity", "cohort").agg(F.count("*").alias("points"), F.max_by("value", "day").alias("latest"))
    slopes = dated_slope(own, ["entity"], "day", "value").withColumnRenamed("slope", "_slope")
    rows = n.join(slopes, "entity").withColumn("slope", F.when(F.col("points") >= least, F.col("_slope"))).drop("_slope")
    voting = rows.where("slope IS NOT NULL").withColumn("_size", F.log1p(F.col("latest").cast("double")))
    large = voting.groupBy("cohort").agg(F.count("*").alias("_n")).where(F.col("_n") >= sized).select("cohort")
    z = robust_z(voting.join(large, "cohort", "left_semi"), ["cohort"], "slope", "_z", floor=None, upper=True)
    z = residualize(z, ["cohort"], "_z", "_size", "z", least=3, bound=3.0)
    votes_ = z.agg(F.count_if((F.col("slope") > 0) & (F.col("z") >= Z_FLOOR) & (F.col("latest") >= floor)).alias("rising_votes"))
    third = entities.join(rows.select("entity", F.col("slope").isNotNull().alias("_third")), "entity", "left")
    axes = third.agg(F.count_if(F.col("axes_present") >= 2).alias("two_axes_now"), F.count_if(F.col("axes_present") + F.coalesce(F.col("_third").cast("int"), F.lit(0)) >= 2).alias("two_axes_projected"))
    cover = rows.agg(F.count("*").alias("covered"), F.count_if(F.col("latest") > 0).alias("nonzero"), F.count("slope").alias("voting"))
    days = own.agg(F.countDistinct("day").alias("days"))
    return cover.join(F.broadcast(days)).join(F.broadcast(votes_)).join(F.broadcast(axes)).select("days", "covered", "nonzero", "voting", "rising_votes", "two_axes_now", "two_axes_projected")
