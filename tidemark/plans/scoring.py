"""Queries on series fits, weekly scoring and cohort summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.stats import r, residualize, robust_z
from tidemark.operators import cohort as co
from tidemark.operators import series as se
from tidemark.plans.base import ACTIVITY, CURRENT_YEAR, METHOD, MONTHS, SCORES, activity, query, scores, t, yearly


@query("st_01_log_slope", f"WITH {ACTIVITY} SELECT entity_id, round(coalesce(regr_slope(ln(1 + value), pos), 0), 6) + 0.0 AS slope FROM activity GROUP BY 1")
def st_01(s, d):
    return se.log_slope(activity(s, d), ["entity_id"]).select("entity_id", r("slope").alias("slope"))


@query("st_02_yearly_momentum", SCORES + " SELECT entity_id, axis2_status, round(axis2_slope, 6) + 0.0 AS axis2_slope, axis2_total FROM a2")
def st_02(s, d):
    return se.yearly_momentum(yearly(s, d), CURRENT_YEAR).select("entity_id", "axis2_status", r("axis2_slope").alias("axis2_slope"), "axis2_total")


@query("st_03_robust_z", SCORES + " SELECT entity_id, round(z, 6) + 0.0 AS z FROM axis1z")
def st_03(s, d):
    rows = activity(s, d).select("entity_id", "cohort").distinct().join(se.trailing(activity(s, d), MONTHS - 1), "entity_id")
    return robust_z(rows, ["cohort"], "axis1_slope", "z").select("entity_id", r("z").alias("z"))


@query("st_04_residualize", SCORES + " SELECT entity_id, axis1_z FROM axis1r")
def st_04(s, d):
    return scores(s, d).select("entity_id", "axis1_z")


@query("st_07_dated_slope", """SELECT l_partkey AS entity_id, round(coalesce(regr_slope(ln(1 + v), date_diff('day', DATE '1970-01-01', m)), 0), 6) + 0.0 AS slope
 FROM (SELECT l_partkey, date_trunc('month', l_shipdate)::DATE AS m, count(*) AS v FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def st_07(s, d):
    rows = t(s, d, "lineitem").groupBy(F.col("l_partkey").alias("entity_id"), F.trunc("l_shipdate", "month").alias("m")).agg(F.count("*").alias("v"))
    return se.dated_slope(rows, ["entity_id"], "m", "v").select("entity_id", r("slope").alias("slope"))


@query("st_08_plain_slope", f"WITH {ACTIVITY} SELECT entity_id, round(coalesce(regr_slope(value, pos), 0), 6) + 0.0 AS slope FROM activity GROUP BY 1")
def st_08(s, d):
    return se.plain_slope(activity(s, d), ["entity_id"]).select("entity_id", r("slope").alias("slope"))


@query("st_11_trailing_windows", SCORES + " SELECT entity_id, round(axis1_slope, 6) + 0.0 AS axis1_slope, recent FROM a1")
def st_11(s, d):
    return se.trailing(activity(s, d), MONTHS - 1).select("entity_id", r("axis1_slope").alias("axis1_slope"), "recent")


@query("st_12_recency_swing", f"""WITH {ACTIVITY}, k AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY pos DESC) AS k FROM activity),
 g AS (SELECT entity_id, count(*) FILTER (WHERE k > 13) AS prior_window, coalesce(regr_slope(ln(1 + value), pos) FILTER (WHERE k <= 13), 0) AS rs,
  coalesce(regr_slope(ln(1 + value), pos) FILTER (WHERE k > 13), 0) AS ps FROM k WHERE k <= 52 GROUP BY 1),
 v AS (SELECT *, rs / CASE WHEN abs(ps) < 1e-6 THEN 1e-6 * CASE WHEN ps < 0 THEN -1 ELSE 1 END ELSE ps END AS v FROM g)
 SELECT entity_id, CASE WHEN abs(ps) < 1e-6 THEN NULL ELSE round(v, 3) + 0.0 END AS swing, prior_window, CASE WHEN abs(ps) < 1e-6 AND rs > 1e-6 THEN 'accelerating from a flat base'
  WHEN abs(ps) < 1e-6 AND rs < -1e-6 THEN 'recent slope negative on a flat base' WHEN abs(ps) < 1e-6 THEN 'flat' WHEN round(v, 9) > 1.15 THEN 'accelerating'
  WHEN round(v, 9) < 0 THEN 'recent slope sign differs from prior window' WHEN round(v, 9) < 0.85 THEN 'recent slope below prior window' ELSE 'steady' END AS label FROM v""")
def st_12(s, d):
    got = se.recency_swing(activity(s, d))
    flat = F.col("label").contains("flat")
    return got.select("entity_id", F.when(~flat, r("swing", 3)).alias("swing"), "prior_window", "label")


def noise_sql(source: str) -> str:
    """CTEs ending in ``noise``: slope over residual deviation, or why it is withheld."""
    return f"""f AS (SELECT entity_id, count(*) AS n, count(*) FILTER (WHERE value > 0) AS nz, coalesce(regr_slope(ln(1 + value), pos), 0) AS b, avg(ln(1 + value)) AS my, avg(pos) AS mx, var_pop(pos) AS vx FROM {source} GROUP BY 1),
 e AS (SELECT entity_id, pos, ln(1 + value) - my - b * (pos - mx) AS e FROM {source} JOIN f USING (entity_id)),
 l AS (SELECT entity_id, e, lag(e) OVER (PARTITION BY entity_id ORDER BY pos) AS p FROM e), q AS (SELECT entity_id, sum(e * e) AS ss, coalesce(sum(e * p), 0) AS sp FROM l GROUP BY 1),
 u AS (SELECT *, greatest(1, n - 2) AS dof, sqrt(ss / greatest(1, n - 2)) AS sd, CASE WHEN ss = 0 THEN 0 ELSE sp / ss END AS rho FROM f JOIN q USING (entity_id)),
 noise AS (SELECT *, CASE WHEN nz < 26 THEN 'too few non-zero places' WHEN sd < 1e-12 THEN 'no residual variance' END AS reason FROM u)"""


@query("st_13_slope_to_noise", f"""WITH {ACTIVITY}, {noise_sql("activity")}
 SELECT entity_id, CASE WHEN reason IS NULL THEN round(b / sd, 6) + 0.0 END AS ratio, CASE WHEN reason IS NULL THEN round(b / sd - 1.96 * sqrt(greatest(1, (1 + rho) / (1 - rho))) / sqrt(vx * n), 6) + 0.0 END AS low,
  CASE WHEN reason IS NULL THEN round(b / sd + 1.96 * sqrt(greatest(1, (1 + rho) / (1 - rho))) / sqrt(vx * n), 6) + 0.0 END AS high, dof::BIGINT AS dof, reason FROM noise""")
def st_13(s, d):
    return se.slope_to_noise(activity(s, d)).select("entity_id", r("ratio").alias("ratio"), r("low").alias("low"), r("high").alias("high"), "dof", "reason")


def _side(x: str) -> str:
    return f"""CASE WHEN xx{x} - x{x} * x{x} / n{x} = 0 THEN 0 ELSE (xy{x} - x{x} * y{x} / n{x}) / (xx{x} - x{x} * x{x} / n{x}) END AS b{x}, xx{x} - x{x} * x{x} / n{x} AS sxx{x}, xy{x} - x{x} * y{x} / n{x} AS sxy{x}"""


def _se(x: str) -> str:
    return f"sqrt(greatest(0, yy{x} - y{x} * y{x} / n{x} - b{x} * sxy{x}) / greatest(1, n{x} - 2)) / sqrt(CASE WHEN sxx{x} = 0 THEN 1 ELSE sxx{x} END)"


_SUMS = ", ".join(f"{f} OVER {w} AS {n}{w}" for w in "lr" for f, n in (("count(*)", "n"), ("sum(i)", "x"), ("sum(v)", "y"), ("sum(i * v)", "xy"), ("sum(i * i)", "xx"), ("sum(v * v)", "yy")))


@query("st_14_changepoint", f"""WITH {ACTIVITY}, a AS (SELECT entity_id, value::DOUBLE AS v, (row_number() OVER (PARTITION BY entity_id ORDER BY pos) - 1)::DOUBLE AS i FROM activity),
 w AS (SELECT entity_id, i::BIGINT AS k, {_SUMS} FROM a WINDOW l AS (PARTITION BY entity_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), r AS (PARTITION BY entity_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 f AS (SELECT *, {_side("l")}, {_side("r")} FROM w WHERE k >= 3 AND k <= nl + nr - 3), g AS (SELECT entity_id, k, nl + nr AS n, round(br - bl, 9) AS delta, sqrt(({_se("l")}) ** 2 + ({_se("r")}) ** 2) AS se FROM f),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY abs(delta) DESC, k) AS rn FROM g) WHERE rn = 1)
 SELECT entity_id, CASE WHEN abs(delta) > 2 * se THEN 'changepoint' ELSE 'none' END AS state, CASE WHEN abs(delta) > 2 * se THEN k END AS split, CASE WHEN abs(delta) > 2 * se THEN round(delta, 6) + 0.0 END AS delta FROM b""")
def st_14(s, d):
    return se.changepoint(activity(s, d)).select("entity_id", "state", "split", r("delta").alias("delta"))


#: every entity's series ends with the others', and is up to 59 places long
SHORT = "shorter AS (SELECT * FROM activity WHERE pos > 82 - entity_id % 60)"


@query("st_15_signal_inventory", f"""WITH {ACTIVITY}, {SHORT}, {noise_sql("shorter")}, i AS (SELECT entity_id, n >= 14 AND n - 13 >= 2 AS swing, reason IS NULL AS ratio, n >= 8 AS change FROM noise)
 SELECT entity_id, concat_ws(',', CASE WHEN swing THEN 'swing' END, CASE WHEN ratio THEN 'slope_to_noise' END, CASE WHEN change THEN 'changepoint' END) AS shipped,
  concat_ws(',', CASE WHEN NOT swing THEN 'swing' END, CASE WHEN NOT ratio THEN 'slope_to_noise' END, CASE WHEN NOT change THEN 'changepoint' END, {', '.join(f"'{k}'" for k in sorted(se.RESERVED))}) AS reserved FROM i""")
def st_15(s, d):
    a = activity(s, d).where("pos > 82 - entity_id % 60")
    return se.signal_inventory(se.recency_swing(a), se.slope_to_noise(a), se.changepoint(a)).select("entity_id", F.concat_ws(",", "shipped").alias("shipped"), F.concat_ws(",", "reserved").alias("reserved"))


@query("st_20_intensity", f"WITH {ACTIVITY} SELECT entity_id, pos, round(CASE WHEN max(value) OVER (PARTITION BY entity_id) = 0 THEN 0 ELSE value / max(value) OVER (PARTITION BY entity_id) END, 6) AS intensity FROM activity")
def st_20(s, d):
    return se.intensity(activity(s, d), ["entity_id"]).select("entity_id", "pos", r("intensity").alias("intensity"))


@query("ag_03_yearly_sum", "SELECT l_partkey AS entity_id, year(l_shipdate)::BIGINT AS year, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1, 2")
def ag_03(s, d):
    return yearly(s, d)


ROW = "entity_id, cohort, axis1_z, axis2_z"


@query("cl_01_convergence_gate", SCORES + " SELECT entity_id, n_present::BIGINT AS n_present, (CASE WHEN up1 THEN 'axis1' ELSE '' END || CASE WHEN up1 AND up2 THEN ',' ELSE '' END || CASE WHEN up2 THEN 'axis2' ELSE '' END) AS convergent, rising FROM scores")
def cl_01(s, d):
    return scores(s, d).select("entity_id", F.size("axes_present").cast("long").alias("n_present"), F.concat_ws(",", "convergent_axes").alias("convergent"), "rising")


@query("cl_02_status", SCORES + " SELECT entity_id, cohort, status FROM scores")
def cl_02(s, d):
    return scores(s, d).select("entity_id", "cohort", "status")


@query("cl_03_momentum", SCORES + " SELECT entity_id, momentum, confidence FROM scores")
def cl_03(s, d):
    return scores(s, d).select("entity_id", "momentum", "confidence")


@query("wn_01_percentile", SCORES + " SELECT entity_id, cohort, momentum, percentile FROM scores")
def wn_01(s, d):
    return scores(s, d, percentiles=True).select("entity_id", "cohort", "momentum", "percentile")


@query("weekly_scores", SCORES + " SELECT entity_id, cohort, axis1_z, axis2_z, momentum, percentile, status, confidence FROM scores")
def flagship(s, d):
    return scores(s, d, percentiles=True).select("entity_id", "cohort", "axis1_z", "axis2_z", "momentum", "percentile", "status", "confidence")


COUNTS = "count(*) AS entities, count(*) FILTER (WHERE status = 'rising') AS rising, count(*) FILTER (WHERE status = 'watch') AS watch, count(*) FILTER (WHERE status = 'tracked'{}) AS tracked, {} count(*) FILTER (WHERE status = 'calibration') AS calibration, count(*) FILTER (WHERE axis2_status = 'present') AS axis2_present FROM scores"


@query("ag_01_status_counts", SCORES + " SELECT cohort, " + COUNTS.format("", "count(*) FILTER (WHERE status = 'single-axis') AS single_axis,") + " GROUP BY 1")
def ag_01(s, d):
    return co.status_counts(scores(s, d), ["cohort"])


@query("ag_02_legacy_fold_counts", SCORES + " SELECT cohort, " + COUNTS.format(" OR status = 'single-axis'", "") + " GROUP BY 1")
def ag_02(s, d):
    return co.status_counts(scores(s, d), ["cohort"], fold_single=True)


@query("ag_13_power_funnel", SCORES + """ SELECT count(*) FILTER (WHERE has1) AS measured, count(*) FILTER (WHERE n_present >= 2) AS two_axes, count(*) FILTER (WHERE n_present >= 2 AND cohort_n >= 5) AS sized,
 count(*) FILTER (WHERE n_present >= 2 AND cohort_n >= 5 AND n_up >= 1) AS one_up, count(*) FILTER (WHERE n_present >= 2 AND cohort_n >= 5 AND n_up >= 2 AND NOT incumbent) AS both_up FROM scores""")
def ag_13(s, d):
    return co.power_funnel(scores(s, d), METHOD)


GRID = [0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0]


@query("jn_20_sensitivity_grid", SCORES + f" SELECT g.threshold, count(*) FILTER (WHERE least(axis1_z, axis2_z) >= g.threshold) AS passing FROM (SELECT unnest({GRID}::DOUBLE[]) AS threshold) g CROSS JOIN (SELECT * FROM scores WHERE n_present >= 2) GROUP BY 1")
def jn_20(s, d):
    return co.sensitivity(scores(s, d), GRID)


@query("ag_14_two_axis_coverage", SCORES + " SELECT cohort, count(*) AS entities, count(*) FILTER (WHERE n_present >= 2) AS two_axis, round(count(*) FILTER (WHERE n_present >= 2) / count(*), 6) AS coverage FROM scores GROUP BY 1")
def ag_14(s, d):
    return co.two_axis_coverage(scores(s, d)).withColumn("coverage", r("coverage"))


@query("ag_16_cohort_summary", SCORES + " SELECT cohort, round(median(momentum), 6) AS median_momentum, max(momentum) AS max_momentum, count(*) AS entities, round(count(*) / (SELECT count(*) FROM scores), 6) AS share FROM scores GROUP BY 1")
def ag_16(s, d):
    return co.cohort_summary(scores(s, d)).withColumn("share", r("share")).withColumn("median_momentum", r("median_momentum"))


@query("ag_32_cohort_size", "SELECT p_partkey AS entity_id, count(*) OVER (PARTITION BY p_brand) AS cohort_n FROM part")
def ag_32(s, d):
    from tidemark.plans.base import registry

    g = registry(s, d)
    return g.join(g.groupBy("cohort").agg(F.count("*").alias("cohort_n")), "cohort").select("entity_id", "cohort_n")


@query("st_06_shadow_z", f"""WITH {ACTIVITY}, f AS (SELECT entity_id, cohort, coalesce(regr_slope(ln(1 + value), pos), 0) AS v, ln(1 + size) AS ls FROM activity GROUP BY 1, 2, size),
 m AS (SELECT cohort, count(*) AS n, -quantile_disc(-v, 0.5) AS mv FROM f GROUP BY 1), d AS (SELECT cohort, -quantile_disc(-abs(v - mv), 0.5) * 1.4826 AS sd FROM f JOIN m USING (cohort) GROUP BY 1),
 z AS (SELECT entity_id, cohort, n, ls, CASE WHEN sd = 0 THEN 0 ELSE greatest(-3.0, least(3.0, (v - mv) / sd)) END AS z FROM f JOIN m USING (cohort) JOIN d USING (cohort)),
 q AS (SELECT cohort, covar_pop(ls, z) AS c, var_pop(ls) AS vv, avg(ls) AS ml FROM z GROUP BY 1)
 SELECT entity_id, round(greatest(-3.0, least(3.0, CASE WHEN n < 3 THEN z ELSE z - c / vv * (ls - ml) END)), 6) + 0.0 AS z FROM z JOIN q USING (cohort) WHERE n >= 5""")
def st_06(s, d):
    a = activity(s, d)
    rows = se.log_slope(a, ["entity_id", "cohort", "size"]).withColumn("ls", F.log1p("size"))
    sized = rows.groupBy("cohort").agg(F.count("*").alias("n")).where("n >= 5").select("cohort")
    z = robust_z(rows.join(sized, "cohort"), ["cohort"], "slope", "z0", floor=None, upper=True)
    return residualize(z, ["cohort"], "z0", "ls", "z", least=3, bound=3.0).select("entity_id", r("z").alias("z"))
