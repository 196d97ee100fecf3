"""Queries on panels, votes and promotion criteria."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.stats import r
from tidemark.operators import panel as pn
from tidemark.plans.base import SCORES, query, scores, t

BAD, BAD_YEAR = "1998-07-01", "1998-01-01"
#: customers a month per part type, one month scaled down: the corrupt partition
PANEL = f"""panel AS (SELECT 'types' AS series, p_brand AS entity, date_trunc('quarter', l_shipdate)::DATE AS snap,
 (count(*) // CASE WHEN date_trunc('quarter', l_shipdate)::DATE = DATE '{BAD}' THEN 20 ELSE 1 END)::BIGINT AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
 idx AS (SELECT *, dense_rank() OVER (ORDER BY snap) AS idx FROM panel)"""


def panel(s, d):
    j = t(s, d, "lineitem").join(t(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    n = j.groupBy(F.lit("types").alias("series"), F.col("p_brand").alias("entity"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("snap")).agg(F.count("*").alias("n"))
    return n.select("series", "entity", "snap", F.floor(F.col("n") / F.when(F.col("snap") == F.lit(BAD), 20).otherwise(1)).cast("long").alias("value"))


def cohorts(s, d):
    """Brands fall into five cohorts by their first digit."""
    return t(s, d, "part").select(F.col("p_brand").alias("entity"), F.substring("p_brand", 7, 1).alias("cohort")).distinct()


MOVES = """m AS (SELECT c.entity, c.snap, c.idx, c.value AS v, p.value AS a, n1.value AS b1, n2.value AS b2 FROM idx c JOIN idx p ON p.entity = c.entity AND p.idx = c.idx - 1
 LEFT JOIN idx n1 ON n1.entity = c.entity AND n1.idx = c.idx + 1 LEFT JOIN idx n2 ON n2.entity = c.entity AND n2.idx = c.idx + 2 WHERE p.value >= 5)"""
REV = """rev AS (SELECT snap, count(*) AS eligible, avg((abs(ln((v + 1) / (a + 1))) > ln(2) AND least(abs(ln((b1 + 1) / (a + 1))), abs(ln((b2 + 1) / (a + 1)))) < ln(2) / 2)::INT) AS share
 FROM m WHERE b1 IS NOT NULL OR b2 IS NOT NULL GROUP BY 1)"""


@query("st_17_reversal_share", f"WITH {PANEL}, {MOVES}, {REV} SELECT snap, eligible, round(share, 6) AS share FROM rev")
def st_17(s, d):
    return pn.reversal_share(panel(s, d), 0.6931471805599453).select("snap", "eligible", r("share").alias("share"))


@query("st_18_clean_moves", f"""WITH {PANEL}, {MOVES} SELECT snap, count(*) AS n, round(max(abs(ln((v + 1) / (a + 1)))), 6) AS max_move, CASE WHEN count(*) >= 10 THEN round(avg((abs(ln((v + 1) / (a + 1))) > ln(2))::INT), 6) END AS big_share
 FROM m WHERE idx NOT IN (SELECT idx FROM idx WHERE snap = DATE '{BAD}') AND idx - 1 NOT IN (SELECT idx FROM idx WHERE snap = DATE '{BAD}') GROUP BY 1""")
def st_18(s, d):
    bad = s.createDataFrame([(BAD,)], "snap string").select(F.to_date("snap").alias("snap"))
    return pn.clean_moves(panel(s, d), bad).select("snap", "n", r("max_move").alias("max_move"), r("big_share").alias("big_share"))


@query("ag_29_coverage_deviation", f"WITH {PANEL}, n AS (SELECT snap, count(DISTINCT entity) AS n FROM panel GROUP BY 1), md AS (SELECT -quantile_disc(-n, 0.5) AS median_n FROM n) SELECT median_n, round(max(abs(n - median_n) / median_n), 6) AS max_deviation FROM n, md GROUP BY 1")
def ag_29(s, d):
    return pn.coverage_deviation(panel(s, d)).select("median_n", r("max_deviation").alias("max_deviation"))


@query("st_19_calibrate", f"""WITH {PANEL}, {MOVES}, cm AS (SELECT snap, count(*) AS n, max(abs(ln((v + 1) / (a + 1)))) AS mm, avg((abs(ln((v + 1) / (a + 1))) > ln(2))::INT) AS bs FROM m
  WHERE idx NOT IN (SELECT idx FROM idx WHERE snap = DATE '{BAD}') AND idx - 1 NOT IN (SELECT idx FROM idx WHERE snap = DATE '{BAD}') GROUP BY 1),
 n AS (SELECT snap, count(DISTINCT entity) AS n FROM panel WHERE snap <> DATE '{BAD}' GROUP BY 1), md AS (SELECT -quantile_disc(-n, 0.5) AS q FROM n), dv AS (SELECT max(abs(n - q) / q) AS dv FROM n, md)
 SELECT 'types' AS series, round(greatest(max(mm), ln(2)), 6) AS move_bound, round(greatest(3 * coalesce(max(CASE WHEN n >= 10 THEN bs END), 0), 0.1), 6) AS share_bound, round(least(0.9, 1 - 3 * max(dv)), 6) AS least_coverage FROM cm, dv""")
def st_19(s, d):
    bad = s.createDataFrame([(BAD,)], "snap string").select(F.to_date("snap").alias("snap"))
    got = pn.calibrate(panel(s, d), bad)
    return got.select("series", *(r(c).alias(c) for c in ("move_bound", "share_bound", "least_coverage")))


#: other series: orders a nation and year, as they are and with one year scaled down
CONTROL = f"""panel AS (SELECT series, entity, snap, (n // CASE WHEN series = 'broken' AND snap = DATE '{BAD_YEAR}' THEN 20 ELSE 1 END)::BIGINT AS value
 FROM (SELECT c_nationkey::VARCHAR AS entity, date_trunc('year', o_orderdate)::DATE AS snap, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), (SELECT unnest(['nations', 'broken']) AS series)),
 idx AS (SELECT *, dense_rank() OVER (PARTITION BY series ORDER BY snap) AS idx FROM panel)"""


def control(s, d):
    o = t(s, d, "orders").join(t(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    n = o.groupBy(F.col("c_nationkey").cast("string").alias("entity"), F.to_date(F.date_trunc("year", "o_orderdate")).alias("snap")).agg(F.count("*").alias("n"))
    down = F.when((F.col("series") == "broken") & (F.col("snap") == F.lit(BAD_YEAR)), 20).otherwise(1)
    return n.withColumn("series", F.explode(F.array(F.lit("nations"), F.lit("broken")))).select("series", "entity", "snap", F.floor(F.col("n") / down).cast("long").alias("value"))


@query("st_19_negative_control", f"""WITH {CONTROL}, m AS (SELECT c.series, c.snap, c.value AS v, p.value AS a, n1.value AS b1, n2.value AS b2 FROM idx c JOIN idx p ON p.series = c.series AND p.entity = c.entity AND p.idx = c.idx - 1
 LEFT JOIN idx n1 ON n1.series = c.series AND n1.entity = c.entity AND n1.idx = c.idx + 1 LEFT JOIN idx n2 ON n2.series = c.series AND n2.entity = c.entity AND n2.idx = c.idx + 2 WHERE p.value >= 5 AND (n1.value IS NOT NULL OR n2.value IS NOT NULL)),
 f AS (SELECT series, snap, count(*) AS eligible, avg((abs(ln((v + 1) / (a + 1))) > ln(2) AND least(abs(ln((b1 + 1) / (a + 1))), abs(ln((b2 + 1) / (a + 1)))) < ln(2) / 2)::INT) AS share FROM m GROUP BY 1, 2)
 SELECT series, snap, eligible, round(share, 6) AS share FROM f WHERE eligible >= 10 AND share > 0.3""")
def st_19b(s, d):
    return pn.firings(control(s, d), 0.6931471805599453, 0.3).withColumn("share", r("share"))


@query("cl_12_partition_verdicts", f"""WITH {PANEL}, {MOVES}, {REV}, n AS (SELECT snap, idx, count(DISTINCT entity) AS n FROM idx GROUP BY 1, 2), md AS (SELECT -quantile_disc(-n, 0.5) AS md, max(idx) AS last FROM n)
 SELECT n.snap, n.n AS coverage, CASE WHEN eligible >= 10 AND share > 0.3 AND n.idx < last THEN 'SUSPECT_CORRUPT' WHEN n.n < 0.9 * md THEN 'INVALID_COVERAGE' WHEN n.idx = last AND last > 1 THEN 'PROVISIONAL' ELSE 'CLEAN' END AS status
 FROM n CROSS JOIN md LEFT JOIN rev USING (snap)""")
def cl_12(s, d):
    return pn.verdicts(panel(s, d), 0.6931471805599453, 0.3, 0.9).select("snap", "coverage", "status")


PTS = "pts AS (SELECT entity, (row_number() OVER (PARTITION BY entity ORDER BY snap) - 1)::DOUBLE AS i, ln(1 + value) AS y, value, snap FROM panel)"


@query("st_09_theil_sen", f"WITH {PANEL}, {PTS} SELECT a.entity, round(median((b.y - a.y) / (b.i - a.i)), 6) + 0.0 AS theil_sen FROM pts a JOIN pts b ON a.entity = b.entity AND a.i < b.i GROUP BY 1")
def st_09(s, d):
    w = pn.Window.partitionBy("entity").orderBy("snap")
    pts = panel(s, d).select("entity", (F.row_number().over(w) - 1).cast("double").alias("i"), F.log1p(F.col("value").cast("double")).alias("y"))
    return pn.theil_sen(pts, ["entity"]).select("entity", r("theil_sen").alias("theil_sen"))


@query("st_10_leave_one_out", f"""WITH {PANEL}, {PTS}, l AS (SELECT a.entity, k.i AS k, a.y, (row_number() OVER (PARTITION BY a.entity, k.i ORDER BY a.i) - 1)::DOUBLE AS j FROM pts a JOIN pts k ON a.entity = k.entity AND a.i <> k.i),
 s AS (SELECT entity, k, regr_slope(y, j) AS b FROM l GROUP BY 1, 2), f AS (SELECT entity, regr_slope(y, i) AS b FROM pts GROUP BY 1) SELECT s.entity, bool_or((s.b > 1e-12) <> (f.b > 1e-12)) AS flips FROM s JOIN f USING (entity) GROUP BY 1""")
def st_10(s, d):
    w = pn.Window.partitionBy("entity").orderBy("snap")
    pts = panel(s, d).select("entity", (F.row_number().over(w) - 1).cast("double").alias("i"), F.log1p(F.col("value").cast("double")).alias("y"))
    return pn.leave_one_out_flips(pts, ["entity"])


ZED = """ends AS (SELECT p.entity, substr(p.entity, 7, 1) AS cohort, count(*) AS points, arg_max(value, snap) AS latest, arg_min(value, snap) AS first, coalesce(regr_slope(y, i), 0) AS slope FROM pts p GROUP BY 1, 2 HAVING count(*) >= 14 AND arg_max(value, snap) >= 5),
 fit AS (SELECT cohort, count(*) AS m, covar_pop(ln(1 + latest), slope) AS c, var_pop(ln(1 + latest)) AS vv, avg(ln(1 + latest)) AS ml FROM ends GROUP BY 1),
 res AS (SELECT e.*, m, CASE WHEN m < 2 THEN slope ELSE slope - c / CASE WHEN vv = 0 THEN 1e-9 ELSE vv END * (ln(1 + latest) - ml) END AS v FROM ends e JOIN fit USING (cohort)),
 md AS (SELECT cohort, -quantile_disc(-v, 0.5) AS md FROM res GROUP BY 1), sd AS (SELECT cohort, -quantile_disc(-abs(v - md), 0.5) * 1.4826 AS sd FROM res JOIN md USING (cohort) GROUP BY 1),
 zed AS (SELECT res.*, CASE WHEN m < 2 OR sd = 0 THEN 0 ELSE greatest(-3.0, least(3.0, (v - md) / sd)) END AS z FROM res JOIN md USING (cohort) JOIN sd USING (cohort))"""


@query("st_05_residual_first_z", f"WITH {PANEL}, {PTS}, {ZED} SELECT entity, round(z, 6) + 0.0 AS z FROM zed")
def st_05(s, d):
    return pn.votes(panel(s, d).drop("series"), cohorts(s, d), veto=False).select("entity", r("z").alias("z"))


CLEAN_PTS = PTS.replace("FROM panel", f"FROM panel WHERE snap <> DATE '{BAD}'")


@query("cl_13_votes", f"""WITH {PANEL}, {CLEAN_PTS}, {ZED}, ts AS (SELECT a.entity, median((b.y - a.y) / (b.i - a.i)) AS ts FROM pts a JOIN pts b ON a.entity = b.entity AND a.i < b.i GROUP BY 1),
 l AS (SELECT a.entity, k.i AS k, a.y, (row_number() OVER (PARTITION BY a.entity, k.i ORDER BY a.i) - 1)::DOUBLE AS j FROM pts a JOIN pts k ON a.entity = k.entity AND a.i <> k.i),
 lo AS (SELECT s.entity, bool_or((s.b > 1e-12) <> (f.b > 1e-12)) AS flips FROM (SELECT entity, k, regr_slope(y, j) AS b FROM l GROUP BY 1, 2) s JOIN (SELECT entity, regr_slope(y, i) AS b FROM pts GROUP BY 1) f USING (entity) GROUP BY 1),
 un AS (SELECT zed.*, ((slope > 0) <> (ts > 0)) OR flips AS unstable FROM zed JOIN ts USING (entity) JOIN lo USING (entity))
 SELECT entity, cohort, points, latest, round(slope, 6) + 0.0 AS slope, round(z, 6) + 0.0 AS z, unstable, slope > 0 AND z >= 1.0 AND NOT unstable AS rising FROM un""")
def cl_13(s, d):
    return pn.votes(panel(s, d).where(F.col("snap") != F.lit(BAD)).drop("series"), cohorts(s, d)).select("entity", "cohort", "points", "latest", r("slope").alias("slope"), r("z").alias("z"), "unstable", "rising")


@query("cl_13_votes_no_veto", f"WITH {PANEL}, {PTS}, {ZED} SELECT entity, cohort, points, slope > 0 AND z >= 1.0 AS rising FROM zed")
def cl_13b(s, d):
    return pn.votes(panel(s, d).drop("series"), cohorts(s, d), veto=False).select("entity", "cohort", "points", "rising")


@query("cl_14_verdict_canary", f"WITH {PANEL}, {PTS}, {ZED} SELECT cohort, count(*) AS n, round(avg(((round(slope, 6) > 0) = (latest > first))::INT), 6) AS agreement, count(*) >= 3 AND avg(((round(slope, 6) > 0) = (latest > first))::INT) < 0.8 AS hold FROM zed GROUP BY 1")
def cl_14(s, d):
    return pn.verdict_canary(pn.votes(panel(s, d).drop("series"), cohorts(s, d), veto=False)).withColumn("agreement", r("agreement"))


CUTS = ["2000-01-01", "2000-07-01", "2001-01-01", "2001-07-01"]


def cut_votes(s, d):
    cuts = s.createDataFrame([(c,) for c in CUTS], "c string").select(F.to_date("c").alias("cutoff"))
    return pn.votes(pn.at_cutoffs(panel(s, d).drop("series"), cuts), cohorts(s, d), keys=["cutoff"], veto=False)


@query("wn_07_every_cutoff", f"WITH {PANEL} SELECT c.cutoff, entity, count(*) AS points, arg_max(value, snap) AS latest FROM panel JOIN (SELECT unnest({CUTS}::DATE[]) AS cutoff) c ON snap <= c.cutoff GROUP BY 1, 2 HAVING count(*) >= 14 AND arg_max(value, snap) >= 5")
def wn_07(s, d):
    return cut_votes(s, d).select("cutoff", "entity", "points", "latest")


CUTZED = f"""cp AS (SELECT c.cutoff, p.* FROM panel p JOIN (SELECT unnest({CUTS}::DATE[]) AS cutoff) c ON snap <= c.cutoff),
 pts AS (SELECT cutoff, entity, (row_number() OVER (PARTITION BY cutoff, entity ORDER BY snap) - 1)::DOUBLE AS i, ln(1 + value) AS y, value, snap FROM cp),
 ends AS (SELECT cutoff, entity, substr(entity, 7, 1) AS cohort, arg_max(value, snap) AS latest, coalesce(regr_slope(y, i), 0) AS slope FROM pts GROUP BY 1, 2, 3 HAVING count(*) >= 14 AND arg_max(value, snap) >= 5),
 fit AS (SELECT cutoff, cohort, count(*) AS m, covar_pop(ln(1 + latest), slope) AS c, var_pop(ln(1 + latest)) AS vv, avg(ln(1 + latest)) AS ml FROM ends GROUP BY 1, 2),
 res AS (SELECT e.*, m, CASE WHEN m < 2 THEN slope ELSE slope - c / CASE WHEN vv = 0 THEN 1e-9 ELSE vv END * (ln(1 + latest) - ml) END AS v FROM ends e JOIN fit USING (cutoff, cohort)),
 md AS (SELECT cutoff, cohort, -quantile_disc(-v, 0.5) AS md FROM res GROUP BY 1, 2), sd AS (SELECT cutoff, cohort, -quantile_disc(-abs(v - md), 0.5) * 1.4826 AS sd FROM res JOIN md USING (cutoff, cohort) GROUP BY 1, 2),
 vt AS (SELECT cutoff, entity, slope > 0 AND CASE WHEN m < 2 OR sd = 0 THEN 0 ELSE (v - md) / sd END >= 1.0 AS rising FROM res JOIN md USING (cutoff, cohort) JOIN sd USING (cutoff, cohort)),
 steps AS (SELECT cutoff, lag(cutoff) OVER (ORDER BY cutoff) AS prev FROM (SELECT DISTINCT cutoff FROM vt)),
 bo AS (SELECT coalesce(n.prev, b.prev) AS prev, coalesce(n.cutoff, b.cutoff) AS cutoff, n.rising AS now, b.rising AS was FROM (SELECT s.prev, s.cutoff, entity, rising FROM vt JOIN steps s ON s.cutoff = vt.cutoff WHERE s.prev IS NOT NULL) n
 FULL OUTER JOIN (SELECT s.prev, s.cutoff, entity, rising FROM vt JOIN steps s ON s.prev = vt.cutoff) b ON n.prev = b.prev AND n.cutoff = b.cutoff AND n.entity = b.entity)"""


@query("so_02_flip_and_churn", f"WITH {PANEL}, {CUTZED} SELECT prev, cutoff, count(*) AS n, round(avg((coalesce(now, false) <> coalesce(was, false))::INT), 6) AS flip, round(avg((now IS NULL OR was IS NULL)::INT), 6) AS churn, CASE WHEN count(*) < 5 THEN 'UNEVALUABLE' ELSE 'EVALUATED' END AS state FROM bo GROUP BY 1, 2")
def so_02(s, d):
    return pn.flip_and_churn(cut_votes(s, d)).select("prev", "cutoff", "n", r("flip").alias("flip"), r("churn").alias("churn"), "state")


@query("st_16_pooled_correlation", SCORES + ", g AS (SELECT cohort, count(*) AS n, avg(axis1_z) AS a, avg(axis2_z) AS b FROM scores WHERE axis1_z IS NOT NULL AND axis2_z IS NOT NULL GROUP BY 1 HAVING count(*) >= 5) SELECT count(*) AS n, round(corr(axis1_z - a, axis2_z - b), 6) AS corr FROM scores JOIN g USING (cohort) WHERE axis1_z IS NOT NULL AND axis2_z IS NOT NULL")
def st_16(s, d):
    return pn.pooled_correlation(scores(s, d), "axis1_z", "axis2_z").withColumn("corr", r("corr"))


PROMOTION = SCORES + f""", g AS (SELECT cohort, avg(axis1_z) AS a, avg(axis2_z) AS b FROM scores WHERE axis1_z IS NOT NULL AND axis2_z IS NOT NULL GROUP BY 1 HAVING count(*) >= 5),
 cr AS (SELECT corr(axis1_z - a, axis2_z - b) AS corr FROM scores JOIN g USING (cohort) WHERE axis1_z IS NOT NULL AND axis2_z IS NOT NULL), {PANEL}, {CUTZED.replace(" cutoff, entity, slope > 0 AND", " cutoff, entity, cohort, slope, latest > first AS up, slope > 0 AND").replace("arg_max(value, snap) AS latest, coalesce", "arg_max(value, snap) AS latest, arg_min(value, snap) AS first, coalesce").replace("md AS (", "mdc AS (").replace("JOIN md USING", "JOIN mdc USING")},
 lt AS (SELECT * FROM vt WHERE cutoff = (SELECT max(cutoff) FROM vt)), can AS (SELECT cohort, count(*) >= 3 AND avg(((round(slope, 6) > 0) = up)::INT) < 0.8 AS hold FROM lt GROUP BY 1),
 fl AS (SELECT count(*) AS n, avg((coalesce(now, false) <> coalesce(was, false))::INT) AS flip FROM bo GROUP BY prev, cutoff),
 o AS (SELECT count(*) AS voting, count(*) FILTER (WHERE rising) AS rising, count(DISTINCT CASE WHEN rising THEN cohort END) AS rising_cohorts, (SELECT count(*) FILTER (WHERE hold) FROM can) AS held_cohorts,
  count(*) FILTER (WHERE entity IN (SELECT cohort FROM scores WHERE has1)) AS gate_capable, (SELECT corr FROM cr) AS corr, (SELECT count(*) FROM fl WHERE n >= 5) AS evaluated, (SELECT max(flip) FROM fl WHERE n >= 5) AS max_flip FROM lt)
 SELECT voting, rising, rising_cohorts, held_cohorts, gate_capable, round(rising / voting, 6) AS share, gate_capable >= 30 AS c1_coverage, coalesce(abs(corr) < 0.5, false) AS c2_independence, evaluated > 0 AND coalesce(max_flip < 0.3, false) AS c3_flip,
  held_cohorts = 0 AND rising > 0 AND rising / voting < 0.4 AND rising_cohorts >= 2 AS c4_nondegeneracy, true AS c5_floors, true AS c6_no_lookahead, CASE WHEN held_cohorts > 0 THEN 'HOLD' ELSE 'EVALUATED' END AS status FROM o"""


@query("cl_15_promotion_criteria", PROMOTION)
def cl_15(s, d):
    v = cut_votes(s, d)
    x = scores(s, d)
    axes = x.groupBy(F.col("cohort").alias("entity")).agg(F.max(F.array_contains("axes_present", "axis1").cast("int")).alias("axes_present"))
    return pn.promotion(v, axes, pn.pooled_correlation(x, "axis1_z", "axis2_z"), pn.flip_and_churn(v)).withColumn("share", r("share"))


SHADOW = SCORES + f""", pt AS (SELECT l_partkey AS entity, date_trunc('month', l_shipdate)::DATE AS day, count(*) AS value FROM lineitem GROUP BY 1, 2),
 rw AS (SELECT entity, p.p_brand AS cohort, count(*) AS points, arg_max(value, day) AS latest, CASE WHEN count(*) >= 14 THEN coalesce(regr_slope(ln(1 + value), date_diff('day', DATE '1970-01-01', day)), 0) END AS slope FROM pt JOIN part p ON p_partkey = entity GROUP BY 1, 2),
 vo AS (SELECT *, ln(1 + latest) AS ls FROM rw WHERE slope IS NOT NULL AND cohort IN (SELECT cohort FROM rw WHERE slope IS NOT NULL GROUP BY 1 HAVING count(*) >= 5)),
 vm AS (SELECT cohort, count(*) AS n, -quantile_disc(-slope, 0.5) AS mv FROM vo GROUP BY 1), vd AS (SELECT cohort, -quantile_disc(-abs(slope - mv), 0.5) * 1.4826 AS sd FROM vo JOIN vm USING (cohort) GROUP BY 1),
 vz AS (SELECT vo.*, CASE WHEN sd = 0 THEN 0 ELSE greatest(-3.0, least(3.0, (slope - mv) / sd)) END AS z FROM vo JOIN vm USING (cohort) JOIN vd USING (cohort)),
 vq AS (SELECT cohort, covar_pop(ls, z) AS c, var_pop(ls) AS vv, avg(ls) AS ml FROM vz GROUP BY 1),
 vs AS (SELECT vz.*, CASE WHEN vv = 0 THEN z ELSE greatest(-3.0, least(3.0, z - c / vv * (ls - ml))) END AS zz FROM vz JOIN vq USING (cohort))
 SELECT (SELECT count(DISTINCT day) FROM pt) AS days, (SELECT count(*) FROM rw) AS covered, (SELECT count(*) FILTER (WHERE latest > 0) FROM rw) AS nonzero, (SELECT count(slope) FROM rw) AS voting,
  (SELECT count(*) FROM vs WHERE slope > 0 AND zz >= 1.0 AND latest >= 5) AS rising_votes, count(*) FILTER (WHERE n_present >= 2) AS two_axes_now, count(*) FILTER (WHERE n_present + (rw.slope IS NOT NULL)::INT >= 2) AS two_axes_projected
 FROM scores LEFT JOIN rw ON rw.entity = scores.entity_id"""


@query("cl_16_shadow_report", SHADOW)
def cl_16(s, d):
    pts = t(s, d, "lineitem").groupBy(F.col("l_partkey").alias("entity"), F.trunc("l_shipdate", "month").alias("day")).agg(F.count("*").alias("value"))
    x = scores(s, d).select(F.col("entity_id").alias("entity"), "cohort", F.size("axes_present").alias("axes_present"))
    return pn.shadow_report(pts, x)


@query("sc_06_coverage_per_snapshot", f"WITH {PANEL} SELECT snap, count(*) AS n FROM panel GROUP BY 1")
def sc_06(s, d):
    return panel(s, d).groupBy("snap").agg(F.count("*").alias("n"))


@query("wn_04_adjacent_pairs", f"WITH {PANEL} SELECT snap, lag(snap) OVER (ORDER BY snap) AS prev FROM (SELECT DISTINCT snap FROM panel)")
def wn_04(s, d):
    return panel(s, d).select("snap").distinct().withColumn("prev", F.lag("snap").over(pn.Window.orderBy("snap")))
