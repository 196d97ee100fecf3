
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import backtest, resolution
from tidemark.plans.base import ACTIVITY, MONTHS, activity, by_entity, month_pos, query, t

#: two registers: parts, and customers under the same numbers. Digests pair them, external ids and names chain some of the pairs.
RECORD_SQL = """SELECT 'a' || k AS record_id, 'o' || (k // 12) AS owner, 'n' || (k // 6) AS core, CASE WHEN k % 3 = 0 THEN 'd' || k END AS digest,
  CASE WHEN k % 4 = 0 THEN 'x' || (k // 8) WHEN k % 97 = 5 THEN 'x-common' END AS external_id, k % 2 AS size, CASE WHEN k % 5 > 0 THEN k % 3 END AS variant, k, 0 AS side FROM (SELECT p_partkey AS k FROM part)
 UNION ALL SELECT 'b' || k, 'o' || ((k + CASE WHEN k % 30 = 0 THEN 12 ELSE 0 END) // 12), 'n' || (k // 6), CASE WHEN k % 3 = 0 THEN 'd' || k WHEN k % 50 = 7 THEN 'd' || (k - 1) END,
  CASE WHEN k % 10 = 9 THEN 'x' || (k // 20) END, k % 2, CASE WHEN k % 7 > 0 THEN k % 3 END, k, 1 FROM (SELECT c_custkey AS k FROM customer)"""


def records(s, d):
    k, text = F.col("k"), lambda head, x: F.concat(F.lit(head), F.floor(x).cast("string"))
    a = t(s, d, "part").select(F.col("p_partkey").alias("k")).select(
        text("a", k).alias("record_id"), text("o", k / 12).alias("owner"), text("n", k / 6).alias("core"), F.when(k % 3 == 0, text("d", k)).alias("digest"),
        F.when(k % 4 == 0, text("x", k / 8)).when(k % 97 == 5, "x-common").alias("external_id"), (k % 2).alias("size"), F.when(k % 5 > 0, k % 3).alias("variant"), "k", F.lit(0).alias("side"),
    )
    b = t(s, d, "customer").select(F.col("c_custkey").alias("k")).select(
        text("b", k).alias("record_id"), text("o", (k + F.when(k % 30 == 0, 12).otherwise(0)) / 12).alias("owner"), text("n", k / 6).alias("core"),
        F.when(k % 3 == 0, text("d", k)).when(k % 50 == 7, text("d", k - 1)).alias("digest"), F.when(k % 10 == 9, text("x", k / 20)).alias("external_id"), (k % 2).alias("size"), F.when(k % 7 > 0, k % 3).alias("variant"), "k", F.lit(1).alias("side"),
    )
    return a.unionByName(b).withColumn("first_seen", F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(F.pmod(k * 7, F.lit(40)).cast("int")))


CLUSTERS = f"""RECURSIVE rec AS MATERIALIZED (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * ((k * 7) % 40) AS first_seen FROM ({RECORD_SQL})),
key AS MATERIALIZED (SELECT record_id, 'd' || digest AS key FROM rec WHERE digest IS NOT NULL UNION ALL SELECT record_id, 'x' || external_id FROM rec WHERE external_id IS NOT NULL
  UNION ALL SELECT record_id, concat_ws('|', core, size, variant) FROM rec WHERE variant IS NOT NULL),
link AS MATERIALIZED (SELECT DISTINCT a.record_id AS x, b.record_id AS y FROM key a JOIN key b USING (key) WHERE a.record_id <> b.record_id),
reach AS (SELECT record_id AS x, record_id AS y FROM rec UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
comp AS MATERIALIZED (SELECT x AS record_id, min(y) AS least, count(*) AS n, count(DISTINCT owner) AS owners FROM reach JOIN rec ON rec.record_id = y GROUP BY 1),
resolved AS MATERIALIZED (SELECT record_id, CASE WHEN n > 1 AND n <= 3 AND owners = 1 THEN least ELSE record_id END AS cluster_id, CASE WHEN n = 1 THEN 'single' WHEN n <= 3 AND owners = 1 THEN 'merged' ELSE 'vetoed' END AS state FROM comp)"""


@query("er_01_resolution_guard", f"""WITH {CLUSTERS}, several AS (SELECT core FROM rec JOIN resolved USING (record_id) GROUP BY 1 HAVING count(DISTINCT cluster_id) > 1)
 SELECT record_id, cluster_id, state, core IN (SELECT core FROM several) OR state = 'vetoed' AS review FROM resolved JOIN rec USING (record_id)""")
def er_01(s, d):
    r = records(s, d)
    return resolution.review_band(r, resolution.clusters(r, ["size", "variant"])).select("record_id", "cluster_id", "state", "review")


@query("er_02_prospects", f"""WITH {CLUSTERS}, ev AS (SELECT record_id, 'hard_id' AS kind, first_seen + INTERVAL 1 DAY * (k % 50) AS told_at FROM rec WHERE k % 4 = 1 UNION ALL
  SELECT record_id, 'human', first_seen + INTERVAL 1 DAY * (k % 37 - 2) FROM rec WHERE k % 9 = 2),
 told AS (SELECT cluster_id, min(told_at) AS told_at FROM ev JOIN rec USING (record_id) JOIN resolved USING (record_id) WHERE told_at <= TIMESTAMP '2024-02-15' AND first_seen <= TIMESTAMP '2024-02-15' AND told_at >= first_seen AND told_at <= first_seen + INTERVAL 30 DAY AND (kind = 'human' OR state <> 'vetoed') GROUP BY 1),
 j AS (SELECT *, coalesce(told_at >= first_seen AND told_at <= first_seen + INTERVAL 30 DAY, false) AS good FROM rec JOIN resolved USING (record_id) LEFT JOIN told USING (cluster_id) WHERE first_seen <= TIMESTAMP '2024-02-15')
 SELECT record_id, cluster_id, CASE WHEN good THEN 'e_' || substr(sha256(cluster_id), 1, 16) ELSE 'p_' || substr(sha256(record_id), 1, 16) END AS id,
  CASE WHEN good THEN 'permanent' WHEN TIMESTAMP '2024-02-15' > first_seen + INTERVAL 30 DAY THEN 'expired' ELSE 'prospect' END AS id_state FROM j""")
def er_02(s, d):
    r = records(s, d)
    hard = r.where("k % 4 = 1").select("record_id", F.lit("hard_id").alias("kind"), (F.col("first_seen") + F.make_dt_interval((F.col("k") % 50).cast("int"))).alias("at"))
    human = r.where("k % 9 = 2").select("record_id", F.lit("human").alias("kind"), (F.col("first_seen") + F.make_dt_interval((F.col("k") % 37 - 2).cast("int"))).alias("at"))
    return resolution.promoted(r, resolution.clusters(r, ["size", "variant"]), hard.unionByName(human), F.to_timestamp(F.lit("2024-02-15")))


CUTOFFS, LAGS, CUTS, WIDTH, LEVEL = [23, 35, 47, 59, 71], [6, 12, 24], [0, 2, 4], 6, 400


def fisher_sql() -> str:
    ln = lambda x: f"lgamma({x} + 1)"
    fixed = f"{ln('a + b')} + {ln('c + d')} + {ln('a + c')} + {ln('b + d')} - {ln('a + b + c + d')}"
    return f"list_sum(list_transform(range(a, least(a + b, a + c) + 1), lambda x: exp({fixed} - {ln('x')} - {ln('a + b - x')} - {ln('a + c - x')} - {ln('d - a + x')})))"


@query("bt_01_lead_lag", f"""WITH {ACTIVITY}, sig AS (SELECT entity_id, cutoff, sum(CASE WHEN cutoff - pos < {WIDTH} THEN value WHEN cutoff - pos < {2 * WIDTH} THEN -value ELSE 0 END) AS growth
  FROM activity, (SELECT unnest({CUTOFFS}) AS cutoff) WHERE pos <= cutoff GROUP BY 1, 2),
 clock AS (SELECT l_partkey AS entity_id, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS pos, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
 fame AS (SELECT entity_id, min(pos) AS reached FROM (SELECT *, sum(value) OVER (PARTITION BY entity_id ORDER BY pos) AS run FROM clock) WHERE run >= {LEVEL} GROUP BY 1),
 cell AS (SELECT cutoff, lag, cut, count(*) FILTER (WHERE growth >= cut AND reached <= cutoff + lag) AS a, count(*) FILTER (WHERE growth >= cut AND coalesce(reached > cutoff + lag, true)) AS b,
  count(*) FILTER (WHERE growth < cut AND reached <= cutoff + lag) AS c, count(*) FILTER (WHERE growth < cut AND coalesce(reached > cutoff + lag, true)) AS d
  FROM sig LEFT JOIN fame USING (entity_id), (SELECT unnest({LAGS}) AS lag), (SELECT unnest({CUTS}) AS cut) WHERE coalesce(reached > cutoff, true) AND cutoff + lag <= {MONTHS - 1} GROUP BY 1, 2, 3)
 SELECT cutoff, lag, cut::DOUBLE AS cut, a, b, c, d, (a + c) / (a + b + c + d) AS base_rate, a / nullif(a + b, 0) AS precision, a * (c + d) / nullif(c * (a + b), 0) AS risk_ratio, a * d / nullif(b * c, 0) AS odds_ratio, least(1.0, {fisher_sql()}) AS p FROM cell""")
def bt_01(s, d):
    sold = t(s, d, "lineitem").select(F.col("l_partkey").alias("entity_id"), month_pos("l_shipdate").alias("pos"), "l_quantity")
    clock = by_entity(s, d, sold).groupBy("entity_id", "pos").agg(F.sum("l_quantity").alias("value"))
    signal = backtest.signals(activity(s, d).select("entity_id", "pos", "value"), CUTOFFS, WIDTH)
    return backtest.lead_tables(signal, backtest.reached(clock, LEVEL), LAGS, CUTS, MONTHS - 1)
