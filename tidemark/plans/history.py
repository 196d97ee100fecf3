"""Queries on point-in-time reads, states, events and minutes."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import r
from tidemark.operators import asof, events, states
from tidemark.operators.placement import ranked
from tidemark.plans.base import ACTIVITY, MONTHS, SCORES, YEARLY, query, scores, scores_sql, scratch, t
from tidemark.sources import writers

CUT = "2024-01-20T00:00:00Z"
OBS = "obs AS (SELECT event_id, user_id AS entity_id, ts AS captured_at, strftime(ts, '%G-w%V') AS period, value, event_type FROM events)"


def observations(s, d):
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"), F.lit("-w"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"))
    return t(s, d, "events").select("event_id", F.col("user_id").alias("entity_id"), F.col("ts").alias("captured_at"), week.alias("period"), "value", "event_type")


@query("pf_05_visible_as_of", f"WITH {OBS} SELECT entity_id, count(*) AS n FROM obs WHERE captured_at <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1")
def pf_05(s, d):
    return observations(s, d).where(asof.visible("captured_at", CUT)).groupBy("entity_id").agg(F.count("*").alias("n"))


@query("wn_02_last_capture_per_period", f"WITH {OBS} SELECT entity_id, period, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, period ORDER BY captured_at DESC, event_id DESC) AS rn FROM obs) WHERE rn = 1")
def wn_02(s, d):
    return asof.latest(observations(s, d), ["entity_id", "period"], [F.col("captured_at"), F.col("event_id")]).select("entity_id", "period", "event_id", "value")


@query("wn_03_canonical_weekly", f"WITH {OBS} SELECT period, max(captured_at::DATE)::VARCHAR AS day, arg_max(event_id, captured_at) AS event_id FROM obs GROUP BY 1")
def wn_03(s, d):
    return asof.latest(observations(s, d), ["period"], [F.col("captured_at"), F.col("event_id")]).select("period", F.date_format("captured_at", "yyyy-MM-dd").alias("day"), "event_id")


@query("wn_05_distinct_periods", f"WITH {OBS} SELECT entity_id, count(*) AS periods, count(*) FILTER (WHERE n > 1) AS duplicates FROM (SELECT entity_id, period, count(*) AS n FROM obs GROUP BY 1, 2) GROUP BY 1")
def wn_05(s, d):
    return asof.distinct_periods(observations(s, d))


@query("jn_06_newest_not_after", f"WITH {OBS} SELECT entity_id, event_id FROM obs WHERE captured_at::DATE = (SELECT max(captured_at::DATE) FROM obs WHERE captured_at::DATE <= DATE '2024-01-19')")
def jn_06(s, d):
    return asof.newest_not_after(observations(s, d).withColumn("day", F.to_date("captured_at")), "2024-01-19", "day").select("entity_id", "event_id")


@query("jn_06_asof_join", f"""WITH {OBS} SELECT p.event_id, e.captured_at::VARCHAR[:19] AS seen_at, e.value AS seen FROM (SELECT * FROM obs WHERE event_type = 'purchase') p
 ASOF LEFT JOIN (SELECT entity_id, captured_at, value FROM obs WHERE event_type = 'view') e ON p.entity_id = e.entity_id AND p.captured_at >= e.captured_at""".replace("e.captured_at::VARCHAR[:19]", "strftime(e.captured_at, '%Y-%m-%d %H:%M:%S')"))
def jn_06b(s, d):
    o = observations(s, d)
    views = o.where("event_type = 'view'").select("entity_id", F.col("captured_at").alias("seen_at"), F.col("value").alias("seen"))
    got = asof.asof_join(o.where("event_type = 'purchase'").select("entity_id", "event_id", "captured_at"), views, ["entity_id"], "captured_at", "seen_at", ["seen"])
    return got.select("event_id", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss").alias("seen_at"), "seen")


@query("jn_07_primary_or_fallback", f"""WITH {OBS} SELECT entity_id, event_id, source FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY p DESC, captured_at DESC, event_id DESC) AS rn FROM
 (SELECT *, 1 AS p, 'primary' AS source FROM obs WHERE captured_at::DATE = DATE '2024-01-20' UNION ALL SELECT *, 0, 'fallback' FROM obs WHERE captured_at::DATE < DATE '2024-01-20')) WHERE rn = 1""")
def jn_07(s, d):
    o = observations(s, d).withColumn("day", F.to_date("captured_at"))
    return asof.primary_or_fallback(o.where("day = DATE'2024-01-20'"), o.where("day < DATE'2024-01-20'"), "entity_id", [F.col("captured_at"), F.col("event_id")]).select("entity_id", "event_id", "source")


@query("jn_08_asof_per_period", f"WITH {OBS} SELECT period, strftime(max(captured_at), '%Y-%m-%d %H:%M:%S') AS captured_at FROM obs WHERE captured_at <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1")
def jn_08(s, d):
    return observations(s, d).where(asof.visible("captured_at", CUT)).groupBy("period").agg(F.date_format(F.max("captured_at"), "yyyy-MM-dd HH:mm:ss").alias("captured_at"))


@query("ag_15_entity_universe", f"WITH {OBS}, u AS (SELECT entity_id, min(period) AS first_seen, max(period) AS last_seen FROM obs GROUP BY 1) SELECT *, CASE WHEN last_seen = (SELECT max(period) FROM obs) THEN 'current' ELSE 'superseded' END AS state FROM u")
def ag_15(s, d):
    return asof.universe(observations(s, d), "entity_id", "period", "event_id").drop("latest")


@query("ag_28_capture_health", "SELECT user_id AS entity_id, count(*) AS rows, round(avg((event_type = 'error')::INT), 6) AS error_rate, avg((event_type = 'error')::INT) > 0.2 AS degraded FROM events GROUP BY 1")
def ag_28(s, d):
    o = observations(s, d)
    return states.capture_health(o, ["entity_id"], F.col("event_type") == "error").withColumn("error_rate", r("error_rate"))


@query("cl_18_freshness", "SELECT user_id AS entity_id, CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-01-31') / 3600.0 <= 24 THEN 'ok' WHEN date_diff('second', max(ts), TIMESTAMP '2024-01-31') / 3600.0 <= 48 THEN 'publishing' ELSE 'stale' END AS state FROM events GROUP BY 1")
def cl_18(s, d):
    return observations(s, d).groupBy("entity_id").agg(F.max("captured_at").alias("m")).select("entity_id", states.freshness(F.col("m"), "2024-01-31T00:00:00Z", 24, 24).alias("state"))


@query("cl_17_coverage_class", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'fetch_error' WHEN event_type = 'signup' AND value >= 100 THEN 'pin_broken' WHEN event_type = 'signup' AND value < 50 THEN 'version_pending' WHEN value >= 20 AND NOT (event_type = 'signup' AND value >= 100) THEN 'matched' ELSE 'no_package_match' END AS coverage FROM events")
def cl_17(s, d):
    pinned = F.col("event_type") == "signup"
    level = F.when(F.col("event_type") == "error", 500).when(pinned & (F.col("value") >= 100), 404).otherwise(200)
    version = F.when(F.col("value") >= 50, "1")
    return observations(s, d).select("event_id", states.dependents_coverage(level, F.col("value") >= 20, pinned, version).alias("coverage"))


@query("cl_11_reject_reason", f"WITH {OBS} SELECT CASE WHEN event_type = 'error' THEN 'wrong_version' WHEN captured_at > TIMESTAMP '2024-01-20 00:00:00' THEN 'after_cutoff' WHEN captured_at IS DISTINCT FROM (SELECT max(captured_at) FROM obs x WHERE x.period = obs.period) THEN 'not_canonical' END AS reason, count(*) AS n FROM obs GROUP BY 1")
def cl_11(s, d):
    o = observations(s, d)
    canonical = o.groupBy("period").agg(F.max("captured_at").cast("string").alias("captured_at"))
    h = o.select(F.when(F.col("event_type") == "error", "ts_0").otherwise("ts_1").alias("v"), "entity_id", "period", F.col("captured_at").cast("string").alias("captured_at"), F.lit(None).cast("string").alias("corrupt"))
    return states.reject_reason(h, "ts_1", CUT, canonical).groupBy("reason").agg(F.count("*").alias("n"))


BOTH = "WITH " + ACTIVITY + ", " + YEARLY + ", " + scores_sql() + ", " + scores_sql(70, 2000, "_p")


def st_sql(x: str, n: int) -> str:
    return f"""st{x} AS (SELECT *, {n} AS observations, CASE WHEN axis1_slope IS NULL THEN 'no_data' WHEN axis1_z IS NULL THEN 'insufficient_source_coverage' ELSE 'measurable' END AS coverage1,
 CASE WHEN axis2_status = 'absent' THEN 'source_not_measured' WHEN axis2_status = 'insufficient' THEN 'insufficient_source_coverage' WHEN axis2_z IS NULL THEN 'insufficient_source_coverage' ELSE 'measurable' END AS coverage2 FROM scores{x}),
 state{x} AS (SELECT *, CASE WHEN observations < 4 THEN 'insufficient' ELSE 'sufficient' END AS history, CASE WHEN observations < 4 THEN 'awaiting_observations' WHEN coverage1 <> 'measurable' OR coverage2 <> 'measurable' THEN 'awaiting_axis_coverage'
 WHEN incumbent THEN 'reference_measurement' WHEN cohort_n < 5 THEN 'awaiting_cohort_floor' ELSE 'eligible' END AS gate FROM st{x})"""


def state(s, d, last=MONTHS - 1, year=2001, n=6):
    weeks = n if isinstance(n, Column) else F.lit(n)
    return states.measurement_state(scores(s, d, last, year).withColumn("observations", weeks))


@query("cl_07_measurement_state", SCORES + ", " + st_sql("", 6) + " SELECT entity_id, coverage1, coverage2, history, gate, CASE WHEN rising AND gate = 'eligible' THEN 'published' ELSE 'not_published' END AS signal FROM state")
def cl_07(s, d):
    return state(s, d).select("entity_id", "coverage1", "coverage2", "history", "gate", "signal")


WEEKS = "(2 + entity_id % 5)"
PHRASES = f"""SELECT entity_id, CASE WHEN observations >= 4 THEN 'History: ' || observations || ' weekly observations; minimum 4.' ELSE 'History: ' || observations || ' of 4 weekly observations.' END AS history,
 'Development velocity ' || CASE coverage1 WHEN 'measurable' THEN 'axis: measured.' WHEN 'insufficient_source_coverage' THEN 'axis: insufficient source coverage (cohort comparison unavailable).' ELSE 'axis: no observation data.' END AS axis1,
 'Citation ' || CASE coverage2 WHEN 'measurable' THEN 'axis: measured.' WHEN 'insufficient_source_coverage' THEN 'axis: insufficient source coverage (' || why2 || ').' WHEN 'source_not_measured' THEN 'source: not measured.' ELSE 'axis: no observation data.' END AS axis2,
 'Axis coverage: ' || axes || '.' AS axis_coverage, gate_phrase, CASE WHEN published THEN 'Rising signal published for 2001-w48.' ELSE gate_phrase END AS signal_phrase, CASE WHEN published THEN 'Rising' ELSE axes END AS compact
 FROM (SELECT *, m || CASE WHEN m = 1 THEN ' measurable axis' ELSE ' measurable axes' END AS axes, CASE WHEN published THEN 'Convergence gate: evaluated weekly; Rising signal published for 2001-w48.'
   WHEN gate = 'awaiting_observations' THEN 'Gate: not computable — history ' || observations || ' of 4 weekly observations'
   WHEN gate = 'awaiting_axis_coverage' THEN 'Gate: not computable — ' || m || ' of 2 axes measurable' || CASE WHEN m = 1 AND coverage1 <> 'measurable' THEN CASE coverage1 WHEN 'no_data' THEN ' (missing)' ELSE ' (cohort comparison unavailable)' END
     WHEN m = 1 THEN CASE coverage2 WHEN 'source_not_measured' THEN ' (unmeasured)' WHEN 'no_data' THEN ' (missing)' ELSE ' (' || why2 || ')' END ELSE '' END
   WHEN gate = 'reference_measurement' THEN 'Gate: not computable — reference measurement' WHEN gate = 'awaiting_cohort_floor' THEN 'Gate: not computable — cohort below comparison floor'
   ELSE 'Gate: computed weekly across the cohort; no convergence event this week' END AS gate_phrase
  FROM (SELECT *, (coverage1 = 'measurable')::INT + (coverage2 = 'measurable')::INT AS m, rising AND gate = 'eligible' AS published,
    CASE WHEN axis2_status = 'insufficient' THEN 'source returned too few observations' ELSE 'cohort comparison unavailable' END AS why2 FROM state))"""


@query("cl_08_phrases", SCORES + ", " + st_sql("", WEEKS) + " " + PHRASES)
def cl_08(s, d):
    """Two to six weekly observations by entity."""
    return states.phrases(state(s, d, n=2 + F.col("entity_id") % 5), F.lit("2001-w48"))


@query("cl_18_feed_age", """WITH f AS (SELECT user_id AS feed, user_id % 7 > 0 AS reached, CASE WHEN user_id % 5 = 0 THEN 503 ELSE 200 END AS status, CASE WHEN user_id % 11 > 0 THEN max(ts) - INTERVAL 1 DAY * (user_id % 13) END AS latest FROM events GROUP BY 1),
 a AS (SELECT *, date_diff('microsecond', latest, TIMESTAMP '2024-01-30 12:00:00') / 86400000000.0 AS age FROM f)
 SELECT feed, CASE WHEN NOT reached THEN 'unknown' WHEN status <> 200 OR latest IS NULL OR age > 8 THEN 'stale' ELSE 'ok' END AS state, reached AND (status <> 200 OR latest IS NULL OR age > 8) AS alert,
  CASE WHEN reached AND status = 200 AND latest IS NOT NULL THEN greatest(0, floor(age))::BIGINT END AS age_days FROM a""")
def cl_18b(s, d):
    """Feeds of which some are not reached, fail, have no readable time, or are ahead of the clock."""
    latest = observations(s, d).groupBy(F.col("entity_id").alias("feed")).agg(F.max("captured_at").alias("latest"))
    k = F.col("feed")
    at = F.when(k % 11 > 0, F.col("latest").cast("timestamp") - F.make_dt_interval((k % 13).cast("int")))
    got = states.feed_freshness(k % 7 > 0, F.when(k % 5 == 0, 503).otherwise(200), at, F.to_timestamp(F.lit("2024-01-30 12:00:00")))
    return latest.select("feed", got.alias("f")).select("feed", "f.*")


@query("cl_19_rising_floor", SCORES + " SELECT entity_id, CASE WHEN cohort < 'Brand#2' THEN 1.0 ELSE 1.5 END::DOUBLE AS rising_z FROM scores")
def cl_19(s, d):
    m = s.createDataFrame([("m1", 1.0), ("m2", 1.5)], "version string, rising_z double")
    rows = scores(s, d).withColumn("version", F.when(F.col("cohort") < "Brand#2", "m1").otherwise("m2"))
    return states.rising_floor(rows, m).select("entity_id", "rising_z")


def stored(x, name):
    """Snapshots are stored tables; comparing two reads each several times."""
    path = scratch(x.sparkSession, name)
    x.select("entity_id", *events.STATE).write.parquet(path)
    return x.sparkSession.read.parquet(path)


def snaps(s, d):
    return state(s, d, 70, 2000, 3), state(s, d)


EVENTS = st_sql("", 6) + ", " + st_sql("_p", 3) + """, j AS (SELECT c.entity_id, c.cohort, c.incumbent, c.rising, p.rising AS prising, c.coverage1, c.coverage2, p.coverage1 AS pc1, p.coverage2 AS pc2, c.gate, p.gate AS pgate, c.history, p.history AS phistory,
 c.up1, c.up2, p.up1 AS pup1, p.up2 AS pup2 FROM state c JOIN state_p p USING (entity_id)),
 ev AS (SELECT entity_id, cohort, 'axis_available' AS event_kind, 'axis1' AS detail FROM j WHERE pc1 <> 'measurable' AND coverage1 = 'measurable'
 UNION ALL SELECT entity_id, cohort, 'axis_available', 'axis2' FROM j WHERE pc2 <> 'measurable' AND coverage2 = 'measurable'
 UNION ALL SELECT entity_id, cohort, 'history_sufficient', NULL FROM j WHERE phistory <> 'sufficient' AND history = 'sufficient'
 UNION ALL SELECT entity_id, cohort, 'gate_eligible', NULL FROM j WHERE pgate <> 'eligible' AND gate = 'eligible'
 UNION ALL SELECT entity_id, cohort, 'axis_threshold_recorded', 'axis1' FROM j WHERE up1 AND NOT pup1 UNION ALL SELECT entity_id, cohort, 'axis_threshold_recorded', 'axis2' FROM j WHERE up2 AND NOT pup2
 UNION ALL SELECT entity_id, cohort, 'axis_threshold_lost', 'axis1' FROM j WHERE NOT up1 AND pup1 UNION ALL SELECT entity_id, cohort, 'axis_threshold_lost', 'axis2' FROM j WHERE NOT up2 AND pup2
 UNION ALL SELECT entity_id, cohort, 'convergence_published', NULL FROM j WHERE rising AND gate = 'eligible' AND NOT (prising AND pgate = 'eligible'))"""


@query("jn_05_snapshot_pair", BOTH + " SELECT coalesce(p.entity_id, c.entity_id) AS entity_id, p.status AS was, c.status AS now FROM scores_p p FULL OUTER JOIN scores c USING (entity_id)")
def jn_05(s, d):
    a, b = scores(s, d, 70, 2000), scores(s, d)
    return a.select("entity_id", F.col("status").alias("was")).join(b.select("entity_id", F.col("status").alias("now")), "entity_id", "full_outer")


@query("cl_09_diff_events", BOTH + ", " + EVENTS + " SELECT * FROM ev")
def cl_09(s, d):
    return events.diff_events(*(stored(x, f"snapshot-{k}") for k, x in enumerate(snaps(s, d))))


RANKS = f"CASE event_kind {' '.join(f"WHEN '{k}' THEN {v}" for k, v in events.PRIORITY.items())} ELSE 1000000 END"
MINUTES = EVENTS + f""", cover AS (SELECT cohort, coalesce(pn, 0) AS pn, coalesce(cn, 0) AS cn, pr, cr FROM (SELECT cohort, count(*) AS pn, avg((coverage1 = 'measurable' AND coverage2 = 'measurable')::INT) AS pr FROM state_p GROUP BY 1)
  FULL OUTER JOIN (SELECT cohort, count(*) AS cn, avg((coverage1 = 'measurable' AND coverage2 = 'measurable')::INT) AS cr FROM state GROUP BY 1) USING (cohort)),
 news AS (SELECT cohort, event_kind, entity_id, array_to_string(list_transform(string_split(event_kind, '_'), lambda x: upper(x[1]) || x[2:]), ' ') || ' for ' || entity_id || '.' AS text FROM ev WHERE event_kind IN {events.NEWSWORTHY}
  UNION ALL SELECT cohort, 'cohort_added', NULL, 'Cohort added with ' || cn || ' members.' FROM cover WHERE pn = 0 AND cn > 0
  UNION ALL SELECT cohort, 'coverage_changed', NULL, format('Two-axis coverage changed from {{:.1f}}% to {{:.1f}}%.', pr * 100, cr * 100) FROM cover WHERE pn > 0 AND cn > 0 AND abs(cr - pr) > 0.05),
 minutes AS (SELECT * FROM news UNION ALL SELECT cohort, 'quiet_week', NULL, 'No changes this week.' FROM cover WHERE cn > 0 AND cohort NOT IN (SELECT cohort FROM news))
 SELECT cohort, event_kind, entity_id, text FROM (SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY {RANKS}, event_kind, entity_id NULLS FIRST) AS rn FROM minutes) WHERE rn <= 50"""


@query("cl_10_cohort_minutes", BOTH + ", " + MINUTES)
def cl_10(s, d):
    a, b = (stored(x, f"snapshot-{k}") for k, x in enumerate(snaps(s, d)))
    return events.minutes(a, b, events.diff_events(a, b))


@query("tk_05_priority_cap", BOTH + ", " + EVENTS + f" SELECT cohort, event_kind, entity_id FROM (SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY CASE event_kind {' '.join(f"WHEN '{k}' THEN {v}" for k, v in events.PRIORITY.items())} ELSE 1000000 END, event_kind, entity_id NULLS FIRST) AS rn FROM (SELECT DISTINCT cohort, event_kind, entity_id FROM ev)) WHERE rn <= 5")
def tk_05(s, d):
    e = events.diff_events(*(stored(x, f"snapshot-{k}") for k, x in enumerate(snaps(s, d))))
    return events.capped(e.select("cohort", "event_kind", "entity_id").distinct(), 5)


@query("so_05_thresholds_crossed", BOTH + " SELECT c.entity_id, (CASE WHEN c.up1 AND NOT p.up1 THEN 'axis1' ELSE '' END || CASE WHEN c.up2 AND NOT p.up2 THEN 'axis2' ELSE '' END) AS recorded, (CASE WHEN p.up1 AND NOT c.up1 THEN 'axis1' ELSE '' END || CASE WHEN p.up2 AND NOT c.up2 THEN 'axis2' ELSE '' END) AS lost FROM scores c JOIN scores_p p USING (entity_id)")
def so_05(s, d):
    x = events.crossed(scores(s, d, 70, 2000), scores(s, d))
    return x.select("entity_id", F.array_join("recorded", "").alias("recorded"), F.array_join("lost", "").alias("lost"))


@query("so_07_cohort_keys", "SELECT DISTINCT p_brand AS cohort FROM part")
def so_07(s, d):
    from tidemark.plans.base import registry

    return events.cohort_keys(scores(s, d), registry(s, d))


@query("sf_15_event_ids", BOTH + ", " + EVENTS + """ SELECT entity_id, event_kind, substr(sha256('{"day":"2001-11-30","event_kind":"' || event_kind || '","entity_id":"' || entity_id || '","detail":"' || coalesce(detail, '') || '"}'), 1, 16) AS id FROM ev""")
def sf_15(s, d):
    return events.event_id(events.diff_events(*(stored(x, f"snapshot-{k}") for k, x in enumerate(snaps(s, d)))), "2001-11-30").select("entity_id", "event_kind", "id")


@query("sk_06_feed_items", BOTH + ", " + EVENTS + """ SELECT substr(sha256('{"day":"2001-11-30","event_kind":"' || event_kind || '","entity_id":"' || entity_id || '","detail":"' || coalesce(detail, '') || '"}'), 1, 16) AS id,
 CASE WHEN event_kind = 'convergence_published' THEN 'moment_signal' ELSE 'observation' END AS type, event_kind, array_to_string(list_transform(string_split(event_kind, '_'), lambda x: upper(x[1]) || x[2:]), ' ') AS title, '2001-11-30' AS date_published, entity_id::VARCHAR AS entity_ids FROM ev""")
def sk_06(s, d):
    """Written as the feed's JSON lines and read back."""
    path = scratch(s, "feed")
    writers.feed_json(events.feed_items(events.diff_events(*(stored(x, f"snapshot-{k}") for k, x in enumerate(snaps(s, d)))), "2001-11-30"), path)
    got = s.read.schema("id string, type string, event_kind string, title string, date_published string, entity_ids array<string>").json(path)
    return got.select("id", "type", "event_kind", "title", "date_published", F.concat_ws(",", "entity_ids").alias("entity_ids"))


@query("tk_06_top_k_per_group", SCORES + " SELECT cohort, entity_id, momentum FROM (SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY momentum DESC NULLS LAST, entity_id) AS rn FROM scores) WHERE rn <= 3")
def tk_06(s, d):
    w = Window.partitionBy("cohort").orderBy(F.col("momentum").desc_nulls_last(), "entity_id")
    return scores(s, d).withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("cohort", "entity_id", "momentum")


@query("tk_07_status_report", SCORES + " SELECT status, entity_id, coalesce(momentum, 0) AS momentum, row_number() OVER (PARTITION BY status ORDER BY coalesce(momentum, 0) DESC, entity_id) AS place FROM scores")
def tk_07(s, d):
    m = F.coalesce("momentum", F.lit(0.0))
    return ranked(scores(s, d).select("status", "entity_id", m.alias("momentum")), ["status"], [F.desc("momentum"), "entity_id"]).withColumn("place", F.col("place") + 1)
