"""Queries on dependents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.stats import r
from tidemark.operators import dependents as dp
from tidemark.operators import sketches
from tidemark.plans.base import dealt, query, scratch, t
from tidemark.sources import facts as store

AT, CUT = "1998-06-01", "2000-01-01"
FACTS = """facts AS (SELECT date_trunc('month', o_orderdate)::DATE AS snapshot, l_partkey AS package, o_custkey AS dependent, c_mktsegment AS dep_system, l_linenumber = 1 AS direct
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey), panel AS (SELECT p_brand AS entity, p_partkey AS package FROM part),
 rows AS (SELECT * FROM facts JOIN panel USING (package))"""
FP = "('0x' || substr(sha256(dependent::VARCHAR), 1, 15))::BIGINT"


def facts(s, d):
    """Lines with their order and its customer; lines and orders are dealt by order, so a task's rows do not grow with the tables."""
    line, n = t(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), lines(s, d)
    cust = t(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = t(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate").join(cust, "o_custkey")
    return dealt(line, n, "l_orderkey").join(dealt(orders, n, "l_orderkey"), "l_orderkey").select(
        F.trunc("o_orderdate", "month").alias("snapshot"), F.col("l_partkey").alias("package"), F.col("o_custkey").alias("dependent"),
        F.col("c_mktsegment").alias("dep_system"), (F.col("l_linenumber") == 1).alias("direct"),
    )


def lines(s, d):
    return t(s, d, "lineitem").count()


def panel(s, d):
    return t(s, d, "part").select(F.col("p_brand").alias("entity"), F.col("p_partkey").alias("package"))


def rows(s, d):
    return dp.on_panel(facts(s, d), panel(s, d))


FACT_SCHEMA = "system string, package long, dependent struct<system:string,id:long>, depth int, snapshot date"


def fact_store(s, d):
    """The facts of all months, written once by snapshot with the dependent as a struct."""
    path = scratch(s, "facts")
    store.write_facts(facts(s, d).select(F.lit("own").alias("system"), "package", F.struct(F.col("dep_system").alias("system"), F.col("dependent").alias("id")).alias("dependent"), F.when(F.col("direct"), 1).otherwise(2).alias("depth"), "snapshot"), path)
    return path


@query("sc_09_day_partition_scan", f"WITH {FACTS} SELECT dep_system, count(*) AS n FROM facts WHERE snapshot = DATE '{AT}' GROUP BY 1")
def sc_09(s, d):
    rows = store.read_facts(s, fact_store(s, d), FACT_SCHEMA)
    return store.at(rows, [AT]).groupBy(F.col("dependent.system").alias("dep_system")).agg(F.count("*").alias("n"))


@query("sc_09_calendar_scan", f"WITH {FACTS} SELECT snapshot, package, count(DISTINCT dependent) FILTER (WHERE direct) AS direct_dependents, count(DISTINCT dependent) AS all_dependents FROM facts WHERE month(snapshot) = 3 AND snapshot < DATE '{CUT}' GROUP BY 1, 2")
def sc_09b(s, d):
    """The calendar's quarter-end months choose the partitions at run time."""
    path = fact_store(s, d)
    months = s.createDataFrame([(x,) for x in store.partitions(s, path)], "day string").select(F.col("day").cast("date").alias("snapshot")).where(f"month(snapshot) = 3 AND snapshot < DATE '{CUT}'")
    rows = store.of_calendar(store.read_facts(s, path, FACT_SCHEMA), months)
    once = rows.groupBy("snapshot", "package", F.col("dependent.id").alias("dependent")).agg(F.min("depth").alias("depth"))
    return once.groupBy("snapshot", "package").agg(F.count_if(F.col("depth") == 1).alias("direct_dependents"), F.count("dependent").alias("all_dependents"))


@query("sc_10_partition_listing", f"WITH {FACTS} SELECT DISTINCT snapshot FROM facts WHERE snapshot < DATE '{CUT}' ORDER BY 1 DESC LIMIT 5")
def sc_10(s, d):
    return s.createDataFrame([(x,) for x in store.newest(s, fact_store(s, d), CUT, 5)], "day string").select(F.col("day").cast("date").alias("snapshot"))


@query("sc_11_narrow_slice", "SELECT p_partkey, lower(p_name) AS name FROM part WHERE lower(p_brand) IN ('brand#11', 'brand#12')")
def sc_11(s, d):
    wanted = s.createDataFrame([("BRAND#11",), ("Brand#12",)], "k string").select(F.lower("k").alias("k"))
    part = t(s, d, "part").select("p_partkey", F.lower("p_name").alias("name"), F.lower("p_brand").alias("k"))
    return part.join(F.broadcast(wanted), "k", "left_semi").select("p_partkey", "name")


COUNTS = """counts AS (SELECT entity, CASE WHEN grouping(package) = 1 THEN '__SYSTEM__' ELSE package::VARCHAR END AS package, count(DISTINCT dependent) FILTER (WHERE direct) AS direct_dependents,
 count(DISTINCT dependent) AS all_dependents, count(DISTINCT package) AS packages_present FROM rows GROUP BY GROUPING SETS ((entity), (entity, package)))"""


@query("ag_04_distinct_dependents", f"WITH {FACTS} SELECT entity, count(DISTINCT CASE WHEN direct THEN dependent END) AS direct_dependents, count(DISTINCT dependent) AS all_dependents FROM rows GROUP BY 1")
def ag_04(s, d):
    return dp.distinct_counts(rows(s, d)).where(F.col("package") == dp.WHOLE).select("entity", "direct_dependents", "all_dependents")


@query("ag_05_grouping_sets", f"WITH {FACTS}, {COUNTS} SELECT entity, package, direct_dependents, all_dependents FROM counts")
def ag_05(s, d):
    return dp.distinct_counts(rows(s, d)).select("entity", "package", "direct_dependents", "all_dependents")


@query("ag_06_xor_fingerprint", f"WITH {FACTS} SELECT entity, bit_xor({FP}) AS xor_fp FROM (SELECT DISTINCT entity, dependent FROM rows) GROUP BY 1")
def ag_06(s, d):
    return dp.xor_fingerprint(rows(s, d))


@query("ag_06_xor_fingerprint_rows", f"WITH {FACTS} SELECT entity, bit_xor({FP}) AS xor_fp FROM rows GROUP BY 1")
def ag_06b(s, d):
    return dp.xor_fingerprint(rows(s, d), distinct=False)


@query("ag_07_bottom_k_sketch", f"WITH {FACTS} SELECT entity, array_to_string(list(fp ORDER BY fp), ',') AS sketch FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY fp) AS rn FROM (SELECT DISTINCT entity, {FP} AS fp FROM rows)) WHERE rn <= 64 GROUP BY 1")
def ag_07(s, d):
    return dp.bottom_k(rows(s, d)).select("entity", F.concat_ws(",", F.col("sketch").cast("array<string>")).alias("sketch"))


@query("ag_08_sketch_jaccard", f"""WITH {FACTS}, k AS (SELECT entity, half, fp FROM (SELECT *, row_number() OVER (PARTITION BY entity, half ORDER BY fp) AS rn FROM (SELECT DISTINCT entity, snapshot < DATE '{AT}' AS half, {FP} AS fp FROM rows)) WHERE rn <= 64),
 u AS (SELECT entity, fp, count(*) AS nb, row_number() OVER (PARTITION BY entity ORDER BY fp) AS rn FROM k GROUP BY 1, 2)
 SELECT entity, round(count(*) FILTER (WHERE nb = 2) / count(*), 6) AS jaccard FROM u WHERE rn <= 64 AND entity IN (SELECT entity FROM k WHERE half) AND entity IN (SELECT entity FROM k WHERE NOT half) GROUP BY 1""")
def ag_08(s, d):
    x = rows(s, d)
    a, b = dp.bottom_k(x.where(F.col("snapshot") < AT)), dp.bottom_k(x.where(F.col("snapshot") >= AT))
    return dp.sketch_jaccard(a, b).withColumn("jaccard", r("jaccard"))


@query("ag_09_heavy_hitters", f"WITH {FACTS} SELECT entity, dep_system, n, rank FROM (SELECT entity, dep_system, count(*) AS n, row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, dep_system) AS rank FROM rows GROUP BY 1, 2) WHERE rank <= 3")
def ag_09(s, d):
    return dp.heavy_hitters(rows(s, d), "entity", "dep_system", 3)


@query("ag_09_heavy_hitters_approx", f"WITH {FACTS} SELECT entity, string_agg(n::VARCHAR, ',' ORDER BY n DESC) AS counts FROM (SELECT entity, count(*) AS n, row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC) AS rank FROM rows GROUP BY entity, dep_system) WHERE rank <= 3 GROUP BY 1")
def ag_09b(s, d):
    """With fewer values than the sketch has places the sketch counts exactly."""
    return dp.heavy_hitters_approx(rows(s, d), "entity", "dep_system", 3).select("entity", F.array_join(F.reverse(F.array_sort(F.transform("top", lambda x: x["count"].cast("long")))).cast("array<string>"), ",").alias("counts"))


@query("ag_07_merged_sketches", f"WITH {FACTS} SELECT entity, array_to_string(list(fp ORDER BY fp), ',') AS sketch FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY fp) AS rn FROM (SELECT DISTINCT entity, {FP} AS fp FROM rows WHERE snapshot >= DATE '{AT}')) WHERE rn <= 64 GROUP BY 1")
def ag_07b(s, d):
    """States of the months up to a year, then of the later ones, each month's rows read once; merged over the months since a day."""
    path, every = scratch(s, "bottoms"), rows(s, d)
    for part in (every.where(F.col("snapshot") < CUT), every):
        sketches.refresh(part, path, "snapshot", lambda x: sketches.bottoms(x, ["snapshot", "entity"], "dependent"))
    states = s.read.schema("entity string, fp long, snapshot date").parquet(path).where(F.col("snapshot") >= AT)
    return sketches.merged_bottoms(states, ["entity"]).select("entity", F.concat_ws(",", F.col("sketch").cast("array<string>")).alias("sketch"))


@query("ag_09_merged_hitters", f"""WITH {FACTS}, v AS (SELECT entity, CASE WHEN package % 2 = 0 THEN dependent % 3 ELSE dependent END AS value FROM rows)
 SELECT entity, count(*) AS rows, (SELECT count(*) FROM (SELECT value FROM v w WHERE w.entity = v.entity GROUP BY 1 HAVING count(*) > 2 * 3.5 / 64 * (SELECT count(*) FROM v u WHERE u.entity = v.entity))) AS heavy, true AS within FROM v GROUP BY 1""")
def ag_09c(s, d):
    """Many more values than places: every estimate is within the stated error, and no value above twice the error is missed."""
    path = scratch(s, "hitters")
    value = F.when(F.col("package") % 2 == 0, F.col("dependent") % 3).otherwise(F.col("dependent"))
    x = rows(s, d).select("snapshot", "entity", value.alias("value"))
    sketches.add_states(sketches.hitter_states(x, ["snapshot", "entity"], "value", 64), path, "snapshot")
    top = sketches.merged_hitters(s.read.parquet(path), ["entity"], 48, 64)
    true = x.groupBy("entity", "value").agg(F.count("*").alias("true"))
    j = top.join(true, ["entity", "value"])
    return j.groupBy("entity", "rows").agg(F.count_if(F.col("true") > 2 * F.col("error")).alias("heavy"), F.bool_and(F.abs(F.col("n") - F.col("true")) <= F.col("error")).alias("within"))


@query("ag_10_any_value", f"WITH {FACTS} SELECT package, min(entity) AS entity, strftime(min(snapshot), '%Y-%m-%d') AS first_seen FROM rows GROUP BY 1")
def ag_10(s, d):
    """A package belongs to one entity, so any of its rows tells which."""
    return rows(s, d).groupBy("package").agg(F.any_value("entity").alias("entity"), F.date_format(F.min("snapshot"), "yyyy-MM-dd").alias("first_seen"))


@query("ag_11_multi_key_count", f"WITH {FACTS} SELECT entity, package, dep_system, direct, count(*) AS n FROM rows GROUP BY ALL")
def ag_11(s, d):
    """Facts are dealt by package, so their groups are counted in place."""
    return dp.on_panel(dealt(facts(s, d), lines(s, d), "package"), panel(s, d)).groupBy("entity", "package", "dep_system", "direct").agg(F.count("*").alias("n"))


@query("ag_12_retention_tripwire", f"WITH {FACTS} SELECT min(snapshot) AS oldest, max(snapshot) AS newest, count(DISTINCT snapshot) AS partitions, count(*) AS total_rows FROM facts")
def ag_12(s, d):
    return dp.retention_tripwire(facts(s, d))


@query("jn_02_coverage", f"WITH {FACTS}, w AS (SELECT entity, count(DISTINCT dependent) AS n FROM rows WHERE snapshot = DATE '{AT}' GROUP BY 1) SELECT DISTINCT p.entity, n AS all_dependents, CASE WHEN n IS NULL THEN 'not_in_snapshot' ELSE 'matched' END AS coverage FROM panel p LEFT JOIN w USING (entity)")
def jn_02(s, d):
    got = dp.coverage(panel(s, d), dp.distinct_counts(rows(s, d).where(F.col("snapshot") == F.lit(AT))))
    return got.select("entity", "all_dependents", "coverage")


@query("jn_09_without_own", f"WITH {FACTS} SELECT entity, count(DISTINCT dependent) AS n FROM rows WHERE dependent NOT IN (SELECT package FROM panel WHERE entity = 'Brand#11') GROUP BY 1")
def jn_09(s, d):
    own = panel(s, d).where("entity = 'Brand#11'").select(F.col("package").alias("dependent"))
    return dp.without_own(rows(s, d), own).groupBy("entity").agg(F.countDistinct("dependent").alias("n"))


@query("jn_10_package_map", f"WITH {FACTS} SELECT entity, count(*) AS n FROM rows GROUP BY 1")
def jn_10(s, d):
    return rows(s, d).groupBy("entity").agg(F.count("*").alias("n"))


@query("so_01_panel_union", "SELECT p_brand AS entity, p_partkey AS package FROM part WHERE p_size < 30 UNION SELECT p_brand, p_partkey FROM part WHERE p_size > 20")
def so_01(s, d):
    p = t(s, d, "part")
    pick = lambda c: p.where(c).select(F.col("p_brand").alias("entity"), F.col("p_partkey").alias("package"))
    return dp.panel_union(pick("p_size < 30"), pick("p_size > 20"))


@query("dq_10_canary", f"WITH {FACTS} SELECT count(DISTINCT entity) AS canaries_seen, count(DISTINCT entity) > 0 AS ok FROM rows WHERE entity IN ('Brand#11', 'Brand#99')")
def dq_10(s, d):
    return dp.canary_present(rows(s, d), ["Brand#11", "Brand#99"])
