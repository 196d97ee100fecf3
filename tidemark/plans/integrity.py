"""Queries on identity, quality gates, privacy, text scans, sources, sinks and streams."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from tidemark.functions import scalars as sc
from tidemark.functions.stats import r
from tidemark.operators import identity as idn
from tidemark.operators import privacy as pv
from tidemark.operators import quality as ql
from tidemark.operators.asof import latest
from tidemark.plans.base import SCORES, query, registry, scores, scratch, t
from tidemark.plans.history import CUT, OBS, observations
from tidemark.sources import bundles, readers, writers
from tidemark.sources.scratch import discard, stored
from tidemark.streaming import exactly_once as once
from tidemark.streaming import observations as st
from tidemark.streaming import timers

DIGITS = sc.DIGITS32
SHA = "sha256('org/' || c_name)"
LOW = " || ".join(f"substr('{DIGITS}', ((n >> {5 * i}) & 31)::INT + 1, 1)" for i in range(10))
SUM = " + ".join(f"((n >> {5 * i}) & 31)" for i in range(10))


@query("sf_01_opaque_id", f"WITH h AS (SELECT c_custkey, ('0x' || substr({SHA.replace('c_name', 'lower(c_name)')}, 1, 16))::UBIGINT AS n FROM customer) SELECT c_custkey, 'e_' || {LOW} || substr('{DIGITS}', (({SUM}) % 32)::INT + 1, 1) AS id FROM h")
def sf_01(s, d):
    return t(s, d, "customer").select("c_custkey", sc.opaque_id(F.concat(F.lit("Org/"), "c_name")).alias("id"))


@query("sf_03_iso_period", "SELECT o_orderkey, strftime(o_orderdate, '%G-w%V') AS period FROM orders")
def sf_03(s, d):
    return t(s, d, "orders").select("o_orderkey", sc.iso_period("o_orderdate").alias("period"))


@query("sf_14_claim_names", "SELECT p_partkey, 'urn:tm:e_' || p_partkey || ':m1:2001-w48' AS claim, 'e_' || p_partkey AS accession FROM part")
def sf_14(s, d):
    x = t(s, d, "part").select("p_partkey", sc.build_claim("urn:tm", F.concat(F.lit("e_"), "p_partkey"), F.lit("m1"), F.lit("2001-w48")).alias("claim"))
    return x.select("p_partkey", "claim", sc.parse_claim("claim").getField("accession").alias("accession"))


@query("sf_16_percent_decode", "SELECT page_id, url_decode(url_decode(url)) AS url FROM pages")
def sf_16(s, d):
    return t(s, d, "pages").select("page_id", sc.fully_decoded(F.replace(F.url_encode("url"), F.lit("+"), F.lit("%20"))).alias("url"))


#: references escaped once and twice, and text without markup on every fifth page
ESCAPED = "&amp;lt;x &amp;amp;lt;y a&amp;nbsp;b &amp;#39; &LT;i&GT; &quot;q&#34; c&nbsp;&#160;d"
PAGES = f"pg AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '{ESCAPED}' ELSE html || '{ESCAPED}' END AS html FROM pages)"


def surface_sql(pages: str = PAGES) -> str:
    out = "html"
    for pattern in (r"(?is)<script\b[^>]*>.*?</script>", r"(?is)<style\b[^>]*>.*?</style>", "<[^>]+>"):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    for pattern, plain in sc.REFERENCES:
        out = f"regexp_replace({out}, '(?i){pattern}', '{plain.replace("'", "''")}', 'g')"
    return f"WITH {pages} SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<[a-z!/].*>') THEN trim(regexp_replace({out}, '\\s+', ' ', 'g')) ELSE html END AS surface FROM pg"


@query("sf_19_html_surface", surface_sql())
def sf_19(s, d):
    html = F.when(F.col("page_id") % 5 == 0, F.lit(ESCAPED)).otherwise(F.concat("html", F.lit(ESCAPED)))
    return t(s, d, "pages").select("page_id", sc.html_surface(html).alias("surface"))


@query("sf_20_json_leaves", "SELECT event_id, '$.k' AS path, json_extract_string(props, '$.k') AS value FROM events")
def sf_20(s, d):
    return pv.json_leaves(t(s, d, "events"), "event_id", "props")


@query("sf_21_formatting", SCORES + " SELECT entity_id, CASE WHEN axis1_z IS NULL THEN 'no axis' ELSE CASE WHEN axis1_z < 0 THEN '-' ELSE '+' END || format('{:.2f}', round(abs(axis1_z)::DECIMAL(18, 3), 2)::DOUBLE) END AS z FROM scores")
def sf_21(s, d):
    return scores(s, d).select("entity_id", sc.signed("axis1_z").alias("z"))


@query("sf_21_clamp_round_label", SCORES + """ SELECT entity_id, round_even(greatest(-3.0, least(3.0, axis1_slope * 40)), 3) + 0.0 AS bounded, round_even(ln(1 + greatest(size - 1000, 0)), 2) + 0.0 AS logged,
 CASE WHEN axis1_slope IS NULL THEN 'n/a' ELSE CASE WHEN round(axis1_slope, 9) < 0 THEN '-' ELSE '+' END || format('{:.3f}', round(abs(axis1_slope)::DECIMAL(18, 9), 3)::DOUBLE) END AS slope, replace(cohort, '#', ', ') AS label FROM scores""")
def sf_21b(s, d):
    """A cohort's label has a long dash with spaces around it, which is written as a comma."""
    x = scores(s, d)
    label = sc.clean_label(F.replace("cohort", F.lit("#"), F.lit(" \u2014  ")))
    return x.select("entity_id", F.bround(sc.clamped(F.col("axis1_slope") * 40, -3.0, 3.0), 3).alias("bounded"), F.bround(F.log1p(F.greatest(F.col("size") - 1000, F.lit(0.0))), 2).alias("logged"), sc.signed(F.round("axis1_slope", 9) + 0.0, 3, "n/a").alias("slope"), label.alias("label"))


DIGESTED = "sha256(concat_ws(';', {}))"


def part_sql(name: str) -> str:
    """The canonical part of a column: its name, the length of its text in bytes, and the text."""
    return f"'{name}=' || coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, 'null')"


def digest_sql(source: str, columns: list[str]) -> str:
    sums = " || ',' || ".join(f"sum(('0x' || substr(h, {1 + 16 * i}, 16))::UBIGINT::HUGEINT)::VARCHAR" for i in range(4))
    return f"SELECT sha256(count(*)::VARCHAR || ':' || {sums}) AS digest, count(*) AS rows FROM (SELECT {DIGESTED.format(', '.join(map(part_sql, sorted(columns))))} AS h FROM {source})"


@query("ag_17_table_digest", digest_sql("documents", ["doc_id", "text", "lang", "source", "n_chars"]))
def ag_17(s, d):
    return idn.table_digest(t(s, d, "documents"))


@query("ag_18_merkle_root", """WITH RECURSIVE leaf AS (SELECT row_number() OVER (ORDER BY path) - 1 AS pos, sha256('\\x00'::BLOB || encode(path) || '\\x00'::BLOB || encode(text)) AS h FROM (SELECT 'doc/' || lpad(doc_id::VARCHAR, 9, '0') AS path, text FROM documents)),
 level AS (SELECT pos, h, (SELECT count(*) FROM leaf) AS n FROM leaf UNION ALL SELECT pos // 2, CASE WHEN count(*) = 2 THEN sha256('\\x01'::BLOB || unhex(arg_min(h, pos)) || unhex(arg_max(h, pos))) ELSE min(h) END, (n + 1) // 2 FROM level WHERE n > 1 GROUP BY pos // 2, n)
 SELECT h AS root FROM level WHERE n = 1""")
def ag_18(s, d):
    leaves = idn.merkle_leaves(t(s, d, "documents").select(F.format_string("doc/%09d", "doc_id").alias("path"), F.col("text").alias("content")))
    return s.createDataFrame([(idn.merkle_root(leaves),)], "root string")


@query("ag_18_merkle_leaves", "SELECT 'doc/' || lpad(doc_id::VARCHAR, 9, '0') AS path, sha256('\\x00'::BLOB || encode('doc/' || lpad(doc_id::VARCHAR, 9, '0')) || '\\x00'::BLOB || encode(text)) AS leaf FROM documents")
def ag_18b(s, d):
    return idn.merkle_leaves(t(s, d, "documents").select(F.format_string("doc/%09d", "doc_id").alias("path"), F.col("text").alias("content")))


@query("ag_26_sweep_totals", "SELECT count(*) FILTER (WHERE n < 20) AS unresolved, sum(greatest(40 - n, 0))::BIGINT AS shortfall, sum(greatest(n - 40, 0))::BIGINT AS surplus, count(*) FILTER (WHERE abs(n - 40) > 2) AS beyond, false AS ok FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def ag_26(s, d):
    n = t(s, d, "events").groupBy("user_id").agg(F.count("*").alias("collected")).select(F.lit(40).cast("long").alias("total"), "collected", (F.col("collected") >= 20).alias("done"))
    return ql.sweep(n)


@query("ag_33_source_manifest", digest_sql("(SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)", ["source"]))
def ag_33(s, d):
    return idn.source_manifest(t(s, d, "documents"), "source")


@query("wn_06_hash_chain", "SELECT item_id, lag(sha256(text), 1, repeat('0', 64)) OVER (ORDER BY item_id) AS expected FROM benchmark")
def wn_06(s, d):
    return idn.chain(t(s, d, "benchmark"), "text", "item_id").select("item_id", "expected")


@query("wn_06_document_chain", "SELECT doc_id, lag(sha256(text), 1, repeat('0', 64)) OVER (ORDER BY doc_id) AS expected, length(text) AS chars FROM documents")
def wn_06b(s, d):
    return idn.chain(t(s, d, "documents"), "text", "doc_id").select("doc_id", "expected", F.length("text").cast("long").alias("chars"))


@query("wn_08_document_shards", "SELECT doc_id, sha256(text) AS sha, ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents")
def wn_08b(s, d):
    return idn.shards(t(s, d, "documents").select("doc_id", "text"), ["doc_id"], 7).select("doc_id", F.sha2("text", 256).alias("sha"), "shard")


@query("wn_08_shards", "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents")
def wn_08(s, d):
    return idn.shards(t(s, d, "documents").select("doc_id"), ["doc_id"], 7)


@query("wn_09_first_wins", "SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn = 1")
def wn_09(s, d):
    return idn.first_of(t(s, d, "conversations"), "conv_id", [F.col("turn")]).select("conv_id", "turn", "role")


@query("jn_01_pin_join", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def jn_01(s, d):
    return t(s, d, "customer").join(t(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


SOLD = "SELECT DISTINCT l_partkey AS entity_id FROM lineitem WHERE l_shipdate >= TIMESTAMP '{}'"


def sold(s, d, since):
    return t(s, d, "lineitem").where(F.col("l_shipdate") >= F.to_timestamp(F.lit(since))).select(F.col("l_partkey").alias("entity_id")).distinct()


@query("jn_04_missing_entities", f"SELECT p_partkey AS entity_id, p_partkey IN ({SOLD.format('2001-01-01')}) AS tracked_before FROM part WHERE p_partkey NOT IN ({SOLD.format('2001-09-01')})")
def jn_04(s, d):
    return ql.missing(registry(s, d), sold(s, d, "2001-09-01"), sold(s, d, "2001-01-01"), "entity_id")


@query("jn_11_id_collisions", "SELECT a.n_regionkey AS snapshot_id, a.n_nationkey AS day_a, b.n_nationkey AS day_b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND sha256(a.n_name) < sha256(b.n_name)")
def jn_11(s, d):
    b = t(s, d, "nation").select(F.col("n_regionkey").alias("snapshot_id"), F.col("n_nationkey").alias("day"), F.sha2("n_name", 256).alias("payload"))
    return idn.collisions(b).select("snapshot_id", "day_a", "day_b")


ORDER_BUNDLES = "b AS (SELECT DISTINCT o_custkey AS snapshot_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus AS payload FROM orders)"


@query("jn_11_errata", f"""WITH {ORDER_BUNDLES}, p AS (SELECT a.snapshot_id, a.day AS day_a, a.payload AS hash_a, b.day AS day_b, b.payload AS hash_b FROM b a JOIN b USING (snapshot_id) WHERE a.payload < b.payload)
 SELECT snapshot_id, hash_a, hash_b, min(day_a || ' ' || day_b) AS days FROM p WHERE NOT (snapshot_id % 3 < 2 AND (snapshot_id % 3 = 0 OR day_a < '1999-06-01' OR day_b < '2000-01-01')) GROUP BY 1, 2, 3""")
def jn_11b(s, d):
    """A third of the ids has errata for all pairs of days, a third for some, each written with either content first; the rest has errata of another id."""
    b = t(s, d, "orders").select(F.col("o_custkey").alias("snapshot_id"), F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderstatus").alias("payload")).distinct()
    one, two = (b.select("snapshot_id", F.col("day").alias(f"day_{x}"), F.col("payload").alias(f"hash_{x}")) for x in "ab")
    pairs = one.join(two, "snapshot_id").where("hash_a < hash_b")
    listed = pairs.where("snapshot_id % 3 = 0 OR (snapshot_id % 3 = 1 AND (day_a < '1999-06-01' OR day_b < '2000-01-01'))")
    turned = listed.where("snapshot_id % 2 = 1").select("snapshot_id", F.col("day_b").alias("day_a"), F.col("hash_b").alias("hash_a"), F.col("day_a").alias("day_b"), F.col("hash_a").alias("hash_b"))
    other = pairs.where("snapshot_id % 3 = 2").withColumn("snapshot_id", F.col("snapshot_id") + 1)
    errata = listed.where("snapshot_id % 2 = 0").unionByName(turned).unionByName(other)
    return idn.collisions(b, errata).select("snapshot_id", "hash_a", "hash_b", F.concat_ws(" ", "day_a", "day_b").alias("days"))


def taxonomy(s, d):
    """Old key: brand; new: (field = first digit, cohort)."""
    return t(s, d, "part").select(F.col("p_brand").alias("cohort")).distinct().select("cohort", F.concat(F.lit("field"), F.substring("cohort", 7, 1)).alias("field"), F.lower("cohort").alias("new"))


@query("jn_12_taxonomy_remap", "SELECT p_partkey, 'field' || substr(p_brand, 7, 1) AS field, lower(p_brand) AS cohort FROM part")
def jn_12(s, d):
    m = taxonomy(s, d).select(F.col("cohort").alias("old"), "field", "new")
    rows = t(s, d, "part").select("p_partkey", F.col("p_brand").alias("old"))
    return ql.remap(rows, m, "old", ["field", "new"]).select("p_partkey", "field", F.col("old").alias("cohort"))


@query("jn_13_cohort_tree", "SELECT r_name, count(*) AS nations, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def jn_13(s, d):
    j = t(s, d, "nation").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(F.count("*").alias("nations"), F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))


LEDGER = "SELECT o_orderkey, o_custkey AS entity_id, o_orderkey % 100 AS snapshot_id FROM orders"


def ledger(s, d):
    o = t(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("entity_id"), (F.col("o_orderkey") % 100).alias("snapshot_id"))
    return o, o.where("snapshot_id < 90"), o.where("o_orderkey % 3 = 0").select("entity_id", F.col("snapshot_id").alias("supersedes_snapshot_id"))


@query("jn_18_dangling_ledger_rows", f"WITH l AS ({LEDGER}) SELECT o_orderkey FROM l WHERE snapshot_id NOT IN (SELECT snapshot_id FROM l WHERE snapshot_id < 90) AND (entity_id, snapshot_id) NOT IN (SELECT (entity_id, snapshot_id) FROM l WHERE o_orderkey % 3 = 0)")
def jn_18(s, d):
    return ql.dangling(*ledger(s, d)).select("o_orderkey")


@query("dq_04_ledger_references", f"WITH l AS ({LEDGER}) SELECT count(*) AS dangling FROM l WHERE snapshot_id NOT IN (SELECT snapshot_id FROM l WHERE snapshot_id < 90) AND (entity_id, snapshot_id) NOT IN (SELECT (entity_id, snapshot_id) FROM l WHERE o_orderkey % 3 = 0)")
def dq_04(s, d):
    return ql.dangling(*ledger(s, d)).agg(F.count("*").alias("dangling"))


@query("jn_19_shard_reconcile", "SELECT count(*) AS expected, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS observed, 0::BIGINT AS extra, count(*) - (SELECT count(DISTINCT l_partkey) FROM lineitem) AS absent, count(*) - (SELECT count(DISTINCT l_partkey) FROM lineitem) <= 0.01 * count(*) AS ok FROM part")
def jn_19(s, d):
    return idn.reconcile(registry(s, d), sold(s, d, "1990-01-01"), "entity_id")


SUMS = "SELECT 'd' AS dir, c_name AS file, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE sha256(c_mktsegment) END AS sha FROM customer WHERE c_custkey % 5 <> 0"


@query("jn_21_checksums", f"WITH r AS ({SUMS}), a AS (SELECT 'd' AS dir, c_name AS file, sha256(c_mktsegment) AS sha FROM customer WHERE c_custkey % 11 <> 0) SELECT file, CASE WHEN a.sha IS NULL THEN 'FILE MISSING' WHEN r.sha IS NULL THEN 'SUM MISSING' WHEN a.sha = r.sha THEN 'OK' ELSE 'MISMATCH' END AS status FROM r FULL OUTER JOIN a USING (dir, file)")
def jn_21(s, d):
    c = t(s, d, "customer").select(F.lit("d").alias("dir"), F.col("c_name").alias("file"), F.sha2("c_mktsegment", 256).alias("sha"), "c_custkey")
    rec = c.where("c_custkey % 5 <> 0").withColumn("sha", F.when(F.col("c_custkey") % 7 == 0, "x").otherwise(F.col("sha")))
    return ql.checksums(rec, c.where("c_custkey % 11 <> 0")).select("file", "status")


@query("dq_05_checksums_verify", f"WITH r AS ({SUMS}) SELECT count(*) FILTER (WHERE sha <> sha256(c_mktsegment)) AS bad FROM r JOIN customer ON c_name = file")
def dq_05(s, d):
    c = t(s, d, "customer").select(F.lit("d").alias("dir"), F.col("c_name").alias("file"), F.sha2("c_mktsegment", 256).alias("sha"), "c_custkey")
    rec = c.where("c_custkey % 5 <> 0").withColumn("sha", F.when(F.col("c_custkey") % 7 == 0, "x").otherwise(F.col("sha")))
    return ql.checksums(rec, c).agg(F.count_if(F.col("status") == "MISMATCH").alias("bad"))


@query("so_03_missing_and_extra", f"SELECT c_custkey, 'missing' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01')")
def so_03(s, d):
    o = t(s, d, "orders").where(F.col("o_orderdate") >= F.to_timestamp(F.lit("2000-06-01"))).select(F.col("o_custkey").alias("c_custkey"))
    return ql.missing_and_extra(t(s, d, "customer"), o, "c_custkey")


@query("so_04_checked_merge", "SELECT c_custkey, c_name FROM customer")
def so_04(s, d):
    c = t(s, d, "customer")
    return idn.merge_checked(c.where("c_custkey % 3 < 2"), c.where("c_custkey % 3 > 0"), "c_custkey", "c_name")


@query("cl_20_identity_guard", "SELECT c_name AS github_repo, CASE WHEN c_custkey % 10 = 0 THEN 'id_changed' ELSE 'confirm_owner_type' END AS violation FROM customer WHERE c_custkey % 10 = 0 OR c_nationkey = 3")
def cl_20(s, d):
    c = t(s, d, "customer")
    old = c.select(F.col("c_name").alias("github_repo"), F.col("c_custkey").alias("repo_id"), F.lit("User").alias("owner_type"))
    new = c.select(F.col("c_name").alias("github_repo"), (F.col("c_custkey") + F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0)).alias("repo_id"), F.when(F.col("c_nationkey") == 3, "Organization").otherwise("User").alias("owner_type"))
    return ql.identity_changes(old, new)


@query("dq_01_completeness", f"SELECT count(*) AS seeded, (SELECT count(*) FROM ({SOLD.format('2001-09-01')})) AS captured, round((count(*) - (SELECT count(*) FROM ({SOLD.format('2001-09-01')}))) / count(*), 6) AS missing_share, (count(*) - (SELECT count(*) FROM ({SOLD.format('2001-09-01')}))) / count(*) <= 0.15 AS ok FROM part")
def dq_01(s, d):
    return ql.completeness(registry(s, d), sold(s, d, "2001-09-01"), "entity_id").withColumn("missing_share", r("missing_share"))


@query("dq_02_counts_contract", "SELECT DISTINCT p_brand AS cohort, CASE WHEN p_brand = 'Brand#11' THEN 'entities' ELSE '' END AS differs, p_brand <> 'Brand#11' AS ok FROM part")
def dq_02(s, d):
    found = registry(s, d).groupBy("cohort").agg(F.count("*").alias("entities"))
    stored = found.withColumn("entities", F.col("entities") + F.when(F.col("cohort") == "Brand#11", 1).otherwise(0))
    return ql.counts_contract(stored, found, ["cohort"], ["entities"]).withColumn("differs", F.array_join("differs", ","))


@query("dq_02_counts_modes", "SELECT p_brand AS cohort, count(*) AS entities, CASE WHEN p_brand < 'Brand#3' THEN 'strict' ELSE 'legacy' END AS mode, p_brand >= 'Brand#3' OR p_brand <> 'Brand#11' AS ok FROM part GROUP BY 1")
def dq_02b(s, d):
    """Bundles of the older form have no count of single-axis rows: there tracked holds both."""
    x = t(s, d, "part").groupBy(F.col("p_brand").alias("cohort")).agg(F.count("*").alias("entities"), F.count_if(F.col("p_size") < 25).alias("tracked"), F.count_if(F.col("p_size") >= 25).alias("single_axis"))
    old = F.col("cohort") >= "Brand#3"
    stored = x.select("cohort", "entities", (F.when(old, F.col("tracked") + F.col("single_axis")).otherwise(F.col("tracked")) + F.when(F.col("cohort") == "Brand#11", 1).otherwise(0)).alias("tracked"), F.when(~old, F.col("single_axis")).alias("single_axis"))
    return ql.counts_by_mode(stored, x, "cohort").select("cohort", "entities", "mode", "ok")


@query("dq_03_mirrored_ids", "SELECT n_nationkey AS snapshot_id, n_nationkey % 4 AS mirrors, n_nationkey % 5 <> 1 OR n_nationkey % 4 = 0 AS ok FROM nation")
def dq_03b(s, d):
    """Every bundle has its id in up to three mirror files; one in five has another id in one of them."""
    n = t(s, d, "nation").select(F.col("n_nationkey").alias("snapshot_id"))
    files = n.where("snapshot_id % 4 > 0").select("snapshot_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("snapshot_id") % 4)).alias("k"))
    files = files.select("snapshot_id", F.when((F.col("snapshot_id") % 5 == 1) & (F.col("k") == 1), F.col("snapshot_id") + 100).otherwise(F.col("snapshot_id")).alias("mirrored_id"))
    return ql.mirrored_ids(n, files)


@query("dq_03_bundle_divergence", "SELECT n_regionkey AS snapshot_id, count(DISTINCT sha256(n_name)) AS payloads FROM nation GROUP BY 1 HAVING count(DISTINCT n_name) > 1")
def dq_03(s, d):
    b = t(s, d, "nation").select(F.col("n_regionkey").alias("snapshot_id"), F.col("n_nationkey").alias("day"), F.sha2("n_name", 256).alias("payload"))
    return idn.divergent(b)


@query("dq_06_chain_of_roots", "SELECT item_id FROM benchmark WHERE item_id % 50 = 7 AND item_id > (SELECT min(item_id) FROM benchmark)")
def dq_06(s, d):
    """A stored chain in which every fiftieth record names another predecessor."""
    stored = idn.chain(t(s, d, "benchmark"), "text", "item_id").withColumn("prev", F.when((F.col("item_id") % 50 == 7) & (F.col("expected") != idn.GENESIS), F.sha2("expected", 256)).otherwise(F.col("expected"))).drop("expected")
    return idn.broken_links(stored, "text", "item_id", "prev").select("item_id")


@query("dq_06_document_chain", "SELECT doc_id FROM documents WHERE doc_id % 50 = 7 AND doc_id > (SELECT min(doc_id) FROM documents)")
def dq_06c(s, d):
    """The same over whole texts."""
    docs = t(s, d, "documents").select("doc_id", "text")
    stored = idn.chain(docs, "text", "doc_id").withColumn("prev", F.when((F.col("doc_id") % 50 == 7) & (F.col("expected") != idn.GENESIS), F.sha2("expected", 256)).otherwise(F.col("expected"))).drop("expected")
    return idn.broken_links(stored, "text", "doc_id", "prev").select("doc_id")


@query("dq_06_root_verify", "SELECT 'same' AS recorded, true AS ok UNION ALL SELECT 'other content', false UNION ALL SELECT 'file gone', false")
def dq_06b(s, d):
    files = t(s, d, "benchmark").select(F.format_string("item/%09d", "item_id").alias("path"), F.col("text").alias("content"))
    root = idn.merkle_root(idn.merkle_leaves(files))
    last = files.agg(F.max("path")).first()[0]
    cases = {"same": files, "other content": files.withColumn("content", F.when(F.col("path") == last, F.concat("content", F.lit("."))).otherwise(F.col("content"))), "file gone": files.where(F.col("path") != last)}
    return s.createDataFrame([(k, idn.verify_root(idn.merkle_leaves(x), root)) for k, x in cases.items()], "recorded string, ok boolean")


#: attempts at bands of ten users a kind of event; every seventh band never succeeds, every twentieth attempt lost its drift, a band is short by some of its rows
BANDS = """led AS (SELECT user_id // 10 * 10 AS lo, user_id // 10 * 10 + 9 AS hi, event_type AS created, event_id AS told, event_id % 3 = 0 AND (user_id // 10) % 7 <> 3 AS done, CASE WHEN event_id % 20 <> 6 THEN event_id % 5 END AS index_drift,
  600 + user_id // 10 AS total, 600 + user_id // 10 - event_id % 8 + CASE WHEN (user_id // 10) % 4 = 1 THEN 5 ELSE 0 END AS collected FROM events)"""


@query("dq_07_sweep_coverage", f"""WITH {BANDS}, b AS (SELECT lo, hi, created, bool_or(done) AS done, arg_max(total, told) FILTER (WHERE done) AS total, arg_max(collected, told) FILTER (WHERE done) AS collected, count(*) FILTER (WHERE done AND index_drift IS NULL) AS undrifted FROM led GROUP BY 1, 2, 3),
 d AS (SELECT *, coalesce(collected, 0) - coalesce(total, 0) AS drift, greatest(2.0, 0.005 * coalesce(total, 0)) AS allowed FROM b),
 o AS (SELECT count(*) AS bands, count(*) FILTER (WHERE done) AS complete, sum(undrifted)::BIGINT AS without_drift, count(*) FILTER (WHERE NOT done) AS unresolved, sum(greatest(-drift, 0))::BIGINT AS shortfall, sum(greatest(drift, 0))::BIGINT AS surplus,
  count(*) FILTER (WHERE abs(drift) > allowed) AS beyond, min(lo) = 0 AND max(hi) = 9999 AS whole_range FROM d) SELECT *, unresolved = 0 AND beyond = 0 AND complete > 0 AND without_drift = 0 AND whole_range AS ok FROM o""")
def dq_07(s, d):
    e, band = t(s, d, "events"), F.floor(F.col("user_id") / 10)
    ledger = e.select(
        (band * 10).alias("lo"), (band * 10 + 9).alias("hi"), F.col("event_type").alias("created"), F.col("event_id").alias("at"), ((F.col("event_id") % 3 == 0) & (band % 7 != 3)).alias("done"),
        F.when(F.col("event_id") % 20 != 6, F.col("event_id") % 5).alias("index_drift"), (600 + band).alias("total"), (600 + band - F.col("event_id") % 8 + F.when(band % 4 == 1, 5).otherwise(0)).alias("collected"),
    )
    return ql.band_coverage(ledger, 0, 9999)


@query("dq_08_required_present", "SELECT name AS n_name, name IN (SELECT n_name FROM nation) AS present, name IN (SELECT n_name FROM nation) OR name = 'ATLANTIS' AS ok FROM (SELECT unnest(['FRANCE', 'ATLANTIS', 'MORDOR']) AS name)")
def dq_08(s, d):
    return ql.required_present(["FRANCE", "ATLANTIS", "MORDOR"], t(s, d, "nation"), "n_name", optional=("ATLANTIS",))


@query("dq_09_remap_idempotent", "SELECT count(*) AS rows, true AS same FROM part")
def dq_09(s, d):
    m = taxonomy(s, d).select(F.col("cohort").alias("old"), "field", "new")
    one = ql.remap(t(s, d, "part").select("p_partkey", F.col("p_brand").alias("old")), m, "old", ["field", "new"])
    two = ql.remap(one.select("p_partkey", "old"), m, "old", ["field", "new"])
    j = one.select("p_partkey", "field", "old").join(two.select("p_partkey", F.col("field").alias("f2"), F.col("old").alias("o2")), "p_partkey")
    return j.agg(F.count("*").alias("rows"), F.bool_and((F.col("field") == F.col("f2")) & (F.col("old") == F.col("o2"))).alias("same"))


@query("dq_11_rewrite_ids", "SELECT event_id, CASE WHEN event_type = 'click' AND ts::DATE = DATE '2024-01-05' THEN 'tap' ELSE event_type END AS snapshot_id FROM events")
def dq_11(s, d):
    e = t(s, d, "events").select("event_id", F.col("event_type").alias("snapshot_id"), F.col("ts").alias("captured_at"))
    return idn.rewrite_ids(e, "click", "tap", "2024-01-05").select("event_id", "snapshot_id")


@query("dq_11_untouched_rows", "SELECT count(*) FILTER (WHERE event_type = 'click' AND ts::DATE = DATE '2024-01-05') AS rewritten, count(*) FILTER (WHERE event_id % 1000 = 1 AND NOT (event_type = 'click' AND ts::DATE = DATE '2024-01-05')) AS touched, false AS ok FROM events")
def dq_11b(s, d):
    """The rewrite of another hand changed rows that it had no business with."""
    e = t(s, d, "events").select("event_id", F.col("event_type").alias("snapshot_id"), F.col("ts").alias("captured_at"), "value")
    other = idn.rewrite_ids(e, "click", "tap", "2024-01-05").withColumn("value", F.col("value") + F.when((F.col("event_id") % 1000 == 1) & (F.col("snapshot_id") != "tap"), 1.0).otherwise(0.0))
    return idn.rewrite_report(e, other, "event_id", "click", "tap", "2024-01-05")


@query("pf_01_allow_list", "SELECT c_custkey, c_mktsegment FROM customer")
def pf_01(s, d):
    return pv.allow(t(s, d, "customer"), ["c_custkey", "c_mktsegment", "not_there"])


@query("pf_02_person_fields", """SELECT event_id, unnest(['$.owner', '$.owner.login', '$.a[1].b.c[0].email']) AS path FROM events WHERE event_type = 'signup' UNION ALL SELECT event_id, '$.maintainer' FROM events WHERE event_type = 'click'""")
def pf_02(s, d):
    e = t(s, d, "events")
    deep = F.format_string('{"owner": {"login": "u%d", "kind": "x"}, "a": [1, {"b": {"c": [{"email": "u@v"}]}}], "note": "{\\"author\\": [[[1]]]}"}', "user_id")
    j = F.when(F.col("event_type") == "signup", deep).when(F.col("event_type") == "click", F.to_json(F.struct(F.col("user_id").alias("maintainer"), "value"))).otherwise(F.col("props"))
    return pv.person_fields(e.select("event_id", j.alias("j")), "event_id", "j")


def owned(s, d):
    c = t(s, d, "customer")
    repo = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit(""))), F.lit("/tool"))
    home = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://"), F.url_encode(F.lower(F.replace("c_name", F.lit("#"), F.lit("")))), F.lit(".dev"))).otherwise(F.lit("https://tool.dev"))
    rows = c.select("c_custkey", repo.alias("github_repo"), home.alias("homepage"))
    owners = c.select(repo.alias("github_repo"), F.when(F.col("c_nationkey") < 12, "User").otherwise("Organization").alias("owner_type"), repo.alias("full_name"))
    return rows, owners


@query("pf_03_public_projection", "SELECT c_custkey, CASE WHEN c_nationkey >= 12 THEN lower(replace(c_name, '#', '')) || '/tool' END AS github_repo, CASE WHEN c_custkey % 2 = 1 THEN 'https://tool.dev' WHEN c_nationkey >= 12 THEN 'https://' || lower(replace(c_name, '#', '')) || '.dev' END AS homepage FROM customer")
def pf_03(s, d):
    return pv.public_projection(*owned(s, d))


@query("pf_04_handle_leaks", "SELECT c_custkey FROM customer WHERE contains(lower(c_mktsegment), 'furn') OR contains(lower(c_name), '#000000012')")
def pf_04(s, d):
    return pv.handle_leaks(t(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["Furn", "#000000012"]).select("c_custkey")


@query("pf_09_pre_baseline_flags", "SELECT o_orderkey, o_orderdate < TIMESTAMP '1996-01-01' AS provisional FROM orders")
def pf_09(s, d):
    return t(s, d, "orders").select("o_orderkey", F.coalesce(F.col("o_orderdate") < F.to_timestamp(F.lit("1996-01-01")), F.lit(False)).alias("provisional"))


def defective(k: str, defects: dict[int, str], sound: str) -> str:
    """SQL of a JSON line: the sound one, or by ``k`` modulo 20 one with a defect."""
    return f"CASE {' '.join(f'WHEN {k} % 20 = {i} THEN {x}' for i, x in defects.items())} ELSE {sound} END"


DISCOVERY = defective("k", {
    1: "concat('{\"id\": 0, \"full_name\": \"org/', n, '\"}')", 2: "concat('{\"id\": true, \"full_name\": \"org/', n, '\"}')", 3: "concat('{\"id\": ', k + 1, ', \"full_name\": \"', n, '\"}')",
    4: "concat('{\"id\": ', k + 1, ', \"full_name\": \"org/\"}')", 5: "concat('{\"id\": ', k + 1, ', \"full_name\": \"org/', n, '\", \"stars\": 1}')", 6: "'{\"id\": '", 7: "concat('{\"id\": \"', k + 1, '\", \"full_name\": \"org/', n, '\"}')",
}, "concat('{\"id\": ', k + 1, ', \"full_name\": \"org/', n, '\"}')")


@query("pf_10_row_violations", "SELECT c_custkey AS k, ['bad_id', 'bad_id', 'bad_full_name', 'bad_full_name', 'bad_fields', 'bad_fields', 'bad_id'][(c_custkey % 20)::INT] AS violations FROM customer WHERE c_custkey % 20 BETWEEN 1 AND 7")
def pf_10(s, d):
    rows = t(s, d, "customer").select(F.col("c_custkey").alias("k"), F.replace("c_name", F.lit("#"), F.lit("")).alias("n"))
    v = ql.discovery_violations(rows.select("k", F.expr(DISCOVERY).alias("line")), "line")
    return v.select("k", F.array_join("violations", ",").alias("violations"))


OBSERVED = defective("k", {
    1: "concat('{\"id\": ', k + 1, ', \"stars\": -1, \"observed_at\": \"2024-01-05T01:02:03Z\"}')", 2: "concat('{\"id\": ', k + 1, ', \"stars\": 1.5, \"observed_at\": \"2024-01-05T01:02:03Z\"}')",
    3: "concat('{\"id\": ', k + 1, ', \"stars\": 1, \"observed_at\": \"2024-01-05 01:02:03\"}')", 4: "concat('{\"id\": ', k + 1, ', \"stars\": 1, \"observed_at\": \"2024-02-30T01:02:03Z\"}')",
    5: "concat('{\"id\": ', k + 1, ', \"stars\": 1, \"observed_at\": \"2024-01-06T01:02:03Z\"}')", 6: "concat('{\"id\": ', k + 1, ', \"observed_at\": \"2024-01-05T01:02:03Z\"}')",
}, "concat('{\"id\": ', k + 1, ', \"stars\": ', k, ', \"observed_at\": \"2024-01-05T01:02:03Z\"}')")


@query("pf_10_observation_violations", "SELECT c_custkey AS k, ['bad_stars', 'bad_stars', 'bad_observed_at', 'bad_observed_at', 'other_day', 'bad_fields'][(c_custkey % 20)::INT] AS violations FROM customer WHERE c_custkey % 20 BETWEEN 1 AND 6")
def pf_10b(s, d):
    rows = t(s, d, "customer").select(F.col("c_custkey").alias("k"))
    v = ql.observation_violations(rows.select("k", F.expr(OBSERVED).alias("line")), "line", "2024-01-05")
    return v.select("k", F.array_join("violations", ",").alias("violations"))


OWNERS = defective("k", {
    1: "concat('{\"owner_type\": \"Robot\", \"repo_id\": ', k + 1, ', \"full_name\": \"org/x\"}')", 2: "'{\"owner_type\": \"User\", \"repo_id\": -3, \"full_name\": \"org/x\"}'", 3: "concat('{\"owner_type\": \"User\", \"repo_id\": ', k + 1, ', \"full_name\": \"x\"}')",
    4: "concat('{\"owner_type\": \"User\", \"repo_id\": ', k + 1, '}')", 5: "'{\"owner_type\": \"Bot\", \"repo_id\": true, \"full_name\": \"a/b/c\"}'",
}, "concat('{\"owner_type\": \"Organization\", \"repo_id\": ', k + 1, ', \"full_name\": \"org/x\"}')")


@query("pf_11_owner_cache", """WITH e AS (SELECT c_custkey AS k, c_name AS repo FROM customer)
 SELECT repo, ['bad_owner_type', 'bad_repo_id', 'bad_full_name', 'bad_fields', 'bad_full_name,bad_owner_type,bad_repo_id'][(k % 20)::INT] AS violations FROM e WHERE k % 20 BETWEEN 1 AND 5
 UNION ALL SELECT repo, 'missing' FROM e WHERE k % 20 = 19 UNION ALL SELECT 'extra/' || k, 'extra' FROM e WHERE k % 20 = 18""")
def pf_11(s, d):
    c = t(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("repo"))
    entries = c.where("k % 20 <> 19").select("repo", F.expr(OWNERS).alias("entry")).unionByName(c.where("k % 20 = 18").select(F.concat(F.lit("extra/"), F.col("k").cast("string")).alias("repo"), F.expr("concat('{\"owner_type\": \"User\", \"repo_id\": ', k + 1, ', \"full_name\": \"org/x\"}')").alias("entry")))
    return ql.owner_cache_violations(c.select("repo"), entries).select("repo", F.array_join("violations", ",").alias("violations"))


@query("pf_12_pinned_rows", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 40 AND l_returnflag = 'R'")
def pf_12(s, d):
    rows = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("github_repo"), F.col("l_returnflag").alias("system"), F.lit("p").alias("package"))
    pins = t(s, d, "part").where("p_size > 40").select(F.col("p_partkey").alias("github_repo"), F.lit("R").alias("system"), F.lit("p").alias("package"))
    return pv.pinned(rows, pins).select("l_orderkey", "l_linenumber")


@query("pf_13_clean_coverage", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def pf_13(s, d):
    return t(s, d, "events").where(F.col("event_type").isin("view", "click")).groupBy("event_type").agg(F.count("*").alias("n"))


def _word_at(place: str) -> str:
    return f"regexp_matches(substr(s, CAST({place} AS BIGINT), 1), '[\\p{{L}}\\p{{N}}_]') AND {place} >= 1"


#: every place of a name or term, then names that stand alone with the terms in the 120 characters around them; a window's edges count as gaps
WINDOWS = f"""WITH surf AS ({surface_sql("pg AS (SELECT page_id, html FROM pages)")}), low AS (SELECT page_id AS doc, lower(surface) AS s, length(surface) AS n FROM surf),
 pos AS (SELECT doc, s, n, unnest(range(1, n + 1)) AS i FROM low),
 hit AS (SELECT doc, s, n, i, w, kind, length(w) AS k FROM pos, (VALUES ('erwh', 'name'), ('the', 'name'), ('idiot', 'term'), ('scum', 'term')) AS v(w, kind) WHERE substr(s, i, length(w)) = w),
 name AS (SELECT doc, w, greatest(1, i - 120) AS lo, least(n + 1, i + k + 120) AS hi FROM hit WHERE kind = 'name' AND NOT ({_word_at("i - 1")}) AND NOT ({_word_at("i + k")}))
 SELECT name.doc, name.w AS name, t.w AS term FROM name JOIN hit t ON t.doc = name.doc AND t.kind = 'term' AND t.i >= lo AND t.i + t.k <= hi
 WHERE (t.i = lo OR NOT ({_word_at("t.i - 1")})) AND (t.i + t.k = hi OR NOT ({_word_at("t.i + t.k")}))"""


@query("pf_15_window_terms", WINDOWS)
def pf_15(s, d):
    surf = t(s, d, "pages").select(F.col("page_id").alias("doc"), sc.html_surface("html").alias("surface"))
    return pv.window_terms(surf, ["erwh", "the"], ["idiot", "scum"]).select("doc", "name", F.lower("term").alias("term"))


@query("pf_15_page_terms", "SELECT doc, term, count(*) AS n FROM (SELECT doc_id AS doc, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM documents) WHERE term IN ('idiot', 'scum') GROUP BY 1, 2")
def pf_15b(s, d):
    surf = t(s, d, "documents").select(F.col("doc_id").alias("doc"), F.col("text").alias("surface"))
    return pv.page_terms(surf, ["idiot", "scum"]).groupBy("doc", F.lower("term").alias("term")).agg(F.count("*").alias("n"))


@query("pf_15_leaf_terms", "SELECT event_id, unnest(['$.k', '$.deep[1].says']) AS path, unnest(['idiot', 'scum']) AS term FROM events WHERE event_id % 3 = 0")
def pf_15c(s, d):
    said = F.when(F.col("event_id") % 3 == 0, '{"k": "an Idiot, said", "deep": [1, {"says": "SCUM"}], "scum": 2}').otherwise(F.col("props"))
    return pv.leaf_terms(t(s, d, "events").select("event_id", said.alias("j")), "event_id", "j", ["idiot", "scum"]).withColumn("term", F.lower("term"))


@query("pf_16_plane_split", SCORES + " SELECT CASE WHEN axis1_z IS NULL THEN 'excluded' WHEN axis2_z IS NULL THEN 'rail' ELSE 'plane' END AS place, count(*) AS n FROM scores GROUP BY 1")
def pf_16(s, d):
    return scores(s, d).groupBy(pv.plane(F.col("axis1_z"), F.col("axis2_z")).alias("place")).agg(F.count("*").alias("n"))


RECON = "SELECT l_partkey AS entity_id, strftime(l_shipdate, '%Y-%m') AS period, count(*) AS value FROM lineitem GROUP BY 1, 2"


@query("pf_17_reconstructed_rows", f"WITH r AS ({RECON}) SELECT entity_id, period, value, true AS reconstructable FROM r WHERE value > 0")
def pf_17(s, d):
    n = t(s, d, "lineitem").groupBy(F.col("l_partkey").alias("entity_id"), F.date_format("l_shipdate", "yyyy-MM").alias("period")).agg(F.count("*").alias("value"))
    return n.where("value > 0").withColumn("reconstructable", F.lit(True))


@query("pf_17_skipped_entities", f"""WITH r AS ({RECON}) SELECT p_partkey AS entity_id, CASE WHEN p_partkey % 9 = 0 THEN 'no entity_id' WHEN p_partkey NOT IN (SELECT entity_id FROM r) THEN 'no activity' ELSE 'no nonzero periods' END AS reason FROM part
 WHERE p_partkey % 9 = 0 OR p_partkey % 7 = 0 OR p_partkey NOT IN (SELECT entity_id FROM r)""")
def pf_17b(s, d):
    """Every ninth part has no registered id; every seventh only zero counts."""
    p = t(s, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_partkey")).alias("entity_id"))
    n = t(s, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"), F.date_format("l_shipdate", "yyyy-MM").alias("period")).agg(F.count("*").alias("n"))
    counts = n.select("p_partkey", "period", F.when(F.col("p_partkey") % 7 == 0, 0).otherwise(F.col("n")).alias("value"))
    return ql.skipped(p, counts, "p_partkey").select(F.col("p_partkey").alias("entity_id"), "reason")


@query("pf_18_taxonomy_nodes", "SELECT DISTINCT 't_' || substr(sha256(slug), 1, 8) AS id, slug, level, parent FROM (SELECT lower(r_name) AS slug, 'field' AS level, 'domain' AS parent FROM region UNION ALL SELECT lower(n_name), 'cohort', lower(r_name) FROM nation JOIN region ON n_regionkey = r_regionkey)")
def pf_18(s, d):
    j = t(s, d, "nation").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nodes = t(s, d, "region").select(F.lower("r_name").alias("slug"), F.lit("field").alias("level"), F.lit("domain").alias("parent")).unionByName(j.select(F.lower("n_name").alias("slug"), F.lit("cohort").alias("level"), F.lower("r_name").alias("parent")))
    return nodes.distinct().withColumn("id", F.concat(F.lit("t_"), F.substring(F.sha2("slug", 256), 1, 8)))


# ---- sources and sinks: the table is written in the form that the operator reads or writes, and read back ----


@query("sc_01_snapshot_documents", "SELECT strftime(ts, '%Y-%m-%d') AS snapshot_date, count(*) AS entities FROM events GROUP BY 1")
def sc_01(s, d):
    path = scratch(s, "snapshots")
    e = t(s, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("snapshot_date"), "event_id")
    # a day's documents hold about a thousand entities each; every document is a file of its day's directory
    docs = e.groupBy("snapshot_date", F.floor(F.col("event_id") / 1000).alias("k")).agg(F.collect_list("event_id").alias("entities"))
    docs.select(F.to_json(F.struct("snapshot_date", "entities")).alias("value"), F.col("snapshot_date").alias("day")).repartition("day").write.partitionBy("day").option("maxRecordsPerFile", 1).text(path)
    rows = readers.snapshots(s, f"{path}/day=*", "snapshot_date string, entities array<long>")
    return rows.select(F.col("dir_date").alias("snapshot_date"), F.explode("entities").alias("e")).groupBy("snapshot_date").agg(F.count("*").alias("entities"))


@query("sc_02_tolerant_json_lines", "SELECT event_id, event_type FROM events")
def sc_02(s, d):
    path = scratch(s, "jsonl")
    t(s, d, "events").select("event_id", "event_type").write.json(path)
    got = readers.jsonl_tolerant(s, path, "event_id long, event_type string")
    return got.unionByName(readers.jsonl_tolerant(s, path + "-absent", "event_id long, event_type string"))


@query("sc_03_strict_json_lines", "SELECT c_custkey AS id, c_name AS full_name FROM customer")
def sc_03(s, d):
    path = scratch(s, "strict")
    t(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name")).write.json(path)
    return readers.jsonl_strict(s, path, "id long, full_name string", "id")


@query("sc_04_counted_rejects", "SELECT CASE WHEN event_id % 10 = 0 THEN 'corrupt' ELSE 'ok' END AS state, count(*) AS n FROM events GROUP BY 1")
def sc_04(s, d):
    path = scratch(s, "counted")
    line = F.when(F.col("event_id") % 10 == 0, F.lit('{"event_id": ')).otherwise(F.to_json(F.struct("event_id")))
    t(s, d, "events").select(line.alias("value")).write.text(path)
    got = readers.jsonl_counted(s, path, "event_id long")
    return got.select(F.when(F.col("corrupt").isNotNull(), "corrupt").otherwise("ok").alias("state")).groupBy("state").agg(F.count("*").alias("n"))


#: rows of every third event come from the backfill; where both origins have a day, the captured row wins
SERIES = "SELECT user_id AS entity_id, ts::DATE AS snap, coalesce(max(event_id) FILTER (WHERE event_id % 3 <> 0), max(event_id)) AS value FROM events WHERE ts::DATE <= DATE '2024-01-20' AND event_type <> 'error' GROUP BY 1, 2"


@query("sc_05_partitioned_series", SERIES)
def sc_05(s, d):
    e = t(s, d, "events").select(F.col("user_id").alias("entity_id"), F.to_date("ts").alias("snap"), F.col("event_id").alias("value"), F.when(F.col("event_type") == "error", "fetch_error").otherwise("matched").alias("coverage"), F.col("event_id").alias("file_date"))
    return readers.series(e.where("value % 3 = 0"), e.where("value % 3 <> 0"), "2024-01-20")


@query("sc_07_labelled_series", "SELECT 'views' AS series, user_id::VARCHAR AS entity, event_id AS snap, value FROM events WHERE event_type = 'view' UNION ALL SELECT 'clicks', user_id::VARCHAR, event_id, value * 2 FROM events WHERE event_type = 'click'")
def sc_07(s, d):
    e = t(s, d, "events").select(F.col("user_id").alias("entity_id"), F.col("event_id").alias("snap"), "value", "event_type")
    return readers.labelled_series([("views", e.where("event_type = 'view'"), "value"), ("clicks", e.where("event_type = 'click'"), "value * 2")])


@query("sc_08_registry_flatten", "SELECT r_name AS vertical, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def sc_08(s, d):
    j = t(s, d, "nation").join(t(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("name")))).alias("entities"))
    doc = j.groupBy(F.lit("world").alias("domain")).agg(F.map_from_entries(F.collect_list(F.struct("r_name", F.struct(F.col("r_name").alias("label"), "entities")))).alias("verticals"))
    return readers.registry(doc).select("vertical", "name")


@query("sc_12_checksum_lists", "SELECT c_name AS file, sha256(c_mktsegment) AS sha FROM customer")
def sc_12(s, d):
    path = scratch(s, "sums")
    t(s, d, "customer").select(F.concat_ws("  ", F.sha2("c_mktsegment", 256), "c_name").alias("value")).write.text(path)
    return readers.checksum_list(s, path).select("file", "sha")


@query("sc_13_archive_scan", "SELECT count(*) AS rows FROM customer")
def sc_13(s, d):
    path = scratch(s, "archive")
    t(s, d, "customer").select("c_name").write.text(path)
    files = readers.archive(s, path, exclude="_SUCCESS")
    return files.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("l")).where("l <> ''").agg(F.count("*").alias("rows"))


@query("sc_14_newest_partition", f"WITH {OBS} SELECT event_id FROM obs WHERE period = (SELECT max(period) FROM obs)")
def sc_14(s, d):
    return readers.newest(observations(s, d), "period").select("event_id")


@query("sc_14_newest_set", f"WITH {OBS} SELECT event_id FROM obs WHERE period = (SELECT DISTINCT period FROM obs ORDER BY 1 DESC LIMIT 1 OFFSET 3)")
def sc_14b(s, d):
    """Of the newest four sets one is tampered with, one has lost a part, and one was never finished: the fourth is read."""
    o, root = observations(s, d).select("period", "event_id"), scratch(s, "sets")
    fourth, third, second, first = sorted(r["period"] for r in o.select("period").distinct().collect())[-4:]
    whole = lambda period: {"ids": o.where(F.col("period") == period).select("event_id"), "size": o.where(F.col("period") == period).groupBy("period").count()}
    for period in (fourth, third, second):
        name = bundles.publish(s, root, period, whole(period), {"period": period})
        if period == third:
            # the same number of rows and files under other contents
            changed = s.read.parquet(f"{root}/sets/{name}/ids").withColumn("event_id", F.col("event_id") + 1)
            other = bundles.write_set(s, root, {"ids": changed, "size": whole(period)["size"]}, {"period": period})
            discard(s, f"{root}/sets/{name}/manifest")
            move(s, f"{root}/sets/{name}/ids", f"{root}/sets/{name}/was")
            move(s, f"{root}/sets/{other}/ids", f"{root}/sets/{name}/ids")
            listed = s.read.schema(bundles.MANIFEST).json(f"{root}/sets/{other}/manifest")
            true = idn.table_digest(s.read.parquet(f"{root}/sets/{name}/was")).select(F.col("digest").alias("true"))
            listed.join(F.broadcast(true)).withColumn("digest", F.when(F.col("part") == "ids", F.col("true")).otherwise(F.col("digest"))).drop("true").coalesce(1).write.json(f"{root}/sets/{name}/manifest")
        if period == second:
            discard(s, f"{root}/sets/{name}/size")
    bundles.write_set(s, root, whole(first), {"period": first})
    day, at = bundles.newest_complete(s, root, ["ids", "size"])
    return s.read.schema("event_id long").parquet(f"{at}/ids")


def move(s, a, b):
    p, q = (s._jvm.org.apache.hadoop.fs.Path(x) for x in (a, b))
    if not p.getFileSystem(s._jsc.hadoopConfiguration()).rename(p, q):
        raise OSError(f"{a} was not moved")


@query("sc_15_backfill_read", f"WITH r AS ({RECON}) SELECT entity_id, period, value FROM r")
def sc_15(s, d):
    return readers.reconstructed(pf_17(s, d).withColumn("signal", F.lit("weekly")), "weekly")


@query("sk_01_snapshot_bundle", SCORES + """, j AS (SELECT 'entities' AS part, entity_id::VARCHAR || ' ' || status AS line FROM scores UNION ALL SELECT 'counts', status || ' ' || count(*) FROM scores GROUP BY status)
 SELECT * FROM j UNION ALL SELECT 'provenance', 'day 2001-11-30' UNION ALL SELECT 'provenance', 'methodology m1' UNION ALL SELECT 'manifest', part || ' ' || count(*) FROM j GROUP BY part""")
def sk_01(s, d):
    """Entities and counts of a snapshot as one set, read back with its manifest and provenance."""
    root = scratch(s, "bundle")
    e = stored(scores(s, d).select("entity_id", "status"), "scores")
    bundles.publish(s, root, "2001-11-30", {"entities": e, "counts": e.groupBy("status").agg(F.count("*").alias("n"))}, {"day": "2001-11-30", "methodology": "m1"})
    _, at = bundles.newest_complete(s, root, ["entities", "counts"])
    line = lambda rows, part, *c: rows.select(F.lit(part).alias("part"), F.concat_ws(" ", *c).alias("line"))
    out = line(s.read.schema("entity_id long, status string").parquet(f"{at}/entities"), "entities", "entity_id", "status")
    out = out.unionByName(line(s.read.schema("status string, n long").parquet(f"{at}/counts"), "counts", "status", "n"))
    out = out.unionByName(line(s.read.schema("key string, value string").json(f"{at}/provenance"), "provenance", "key", "value"))
    return out.unionByName(line(s.read.schema(bundles.MANIFEST).json(f"{at}/manifest"), "manifest", "part", "rows"))


@query("sk_02_append_history", f"WITH {OBS} SELECT event_id, period FROM obs")
def sk_02(s, d):
    path = scratch(s, "history")
    o = observations(s, d).select("event_id", "period")
    writers.append_history(o.where("event_id % 2 = 0"), path)
    writers.append_history(o.where("event_id % 2 = 1"), path)
    return s.read.parquet(path).select("event_id", "period")


@query("sk_03_append_once", "SELECT event_id FROM events")
def sk_03(s, d):
    path = scratch(s, "once")
    e = t(s, d, "events").select("event_id")
    writers.append_once(e.where("event_id % 3 > 0"), path, ["event_id"])
    writers.append_once(e, path, ["event_id"])
    return s.read.parquet(path)


@query("sk_04_write_or_verify", "SELECT true AS wrote, false AS again")
def sk_04(s, d):
    path = scratch(s, "verify")
    p = t(s, d, "part")
    return s.createDataFrame([(writers.write_or_verify(p, path), writers.write_or_verify(p, path))], "wrote boolean, again boolean")


@query("sk_05_flat_csv", SCORES + " SELECT entity_id::VARCHAR AS entity_id, status, 'urn:tm:e_' || entity_id || ':m1:2001-w48' AS claim FROM scores")
def sk_05(s, d):
    path = scratch(s, "csv")
    writers.flat_csv(scores(s, d).select("entity_id", "status", sc.build_claim("urn:tm", F.concat(F.lit("e_"), F.col("entity_id").cast("string")), F.lit("m1"), F.lit("2001-w48")).alias("claim")), path)
    return s.read.option("header", True).schema("entity_id string, status string, claim string").csv(path)


@query("sk_07_frontier", "SELECT count(*) AS candidates FROM documents WHERE lang = 'en'")
def sk_07(s, d):
    path = scratch(s, "frontier")
    writers.frontier(t(s, d, "documents").where("lang = 'en'"), path, "2001-11-30")
    return s.read.parquet(f"{path}/2001-11-30").select("candidates")


# ---- streams: the events table replayed as a file stream, to its end ----


def replay(s, d, name, build, mode="append"):
    """Run a streaming query over the events files and return what it wrote."""
    out, mark = scratch(s, name), scratch(s, name + "-state")
    src = s.readStream.schema(t(s, d, "events").schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/events.parq[u]et")
    rows = src.select(F.col("event_id").cast("string").alias("observation_id"), F.col("user_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("captured_at"), "value", "event_type")
    got = build(rows)

    ledger = once.BatchLedger(s, out)
    sink = ledger.sink(lambda batch, _: {"rows": batch})
    got.writeStream.outputMode(mode).option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in got.schema)
    return ledger.read("rows", names).drop("batch")


WEEK = "date_trunc('week', ts)::DATE"


@query("ss_01_weekly_periods", f"SELECT {WEEK}::VARCHAR AS week, count(*) AS n FROM events GROUP BY 1")
def ss_01(s, d):
    got = replay(s, d, "ss01", lambda x: st.weekly(x).select("observation_id", F.date_format("week.start", "yyyy-MM-dd").alias("week")))
    return got.groupBy("week").agg(F.count("*").alias("n"))


@query("ss_02_last_in_week", f"SELECT user_id AS entity_id, {WEEK}::VARCHAR AS week, arg_max(value, ts) AS value, count(*) AS captures FROM events  GROUP BY 1, 2")
def ss_02(s, d):
    got = replay(s, d, "ss02", lambda x: st.last_in_week(x, ["entity_id"], "value"), "update")
    last = latest(got, ["entity_id", "week_start"], [F.col("captures")])
    return last.select("entity_id", F.date_format("week_start", "yyyy-MM-dd").alias("week"), "value", "captures")


@query("ss_03_once", "SELECT event_id::VARCHAR AS observation_id FROM events")
def ss_03(s, d):
    return replay(s, d, "ss03", lambda x: st.once(x.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), ["observation_id"]).select("observation_id"))


FLIPS = "SELECT event_id::VARCHAR AS observation_id, value FROM events WHERE event_id % 10 <> 3"


def with_flips(x):
    """Every tenth observation is followed a minute later by a row that retracts it."""
    rows = x.withColumn("status", F.lit("active")).withColumn("supersedes", F.lit(None).cast("string"))
    flip = x.where("cast(observation_id as long) % 10 = 3").select(
        F.concat("observation_id", F.lit("-r")).alias("observation_id"), "entity_id", (F.col("captured_at") + F.expr("INTERVAL 1 MINUTE")).alias("captured_at"), "value", "event_type", F.lit("retracted").alias("status"), F.col("observation_id").alias("supersedes")
    )
    return rows.unionByName(flip)


@query("ss_04_retractions_batch", FLIPS)
def ss_04(s, d):
    x = t(s, d, "events").select(F.col("event_id").cast("string").alias("observation_id"), F.col("user_id").alias("entity_id"), F.col("ts").alias("captured_at"), "value", "event_type")
    return st.standing(with_flips(x)).select("observation_id", "value")


@query("ss_04_retractions_stream", FLIPS)
def ss_04b(s, d):
    with rocksdb(s):
        got = replay(s, d, "ss04", lambda x: timers.standing_changes(with_flips(x)), "update")
    return got.groupBy("observation_id").agg(F.max_by("status", F.when(F.col("status") == "retracted", 1).otherwise(0)).alias("status"), F.max("value").alias("value")).where("status <> 'retracted'").select("observation_id", "value")


@contextlib.contextmanager
def rocksdb(s):
    """The session's state store for the streams that are started inside."""
    before = {k: s.conf.get(k, None) for k in timers.ROCKSDB}
    for k, v in timers.ROCKSDB.items():
        s.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            s.conf.set(k, v) if v else s.conf.unset(k)


def replay_parts(s, d, name, parts, start):
    """Let a stream run over the events as they arrive: each part is added to its source, and the stream is started again.

    A part is one micro-batch of as many files as its writers made; all runs share a checkpoint.
    """
    src, mark = scratch(s, name + "-in"), scratch(s, name + "-state")
    for p in parts:
        p.write.mode("append").parquet(src)
        rows = s.readStream.schema(t(s, d, "events").schema).parquet(src)
        start(rows).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()


LATE = "event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-15 00:00:00'"


@query("ss_05_late_rows", f"SELECT CASE WHEN {LATE} THEN 'late' ELSE 'on time' END AS kind, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def ss_05(s, d):
    """Every fiftieth row of the first two weeks arrives at the end: counted apart, it changes no view of its time."""
    e = t(s, d, "events")
    ledger = once.BatchLedger(s, scratch(s, "ss05"))
    sink = ledger.sink(once.split_late(scratch(s, "ss05-marks"), "ts"))
    replay_parts(s, d, "ss05", [e.where(f"NOT ({LATE})"), e.where(LATE)], lambda rows: rows.select("event_id", "ts").writeStream.foreachBatch(sink))
    got = ledger.read("rows", "event_id long").withColumn("kind", F.lit("on time")).unionByName(ledger.read("late", "event_id long").withColumn("kind", F.lit("late")))
    return got.groupBy("kind").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("ss_05_view_at_cutoff", "SELECT count(*) AS n FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'")
def ss_05b(s, d):
    return replay(s, d, "ss05v", lambda x: st.visible_at(x, CUT).select("observation_id")).agg(F.count("*").alias("n"))


@query("ss_06_final_partitions", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows FROM events GROUP BY 1 HAVING min(ts::DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def ss_06(s, d):
    """In append mode a day appears once, when the watermark has passed it; the newest days stay provisional and are not there."""
    e = t(s, d, "events")
    parts = [e.where("ts < '2024-01-10'"), e.where("ts >= '2024-01-10' AND ts < '2024-01-20'"), e.where("ts >= '2024-01-20'")]
    ledger = once.BatchLedger(s, scratch(s, "ss06"))
    final = lambda rows: st.final_partitions(rows.select(F.col("user_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("captured_at")))
    replay_parts(s, d, "ss06", parts, lambda rows: final(rows).writeStream.outputMode("append").foreachBatch(ledger.sink(lambda b, _: {"days": b})))
    return ledger.read("days", "day date, rows long, entities long").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "rows")


@query("ss_06_provisional", "SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN ts::DATE = (SELECT max(ts::DATE) FROM events) THEN 'PROVISIONAL' ELSE 'FINAL' END AS state FROM events GROUP BY 1, 2")
def ss_06b(s, d):
    days = t(s, d, "events").select(F.to_date("ts").alias("day")).distinct()
    return st.provisional(days).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "state")


@query("ss_07_silent_sessions", "SELECT entity_id, count(*) FILTER (WHERE p IS NULL OR ts >= p + INTERVAL 2 DAY) AS runs, count(*) AS rows FROM (SELECT user_id AS entity_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) GROUP BY 1")
def ss_07(s, d):
    x = t(s, d, "events").select(F.col("user_id").alias("entity_id"), F.col("ts").alias("captured_at"))
    return st.silent_sessions(x, ["entity_id"], "2 days").groupBy("entity_id").agg(F.count("*").alias("runs"), F.sum("rows").alias("rows"))


@query("ss_07_silent_stream", """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 DAY THEN 0 ELSE 1 END AS new FROM events),
 k AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, new DESC ROWS UNBOUNDED PRECEDING) AS run FROM g)
 SELECT user_id AS entity_id, strftime(max(ts) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS silent_since, count(*) AS rows FROM k GROUP BY user_id, run HAVING max(ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def ss_07b(s, d):
    """The watermark is the timer: an entity is reported when it has been silent for two days."""
    got = replay(s, d, "ss07", lambda x: st.silent_sessions(x, ["entity_id"], "2 days"))
    return got.select("entity_id", F.date_format("silent_since", "yyyy-MM-dd HH:mm:ss").alias("silent_since"), "rows")


@query("ss_07_silence_timer", """WITH e AS (SELECT * FROM events WHERE user_id % 3 > 0 OR ts < TIMESTAMP '2024-01-20 00:00:00')
 SELECT user_id AS entity_id, strftime(max(ts) + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS silent_since, count(*) AS rows FROM e GROUP BY 1 HAVING max(ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM e) - INTERVAL 1 DAY""")
def ss_07c(s, d):
    """A third of the entities stops on a day; a timer of each reports it while the others go on."""
    with rocksdb(s):
        got = replay(s, d, "ss07t", lambda x: timers.silent_entities(x.where("entity_id % 3 > 0 OR captured_at < '2024-01-20'"), 2))
    return got.select("entity_id", F.date_format("silent_since", "yyyy-MM-dd HH:mm:ss").alias("silent_since"), "rows")


SOUND = "event_type <> 'error' AND event_id % 2 = 0"


@query("ss_08_refused_batches", f"SELECT count(*) AS n, true AS refused FROM events WHERE {SOUND}")
def ss_08(s, d):
    """The second batch is all errors: it is refused, the stream stops, and nothing of it or behind it is written."""
    from pyspark.errors import StreamingQueryException

    e = t(s, d, "events")
    ledger, refused = once.BatchLedger(s, scratch(s, "ss08")), False
    sink = ledger.sink(once.refusing(lambda b, _: {"rows": b.select("event_id")}, F.col("event_type") == "error", 0.5))
    try:
        replay_parts(s, d, "ss08", [e.where(SOUND), e.where("event_type = 'error'"), e.where("event_type <> 'error' AND event_id % 2 = 1")], lambda rows: rows.writeStream.foreachBatch(sink))
    except StreamingQueryException as x:
        refused = "refused" in str(x)
    return ledger.read("rows", "event_id long").agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query("ss_08_exactly_once", "SELECT event_id, count(*) AS n FROM events GROUP BY 1")
def ss_08b(s, d):
    """The stream dies twice and is started again: once after a batch was written but not entered, once after it was entered."""
    from pyspark.errors import StreamingQueryException

    e = t(s, d, "events")
    parts = [e.where(f"event_id % 3 = {k}") for k in range(3)]
    ledger, died = once.BatchLedger(s, scratch(s, "once")), set()

    def dies(at):
        def run(epoch):
            if (epoch, at) in {(1, "before"), (2, "after")} - died:
                died.add((epoch, at))
                raise RuntimeError("the driver is gone")

        return run

    sink = ledger.sink(lambda b, _: {"rows": b.select("event_id")}, dies("before"), dies("after"))
    src, mark = scratch(s, "once-in"), scratch(s, "once-state")
    for p in parts:
        p.write.mode("append").parquet(src)
        for _ in range(2):
            with contextlib.suppress(StreamingQueryException):
                s.readStream.schema(e.schema).parquet(src).writeStream.option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    if len(died) != 2:
        raise AssertionError("the stream did not die where it should")
    return ledger.read("rows", "event_id long").groupBy("event_id").agg(F.count("*").alias("n"))
