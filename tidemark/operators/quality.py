"""Data-quality gates: each gives a report table with an ``ok`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(registry: DataFrame, captured: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Registered but not captured, and whether they were tracked before."""
    gone = registry.select(key).distinct().join(captured.select(key).distinct(), key, "left_anti")
    return gone.join(history.select(key).distinct().withColumn("_h", F.lit(True)), key, "left").select(key, F.coalesce("_h", F.lit(False)).alias("tracked_before"))


def completeness(registry: DataFrame, captured: DataFrame, key: str, limit: float = 0.15) -> DataFrame:
    """Fails without any capture or with more than ``limit`` missing; smaller gaps are declared."""
    both = registry.select(key).distinct().join(captured.select(key).distinct().withColumn("_c", F.lit(1)), key, "left")
    got = both.agg(F.count("*").alias("seeded"), F.count("_c").alias("captured"))
    gap = (F.col("seeded") - F.col("captured")) / F.expr("nullif(seeded, 0)")
    return got.withColumn("missing_share", gap).withColumn("ok", F.coalesce((F.col("captured") > 0) & (gap <= limit), F.lit(False)))


def counts_contract(stored: DataFrame, found: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Stored against recounted numbers, with the columns that differ."""
    f = found.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    j = stored.join(f, keys, "full_outer")
    bad = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), c) for c in columns)))
    return j.select(*keys, bad.alias("differs"), (F.size(bad) == 0).alias("ok"))


def counts_by_mode(stored: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Stored status counts against recounted ones. A bundle with a count of single-axis rows is checked strictly; one without
    (null) is of the older form, whose tracked count holds both."""
    f = found.select(key, *(F.col(c).alias(f"_{c}") for c in ("entities", "tracked", "single_axis")))
    j = stored.join(f, key)
    legacy = F.col("single_axis").isNull()
    ok = F.when(legacy, F.col("tracked") == F.col("_tracked") + F.col("_single_axis")).otherwise((F.col("tracked") == F.col("_tracked")) & (F.col("single_axis") == F.col("_single_axis")))
    return j.select(key, "entities", F.when(legacy, "legacy").otherwise("strict").alias("mode"), ((F.col("entities") == F.col("_entities")) & ok).alias("ok"))


def mirrored_ids(bundles: DataFrame, files: DataFrame) -> DataFrame:
    """Do all files that mirror a bundle's id agree with it? ``files(snapshot_id, mirrored_id)``; a bundle without mirrors does."""
    n = files.groupBy("snapshot_id").agg(F.count("*").alias("n"), F.count_if(~F.col("mirrored_id").eqNullSafe(F.col("snapshot_id"))).alias("other"))
    return bundles.join(n, "snapshot_id", "left").select("snapshot_id", F.coalesce("n", F.lit(0)).alias("mirrors"), (F.coalesce("other", F.lit(0)) == 0).alias("ok"))


def skipped(registered: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Entities that a reconstruction leaves out, and why. ``registered(key, entity_id)``, ``counts(key, period, value)``."""
    n = counts.groupBy(key).agg(F.count_if(F.col("value") > 0).alias("_some"))
    why = F.when(F.col("entity_id").isNull(), "no entity_id").when(F.col("_some").isNull(), "no activity").when(F.col("_some") == 0, "no nonzero periods")
    return registered.join(n, key, "left").select(key, why.alias("reason")).where("reason IS NOT NULL")


def dangling(ledger: DataFrame, published: DataFrame, amendments: DataFrame) -> DataFrame:
    """Ledger rows whose snapshot id is neither published nor amended in the same entity's ledger."""
    a = ledger.join(published.select("snapshot_id").distinct(), "snapshot_id", "left_anti")
    return a.join(amendments.select("entity_id", F.col("supersedes_snapshot_id").alias("snapshot_id")).distinct(), ["entity_id", "snapshot_id"], "left_anti")


def checksums(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """OK, MISMATCH, FILE MISSING or SUM MISSING per (dir, file)."""
    j = recorded.select("dir", "file", F.col("sha").alias("r")).join(actual.select("dir", "file", F.col("sha").alias("a")), ["dir", "file"], "full_outer")
    return j.select("dir", "file", F.when(F.col("a").isNull(), "FILE MISSING").when(F.col("r").isNull(), "SUM MISSING").when(F.col("a") == F.col("r"), "OK").otherwise("MISMATCH").alias("status"))


def sweep(bands: DataFrame) -> DataFrame:
    """Totals of a banded sweep: unresolved bands, shortfall, surplus, and whether drift stays within max(2, 0.5 %)."""
    drift = F.col("collected") - F.col("total")
    allowed = F.greatest(F.lit(2.0), 0.005 * F.col("total"))
    got = bands.agg(
        F.count_if(~F.col("done")).alias("unresolved"), F.sum(F.greatest(-drift, F.lit(0))).alias("shortfall"), F.sum(F.greatest(drift, F.lit(0))).alias("surplus"), F.count_if(F.abs(drift) > allowed).alias("beyond"),
    )
    return got.withColumn("ok", (F.col("unresolved") == 0) & (F.col("beyond") == 0))


def band_coverage(ledger: DataFrame, lo: int, hi: int) -> DataFrame:
    """:func:`sweep` over the bands of a sweep's ledger, with what else makes the sweep incomplete.

    ``ledger(lo, hi, created, done, index_drift, total, collected, at)`` has a row an attempt. A band (lo, hi, created) is done if any attempt was; its
    newest done attempt counts. ``ok`` also needs a band that is done, a drift recorded with every one, and bands that begin at ``lo`` and end at ``hi``.
    """
    done = F.coalesce("done", F.lit(False))
    last = F.max_by(F.struct("total", "collected", "index_drift"), F.when(done, F.col("at")))
    bands = ledger.groupBy("lo", "hi", F.coalesce("created", F.lit("")).alias("created")).agg(F.bool_or(done).alias("done"), last.alias("last"), F.count_if(done & F.col("index_drift").isNull()).alias("undrifted"))
    rows = bands.select("lo", "hi", "done", "undrifted", F.coalesce("last.total", F.lit(0)).alias("total"), F.coalesce("last.collected", F.lit(0)).alias("collected"))
    more = rows.agg(F.count("*").alias("bands"), F.count_if("done").alias("complete"), F.coalesce(F.sum("undrifted"), F.lit(0)).alias("without_drift"), F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    ranged = F.coalesce((F.col("_lo") == lo) & (F.col("_hi") == hi), F.lit(False))
    both = more.join(F.broadcast(sweep(rows)))
    return both.select("bands", "complete", "without_drift", "unresolved", "shortfall", "surplus", "beyond", ranged.alias("whole_range"), (F.col("ok") & (F.col("complete") > 0) & (F.col("without_drift") == 0) & ranged).alias("ok"))


def required_present(required: list[str], present: DataFrame, column: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """Which of a list of names are absent."""
    want = present.sparkSession.createDataFrame([(x, x in optional) for x in required], f"{column} string, optional boolean")
    got = want.join(present.select(column).distinct().withColumn("_p", F.lit(True)), column, "left")
    return got.select(column, F.coalesce("_p", F.lit(False)).alias("present"), (F.coalesce("_p", F.lit(False)) | F.col("optional")).alias("ok"))


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows with the names of the SQL rules they break (a null answer breaks a rule)."""
    bad = F.array_compact(F.array(*(F.when(~F.coalesce(F.expr(e), F.lit(False)), n) for n, e in sorted(rules.items()))))
    return df.withColumn("violations", bad).where(F.size("violations") > 0)


def _json_rules(rows: DataFrame, line: str, fields: list[str], rules: dict[str, Column]) -> DataFrame:
    """``violations`` of a JSON column: ``bad_fields`` alone where the object's keys are not exactly ``fields``, else the rules that fail."""
    exact = F.coalesce(F.array_sort(F.json_object_keys(line)) == F.array(*map(F.lit, sorted(fields))), F.lit(False)) & F.try_parse_json(line).isNotNull()
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in sorted(rules.items()))))
    return rows.withColumn("violations", F.when(exact, failed).otherwise(F.array(F.lit("bad_fields")))).where(F.size("violations") > 0)


def _whole(line: str, name: str, least: int) -> Column:
    """A JSON integer (no boolean, text or fraction) of at least ``least``."""
    v = F.try_variant_get(F.try_parse_json(line), f"$.{name}", "variant")
    return F.schema_of_variant(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT") & (F.get_json_object(line, f"$.{name}").cast("long") >= least)


def _text(line: str, name: str) -> Column:
    v = F.try_variant_get(F.try_parse_json(line), f"$.{name}", "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.get_json_object(line, f"$.{name}"))


def _owner_slash_name(line: str, name: str) -> Column:
    return _text(line, name).rlike("^[^/]+/[^/]+$")


def discovery_violations(rows: DataFrame, line: str) -> DataFrame:
    """JSON lines that are not ``{id, full_name}`` with a positive integer and an owner/name."""
    return _json_rules(rows, line, ["id", "full_name"], {"bad_id": _whole(line, "id", 1), "bad_full_name": _owner_slash_name(line, "full_name")})


def observation_violations(rows: DataFrame, line: str, day: str) -> DataFrame:
    """JSON lines that are not ``{id, stars, observed_at}`` with a UTC timestamp of the partition's ``day``."""
    at = _text(line, "observed_at")
    stamp = at.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$") & F.try_to_timestamp(at, F.lit("yyyy-MM-dd'T'HH:mm:ssX")).isNotNull()
    # of a sound timestamp only: the day is judged where there is one
    same = ~F.coalesce(stamp, F.lit(False)) | (F.substring(at, 1, 10) == day)
    return _json_rules(rows, line, ["id", "stars", "observed_at"], {"bad_id": _whole(line, "id", 1), "bad_stars": _whole(line, "stars", 0), "bad_observed_at": stamp, "other_day": same})


def owner_cache_violations(registered: DataFrame, cache: DataFrame, key: str = "repo", entry: str = "entry") -> DataFrame:
    """Cache entries with other fields, types or names than allowed, and keys that the register or the cache lacks."""
    kinds = {"bad_owner_type": _text(entry, "owner_type").isin("Organization", "User"), "bad_repo_id": _whole(entry, "repo_id", 1), "bad_full_name": _owner_slash_name(entry, "full_name")}
    own = _json_rules(cache, entry, ["owner_type", "repo_id", "full_name"], kinds).select(key, "violations")
    names, there = registered.select(key).distinct(), cache.select(key).distinct()
    gone = names.join(there, key, "left_anti").withColumn("violations", F.array(F.lit("missing")))
    return own.unionByName(gone).unionByName(there.join(names, key, "left_anti").withColumn("violations", F.array(F.lit("extra"))))


def identity_changes(old: DataFrame, new: DataFrame, key: str = "github_repo") -> DataFrame:
    """Cached ids that changed, and User to Organization moves that need confirming."""
    j = old.select(key, F.col("repo_id").alias("o"), F.col("owner_type").alias("ot")).join(new.select(key, F.col("repo_id").alias("n"), F.col("owner_type").alias("nt")), key)
    why = F.when(F.col("o") != F.col("n"), "id_changed").when((F.col("ot") == "User") & (F.col("nt") == "Organization"), "confirm_owner_type")
    return j.select(key, why.alias("violation")).where("violation IS NOT NULL")


def missing_and_extra(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only."""
    x = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("missing"))
    return x.unionByName(b.select(key).distinct().join(a.select(key).distinct(), key, "left_anti").withColumn("side", F.lit("extra")))


def remap(rows: DataFrame, mapping: DataFrame, key: str, outputs: list[str]) -> DataFrame:
    """Old key to new columns; keys that are already new map to themselves; an unknown key raises when read. Applying it twice changes nothing."""
    same = mapping.select(F.col(outputs[-1]).alias(key), *outputs).distinct()
    every = mapping.select(key, *outputs).unionByName(same).dropDuplicates([key])
    got = rows.drop(*[o for o in outputs if o != key]).join(every.withColumnRenamed(key, "_k"), F.col(key) == F.col("_k"), "left")
    return got.withColumn(key, F.when(F.col("_k").isNull(), F.raise_error(F.concat(F.lit("no mapping for "), F.col(key)))).otherwise(F.col(outputs[-1]))).drop("_k")
