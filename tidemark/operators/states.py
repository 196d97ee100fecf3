"""Typed measurement states, their wording, history reject reasons, version-dependent thresholds, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORY_REQUIRED = 4


def measurement_state(rows: DataFrame, version: str = "m2") -> DataFrame:
    """Coverage and reason per axis, history, gate and signal of scored rows with ``observations`` (weekly count).

    A rising row without two measurable convergent axes is refused (raises when read).
    """
    z1, z2 = F.col("axis1_z"), F.col("axis2_z")
    has = lambda a: F.array_contains("axes_present", a)
    cov1 = F.when(F.col("axis1_slope").isNull(), "no_data").when(z1.isNull() | ~has("axis1"), "insufficient_source_coverage").otherwise("measurable")
    why1 = F.when(F.col("axis1_slope").isNull(), F.lit(None)).when(z1.isNull(), "cohort_z_unavailable").when(~has("axis1"), "axis_not_declared_measurable")
    st = F.col("axis2_status")
    cov2 = F.when(st == "absent", "source_not_measured").when(st == "insufficient", "insufficient_source_coverage").when(F.col("axis2_slope").isNull(), "no_data").when(z2.isNull() | ~has("axis2"), "insufficient_source_coverage").otherwise("measurable")
    why2 = F.when(st == "insufficient", "source_returned_too_few").when((st == "present") & F.col("axis2_slope").isNotNull() & z2.isNull(), "cohort_z_unavailable").when((st == "present") & F.col("axis2_slope").isNotNull() & ~has("axis2"), "axis_not_declared_measurable")
    x = rows.withColumn("coverage1", cov1).withColumn("reason1", why1).withColumn("coverage2", cov2).withColumn("reason2", why2)
    x = x.withColumn("measurable", F.when(F.col("coverage1") == "measurable", 1).otherwise(0) + F.when(F.col("coverage2") == "measurable", 1).otherwise(0))
    x = x.withColumn("history", F.when(F.col("observations") >= HISTORY_REQUIRED, "sufficient").otherwise("insufficient"))
    floor = 0 if version == "m1" else 5
    gate = (
        F.when(F.col("history") == "insufficient", "awaiting_observations").when(F.col("measurable") < 2, "awaiting_axis_coverage")
        .when(F.col("incumbent"), "reference_measurement").when(F.col("cohort_n") < floor, "awaiting_cohort_floor").otherwise("eligible")
    )
    bad = F.col("rising") & ((F.size("convergent_axes") < 2) | (F.col("measurable") < 2))
    x = x.withColumn("gate", F.when(bad, F.raise_error(F.concat(F.lit("inconsistent positive signal: "), F.col("entity_id").cast("string"))).cast("string")).otherwise(gate))
    return x.withColumn("signal", F.when(F.col("rising") & (F.col("gate") == "eligible"), "published").otherwise("not_published"))


#: fixed values: the wording of a measurement state; {} are filled from its columns
REASONS = {"cohort_z_unavailable": "cohort comparison unavailable", "source_returned_too_few": "source returned too few observations", "axis_not_declared_measurable": "axis was not declared measurable"}
AXES = {"1": "Development velocity", "2": "Citation"}
MISSING = {"insufficient_source_coverage": "coverage", "source_not_measured": "unmeasured", "no_data": "missing"}
GATES = {
    "awaiting_cohort_floor": "Gate: not computable — cohort below comparison floor", "reference_measurement": "Gate: not computable — reference measurement",
    "eligible": "Gate: computed weekly across the cohort; no convergence event this week",
}


def _lookup(words: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in words.items() for x in kv)), key)


def phrases(state: DataFrame, period: Column) -> DataFrame:
    """(entity_id, history, axis1, axis2, axis_coverage, gate_phrase, signal_phrase, compact): a state of :func:`measurement_state` in words."""
    number = lambda c: F.col(c).cast("int")

    def axis(k: str) -> Column:
        coverage, detail = F.col(f"coverage{k}"), _lookup(REASONS, F.col(f"reason{k}"))
        said = F.when(coverage == "measurable", "axis: measured.").when(coverage == "insufficient_source_coverage", F.concat(F.lit("axis: insufficient source coverage"), F.coalesce(F.concat(F.lit(" ("), detail, F.lit(")")), F.lit("")), F.lit(".")))
        return F.concat(F.lit(AXES[k] + " "), said.when(coverage == "source_not_measured", "source: not measured.").otherwise("axis: no observation data."))

    history = F.when(F.col("history") == "sufficient", F.format_string("History: %d weekly observations; minimum %d.", number("observations"), F.lit(HISTORY_REQUIRED)))
    history = history.otherwise(F.format_string("History: %d of %d weekly observations.", number("observations"), F.lit(HISTORY_REQUIRED)))
    axes = F.concat(number("measurable").cast("string"), F.when(F.col("measurable") == 1, " measurable axis").otherwise(" measurable axes"))
    # the reason is told where exactly one axis is not measurable
    lone = lambda k: F.coalesce(F.when(F.col(f"coverage{k}") == "insufficient_source_coverage", _lookup(REASONS, F.col(f"reason{k}"))), _lookup(MISSING, F.col(f"coverage{k}")))
    why = F.when(F.col("measurable") == 1, F.when(F.col("coverage1") != "measurable", lone("1")).otherwise(lone("2")))
    published = F.col("signal") == "published"
    rising = F.concat(F.lit("Rising signal published for "), period, F.lit("."))
    gate = (
        F.when(published, F.concat(F.lit("Convergence gate: evaluated weekly; "), rising))
        .when(F.col("gate") == "awaiting_observations", F.format_string("Gate: not computable — history %d of %d weekly observations", number("observations"), F.lit(HISTORY_REQUIRED)))
        .when(F.col("gate") == "awaiting_axis_coverage", F.concat(F.format_string("Gate: not computable — %d of 2 axes measurable", number("measurable")), F.coalesce(F.concat(F.lit(" ("), why, F.lit(")")), F.lit(""))))
        .otherwise(_lookup(GATES, F.col("gate")))
    )
    return state.select(
        "entity_id", history.alias("history"), axis("1").alias("axis1"), axis("2").alias("axis2"), F.concat(F.lit("Axis coverage: "), axes, F.lit(".")).alias("axis_coverage"),
        gate.alias("gate_phrase"), F.when(published, rising).otherwise(gate).alias("signal_phrase"), F.when(published, "Rising").otherwise(axes).alias("compact"),
    )


def reject_reason(rows: DataFrame, version: str, cutoff, canonical: DataFrame | None = None) -> DataFrame:
    """The first reason a history row is not used: unreadable, version, entity, period, time, after the cutoff, not canonical."""
    ts = F.try_to_timestamp("captured_at")
    r = (
        F.when(F.col("corrupt").isNotNull(), "parse_error").when(F.col("v").isNull() | (F.col("v") != version), "wrong_version").when(F.col("entity_id").isNull(), "no_entity")
        .when(F.col("period").isNull() | ~F.col("period").rlike("^\\d{4}-w\\d{2}$"), "bad_period").when(ts.isNull(), "bad_timestamp").when(ts > F.to_timestamp(F.lit(cutoff)), "after_cutoff")
    )
    if canonical is None:
        return rows.withColumn("reason", r)
    c = canonical.select("period", F.col("captured_at").alias("_c"))
    return rows.join(c, "period", "left").withColumn("reason", r.when(F.col("_c").isNull() | (F.col("_c") != F.col("captured_at")), "not_canonical")).drop("_c")


def rising_floor(rows: DataFrame, methodology: DataFrame) -> DataFrame:
    """Each row's threshold by its methodology version; an unknown version raises when read."""
    got = rows.join(methodology.select("version", F.col("rising_z").alias("_z")), "version", "left")
    return got.withColumn("rising_z", F.when(F.col("_z").isNull(), F.raise_error(F.concat(F.lit("unknown methodology "), F.col("version"))).cast("double")).otherwise(F.col("_z"))).drop("_z")


def freshness(newest: Column, now, every_hours: int, grace_hours: int) -> Column:
    """ok within the cadence, publishing within the grace after it, stale beyond, unknown without a time."""
    age = (F.unix_timestamp(F.to_timestamp(F.lit(now))) - F.unix_timestamp(newest)) / 3600
    return F.when(newest.isNull(), "unknown").when(age <= every_hours, "ok").when(age <= every_hours + grace_hours, "publishing").otherwise("stale")


def feed_freshness(reached: Column, status: Column, latest: Column, now: Column, most_days: int = 8) -> Column:
    """struct<state, alert, age_days>: unknown where the feed was not reached; stale with an alert at another status than 200, without a readable
    time of the latest entry, or at an age beyond ``most_days``; the age is in whole days, 0 for a time ahead.
    """
    age = (F.unix_micros(now) - F.unix_micros(latest)) / 86_400_000_000
    read = reached & (status == 200)
    state = F.when(~reached, "unknown").when((status != 200) | latest.isNull() | (age > most_days), "stale").otherwise("ok")
    return F.struct(state.alias("state"), (state == "stale").alias("alert"), F.when(read & latest.isNotNull(), F.greatest(F.lit(0), F.floor(age))).cast("long").alias("age_days"))


def capture_health(rows: DataFrame, keys: list[str], failed: Column, limit: float = 0.20) -> DataFrame:
    got = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.avg(failed.cast("double")).alias("error_rate"))
    return got.withColumn("degraded", F.col("error_rate") > limit)


def dependents_coverage(level: Column, found: Column, pinned: Column, pin_version: Column) -> Column:
    """Class of a landed response: fetch_error first, then a broken pin, a version not resolved yet, a match, no match."""
    err = level.isNull() | ((level != 200) & (level != 404))
    return F.when(err, "fetch_error").when(pinned & (level == 404), "pin_broken").when(pinned & pin_version.isNull(), "version_pending").when(found, "matched").otherwise("no_package_match")
