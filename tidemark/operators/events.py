"""Snapshot-to-snapshot events and the weekly minutes of a cohort made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: fixed values: events that a cohort's minutes report
NEWSWORTHY = ("measurement_activated", "measurement_resumed", "reference_baseline_added", "reference_baseline_recorded", "axis_available", "history_sufficient", "gate_eligible", "axis_threshold_recorded", "convergence_published", "collection_failed")
#: fixed values: order in which a cohort's minutes are cut
PRIORITY = {
    "convergence_published": 0, "collection_failed": 1, "cohort_added": 2, "coverage_changed": 3, "reference_baseline_recorded": 4, "reference_baseline_added": 4, "gate_eligible": 5,
    "axis_threshold_recorded": 6, "history_sufficient": 7, "axis_available": 8, "measurement_resumed": 9, "measurement_activated": 10, "quiet_week": 11,
}
STATE = ["cohort", "incumbent", "rising", "convergent_axes", "coverage1", "coverage2", "history", "observations", "gate", "signal"]


def pair(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Full outer match of two snapshots of states on entity_id, as structs ``p`` and ``c`` (null where absent)."""
    a = prev.select("entity_id", F.struct(*STATE).alias("p"))
    b = cur.select("entity_id", F.struct(*STATE).alias("c"))
    return a.join(b, "entity_id", "full_outer")


def diff_events(prev: DataFrame, cur: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """(entity_id, cohort, event_kind, detail) of every change; one quiet_week row when nothing changed.

    ``dropped(entity_id)`` are entities whose collection failed: they give that event only. An empty previous snapshot
    gives one baseline_unavailable row. Entities that left without being dropped give nothing.
    """
    both = pair(prev, cur)
    both = both.join(dropped.select("entity_id", F.lit(True).alias("_d")), "entity_id", "left") if dropped is not None else both.withColumn("_d", F.lit(None).cast("boolean"))
    gone = F.coalesce("_d", F.lit(False))
    new, old = F.col("p").isNull(), F.col("p").isNotNull() & F.col("c").isNotNull()

    def ev(cond, kind, detail=None):
        return F.when(cond, F.struct(F.lit(kind).alias("event_kind"), (F.lit(detail) if detail else F.lit(None).cast("string")).alias("detail")))

    none = F.array().cast("array<string>")
    lost = F.array_except(F.coalesce("p.convergent_axes", none), F.coalesce("c.convergent_axes", none))
    got = F.array_except(F.coalesce("c.convergent_axes", none), F.coalesce("p.convergent_axes", none))
    named = lambda arr, kind: F.transform(arr, lambda a: F.struct(F.lit(kind).alias("event_kind"), a.alias("detail")))
    baseline = old & F.col("c.incumbent") & F.col("c.rising") & ~F.col("p.rising")
    single = F.array_compact(F.array(
        ev(new & F.col("c.incumbent"), "reference_baseline_added"),
        ev(new & ~F.col("c.incumbent") & (F.col("c.observations") > 1), "measurement_resumed"),
        ev(new & ~F.col("c.incumbent") & (F.col("c.observations") <= 1), "measurement_activated"),
        ev(old & (F.col("p.coverage1") != "measurable") & (F.col("c.coverage1") == "measurable"), "axis_available", "axis1"),
        ev(old & (F.col("p.coverage2") != "measurable") & (F.col("c.coverage2") == "measurable"), "axis_available", "axis2"),
        ev(old & (F.col("p.history") != "sufficient") & (F.col("c.history") == "sufficient"), "history_sufficient"),
        ev(old & (F.col("p.gate") != "eligible") & (F.col("c.gate") == "eligible"), "gate_eligible"),
        ev(baseline, "reference_baseline_recorded"),
        ev(old & ~baseline & (F.col("c.signal") == "published") & (F.col("p.signal") != "published"), "convergence_published"),
    ))
    empty = F.array().cast("array<struct<event_kind:string,detail:string>>")
    crossed = F.when(old, F.concat(named(got, "axis_threshold_recorded"), named(lost, "axis_threshold_lost"))).otherwise(empty)
    events = F.when(gone, F.array(F.struct(F.lit("collection_failed").alias("event_kind"), F.lit(None).cast("string").alias("detail")))).when(F.col("c").isNull(), empty).otherwise(F.concat(single, crossed))
    rows = both.select("entity_id", F.coalesce("c.cohort", "p.cohort").alias("cohort"), F.explode(events).alias("e")).select("entity_id", "cohort", "e.*")
    fixed = lambda kind, df: df.select(F.lit(None).cast(prev.schema["entity_id"].dataType).alias("entity_id"), F.lit(None).cast("string").alias("cohort"), F.lit(kind).alias("event_kind"), F.lit(None).cast("string").alias("detail"))
    n_prev, n_rows = prev.agg(F.count("*").alias("n")), rows.agg(F.count("*").alias("n"))
    return (
        rows.join(F.broadcast(n_prev.where("n > 0")).select(F.lit(1).alias("_k"))).drop("_k")
        .unionByName(fixed("baseline_unavailable", n_prev.where("n = 0")))
        .unionByName(fixed("quiet_week", n_rows.where("n = 0").join(F.broadcast(n_prev.where("n > 0").select(F.lit(1).alias("_k"))))))
    )


def event_id(events: DataFrame, day: str) -> DataFrame:
    """A stable id from the canonical fields of an event."""
    key = F.to_json(F.struct(F.lit(day).alias("day"), F.col("event_kind"), F.col("entity_id").cast("string").alias("entity_id"), F.coalesce("detail", F.lit("")).alias("detail")))
    return events.withColumn("id", F.substring(F.sha2(key, 256), 1, 16))


def feed_items(events: DataFrame, day: str) -> DataFrame:
    """The flat projection a feed writes."""
    e = event_id(events, day)
    return e.select("id", F.when(F.col("event_kind") == "convergence_published", "moment_signal").otherwise("observation").alias("type"), "event_kind", F.initcap(F.replace("event_kind", F.lit("_"), F.lit(" "))).alias("title"), F.lit(day).alias("date_published"), F.array_compact(F.array(F.col("entity_id").cast("string"))).alias("entity_ids"))


def minutes(prev: DataFrame, cur: DataFrame, events: DataFrame, change: float = 0.05, cap: int = 50) -> DataFrame:
    """(cohort, event_kind, entity_id, text) of each cohort of either snapshot, cut to ``cap`` by priority."""
    two = lambda s, t: s.groupBy("cohort").agg(F.count("*").alias(f"{t}n"), F.avg(((F.col("coverage1") == "measurable") & (F.col("coverage2") == "measurable")).cast("double")).alias(f"{t}r"))
    cover = two(prev, "p").join(two(cur, "c"), "cohort", "full_outer").withColumn("pn", F.coalesce("pn", F.lit(0))).withColumn("cn", F.coalesce("cn", F.lit(0)))
    id_type = cur.schema["entity_id"].dataType
    nobody = F.lit(None).cast(id_type).alias("entity_id")
    news = events.where(F.col("event_kind").isin(*NEWSWORTHY) & F.col("cohort").isNotNull()).select("cohort", "event_kind", "entity_id", F.format_string("%s for %s.", F.initcap(F.replace("event_kind", F.lit("_"), F.lit(" "))), F.col("entity_id").cast("string")).alias("text"))
    added = cover.where("pn = 0 AND cn > 0").select("cohort", F.lit("cohort_added").alias("event_kind"), nobody, F.format_string("Cohort added with %d members.", F.col("cn")).alias("text"))
    moved = cover.where((F.col("pn") > 0) & (F.col("cn") > 0) & (F.abs(F.col("cr") - F.col("pr")) > change)).select(
        "cohort", F.lit("coverage_changed").alias("event_kind"), nobody, F.format_string("Two-axis coverage changed from %.1f%% to %.1f%%.", F.col("pr") * 100, F.col("cr") * 100).alias("text")
    )
    some = news.unionByName(added).unionByName(moved)
    quiet = cover.where("cn > 0").select("cohort").join(some.select("cohort").distinct(), "cohort", "left_anti").select("cohort", F.lit("quiet_week").alias("event_kind"), nobody, F.lit("No changes this week.").alias("text"))
    return capped(some.unionByName(quiet), cap)


def capped(rows: DataFrame, cap: int) -> DataFrame:
    """At most ``cap`` rows a cohort, by the priority of their kind; kinds without one come last."""
    rank = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv)), F.col("event_kind")), F.lit(10**6))
    rows = rows.withColumn("_pri", rank)
    w = Window.partitionBy("cohort").orderBy("_pri", "event_kind", F.col("entity_id").asc_nulls_first())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn", "_pri")


def crossed(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Axes newly crossed and lost per entity present in both."""
    x = prev.select("entity_id", F.col("convergent_axes").alias("a")).join(cur.select("entity_id", F.col("convergent_axes").alias("b")), "entity_id")
    return x.select("entity_id", F.array_except("b", "a").alias("recorded"), F.array_except("a", "b").alias("lost"))


def cohort_keys(*sources: DataFrame) -> DataFrame:
    out = sources[0].select("cohort")
    for s in sources[1:]:
        out = out.union(s.select("cohort"))
    return out.distinct()
