"""Distinct dependents of packages and of the entities that own them, their set fingerprints and sketches.

``facts(snapshot, package, dependent, dep_system, direct)``; ``panel(entity, package)`` maps packages to entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHOLE = "__SYSTEM__"


def fingerprint64(c: Column | str) -> Column:
    """A positive 60-bit number from the SHA-256 of a value's text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 15), 16, 10).cast("long")


def on_panel(facts: DataFrame, panel: DataFrame) -> DataFrame:
    """Facts of panel packages with their entity; the join strategy is left to the sizes."""
    return facts.join(panel, "package")


def without_own(rows: DataFrame, own: DataFrame) -> DataFrame:
    """Drop dependents that the panel owns itself (``own(dependent)``); null-safe, unlike NOT IN."""
    return rows.join(own, "dependent", "left_anti")


def distinct_counts(rows: DataFrame) -> DataFrame:
    """Direct and any-depth distinct dependents per (entity, package) and per entity (package ``__SYSTEM__``).

    Rows are first brought to one per (entity, package, dependent) and those to one per (entity, dependent), so that plain
    counts are distinct counts: no row is expanded for them, and each level is partially aggregated.
    """
    once = rows.groupBy("entity", "package", "dependent").agg(F.max("direct").alias("direct"))
    tally = [F.count_if(F.col("direct") & F.col("dependent").isNotNull()).alias("direct_dependents"), F.count("dependent").alias("all_dependents")]
    each = once.groupBy("entity", "package").agg(*tally)
    whole = once.groupBy("entity", "dependent").agg(F.max("direct").alias("direct")).groupBy("entity").agg(*tally)
    present = each.groupBy("entity").agg(F.count("package").alias("packages_present"))
    whole = whole.join(present, "entity").select("entity", F.lit(WHOLE).alias("package"), "direct_dependents", "all_dependents", "packages_present")
    return whole.unionByName(each.select("entity", F.col("package").cast("string").alias("package"), "direct_dependents", "all_dependents", F.col("package").isNotNull().cast("long").alias("packages_present")))


def xor_fingerprint(rows: DataFrame, key: str = "entity", member: str = "dependent", distinct: bool = True) -> DataFrame:
    """Order-free fingerprint of each group's member set; ``distinct=False`` lets even repeats cancel."""
    pairs = rows.select(key, member)
    return (pairs.distinct() if distinct else pairs).groupBy(key).agg(F.bit_xor(fingerprint64(member)).alias("xor_fp"))


def bottom_k(rows: DataFrame, k: int = 64, key: str = "entity", member: str = "dependent") -> DataFrame:
    """The ``k`` smallest distinct fingerprints of each group; limited before they are gathered."""
    fps = rows.select(key, fingerprint64(member).alias("fp")).distinct()
    few = fps.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy("fp"))).where(F.col("_rn") <= k)
    return few.groupBy(key).agg(F.array_sort(F.collect_list("fp")).alias("sketch"))


def sketch_jaccard(a: DataFrame, b: DataFrame, k: int = 64, key: str = "entity") -> DataFrame:
    """Jaccard estimate of two sketches of one group: the share of the union's ``k`` smallest that both hold."""
    both = a.select(key, F.col("sketch").alias("sa")).join(b.select(key, F.col("sketch").alias("sb")), key)
    least = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = both.withColumn("u", least)
    return both.select(key, (F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb")) / F.size("u")).alias("jaccard"))


def heavy_hitters(rows: DataFrame, by: str, of: str, k: int = 8) -> DataFrame:
    """The ``k`` most frequent values of each group, exactly; ties by value. ``F.approx_top_k`` is the sketch form."""
    n = rows.groupBy(by, of).agg(F.count("*").alias("n"))
    w = Window.partitionBy(by).orderBy(F.desc("n"), of)
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def heavy_hitters_approx(rows: DataFrame, by: str, of: str, k: int = 8) -> DataFrame:
    return rows.groupBy(by).agg(F.expr(f"approx_top_k({of}, {k})").alias("top"))


def coverage(panel: DataFrame, counts: DataFrame, key: str = "entity") -> DataFrame:
    """Every panel entity with ``matched`` or ``not_in_snapshot``; absence stays null, never zero."""
    whole = counts.where(F.col("package") == WHOLE).drop("package")
    return panel.select(key).distinct().join(whole, key, "left").withColumn("coverage", F.when(F.col("all_dependents").isNotNull(), "matched").otherwise("not_in_snapshot"))


def panel_union(*parts: DataFrame) -> DataFrame:
    """Several (entity, package) lists as one set."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def retention_tripwire(facts: DataFrame) -> DataFrame:
    return facts.groupBy("snapshot").agg(F.count("*").alias("n")).agg(F.min("snapshot").alias("oldest"), F.max("snapshot").alias("newest"), F.count("*").alias("partitions"), F.sum("n").alias("total_rows"))


def canary_present(rows: DataFrame, canaries: list[str], key: str = "entity") -> DataFrame:
    """(canaries_seen, ok): a capture without any canary must be refused."""
    return rows.agg(F.countDistinct(F.when(F.col(key).isin(canaries), F.col(key))).alias("canaries_seen")).withColumn("ok", F.col("canaries_seen") > 0)
