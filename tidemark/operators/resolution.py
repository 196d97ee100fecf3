"""Entity resolution that merges on hard evidence only, and prospect ids that expire.

Merging wrongly cannot be undone, so it needs more evidence than leaving apart. Records are equivalent only by a hard key: the
same content digest, the same external identifier, or the same core name with every discriminating attribute present and
equal (an absent attribute counts as unlike). What such keys chain together is merged only as a whole: a cluster with too
many records or too many owners is vetoed and its records stay apart, for review.

Clusters up to a size are found in as many rounds less one; nothing runs until a fixed point. After them a cluster of
that size at most is closed (no key joins it with another label), and what is not closed is larger, hence vetoed. Keys with
more records than that never enter a round: their records carry a taint instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import stored

SALTS = 8


def hard_keys(records: DataFrame, axes: list[str]) -> DataFrame:
    """(record_id, key) of every hard key. ``records(record_id, owner, core, digest, external_id, <axes>)``."""
    every = [F.col(a).isNotNull() for a in axes]
    like = F.concat_ws("\x1f", F.lit("core"), "core", *(F.col(a).cast("string") for a in axes))
    whole = F.col("core").isNotNull()
    for e in every:
        whole = whole & e
    keys = F.array_compact(F.array(F.when(F.col("digest").isNotNull(), F.concat(F.lit("digest\x1f"), "digest")), F.when(F.col("external_id").isNotNull(), F.concat(F.lit("external\x1f"), "external_id")), F.when(whole, like)))
    return records.select("record_id", F.explode(keys).alias("key")).distinct()


def clusters(records: DataFrame, axes: list[str], max_records: int = 3, max_owners: int = 1) -> DataFrame:
    """(record_id, cluster_id, state, records, owners) of every record.

    ``state``: ``single`` (no equivalent), ``merged`` or ``vetoed``; a vetoed or single record is a cluster of its own. ``records`` and
    ``owners`` count the cluster that the keys chain together, null where it is larger than was looked at.
    """
    keys = hard_keys(records, axes)
    # a frequent key's rows are spread over salts before they meet its count
    n = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    shared = keys.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")).join(n, ["key", "salt"]).drop("salt")
    large = shared.where(F.col("n") > max_records).select("record_id").distinct().withColumn("taint", F.lit(True))
    links = stored(shared.where(F.col("n") <= max_records).select("record_id", "key"), "links")
    label = records.select("record_id", "owner").join(large, "record_id", "left").select("record_id", "owner", F.col("record_id").alias("label"), F.coalesce("taint", F.lit(False)).alias("taint"))
    for _ in range(max_records - 1):
        near = links.join(label, "record_id").groupBy("key").agg(F.min("label").alias("label"), F.bool_or("taint").alias("taint"))
        best = links.join(near, "key").groupBy("record_id").agg(F.min("label").alias("_label"), F.bool_or("taint").alias("_taint"))
        label = label.join(best, "record_id", "left").select("record_id", "owner", F.least("label", "_label").alias("label"), (F.col("taint") | F.coalesce("_taint", F.lit(False))).alias("taint"))
        label = stored(label, "labels")
    open_ = links.join(label, "record_id").groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    open_ = open_.select(F.explode(F.array("lo", "hi")).alias("label")).distinct().withColumn("_open", F.lit(True))
    size = label.groupBy("label").agg(F.count("*").alias("records"), F.countDistinct("owner").alias("owners"), F.bool_or("taint").alias("tainted")).join(open_, "label", "left")
    veto = F.col("tainted") | F.col("_open").isNotNull() | (F.col("records") > max_records) | (F.col("owners") > max_owners)
    known = ~(F.col("tainted") | F.col("_open").isNotNull())
    # no label has more rows than the rounds could reach, unless it is vetoed
    got = label.join(size.withColumns({"veto": veto, "known": known}).drop("tainted", "_open"), "label")
    state = F.when(F.col("veto"), "vetoed").when(F.col("records") > 1, "merged").otherwise("single")
    return got.select(
        "record_id", F.when(state == "merged", F.col("label")).otherwise(F.col("record_id")).alias("cluster_id"), state.alias("state"),
        F.when(F.col("known"), F.col("records")).alias("records"), F.when(F.col("known"), F.col("owners")).alias("owners"),
    )


def review_band(records: DataFrame, resolved: DataFrame) -> DataFrame:
    """``resolved`` with ``review``: the name stands for several clusters, or the cluster was vetoed. Pairs are not listed."""
    named = resolved.join(records.select("record_id", "core"), "record_id")
    several = named.groupBy("core").agg(F.count_distinct("cluster_id").alias("clusters")).where("core IS NOT NULL AND clusters > 1")
    spread = several.select("core", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("_several"))
    j = named.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")).join(spread, ["core", "salt"], "left")
    return j.withColumn("review", F.coalesce("_several", F.lit(False)) | (F.col("state") == "vetoed")).select(*resolved.columns, "review")


def prospect_id(record_id: Column) -> Column:
    return F.concat(F.lit("p_"), F.substring(F.sha2(record_id.cast("string"), 256), 1, 16))


def promoted(records: DataFrame, resolved: DataFrame, evidence: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """(record_id, cluster_id, id, id_state): what a record's id is at ``as_of``.

    Every record begins with a prospect id, at its ``first_seen``. Within ``days`` of it, ``evidence(record_id, kind, at)`` of kind ``human``
    promotes the record, evidence of kind ``hard_id`` promotes it unless its cluster was vetoed; promotion of one record of a merged
    cluster promotes all that are in their own time then. Without it the prospect expires. Evidence after ``as_of``, or after
    the time is over, is not looked at.
    """
    here = records.select("record_id", "first_seen").where(F.col("first_seen") <= as_of).join(resolved.select("record_id", "cluster_id", "state"), "record_id")
    end = F.col("first_seen") + F.make_dt_interval(F.lit(days))
    told = evidence.where(F.col("at") <= as_of).join(here, "record_id").where((F.col("at") >= F.col("first_seen")) & (F.col("at") <= end) & ((F.col("kind") == "human") | ((F.col("kind") == "hard_id") & (F.col("state") != "vetoed"))))
    first = told.groupBy("cluster_id").agg(F.min("at").alias("at"))
    j = here.join(first, "cluster_id", "left")
    good = F.col("at").isNotNull() & (F.col("at") >= F.col("first_seen")) & (F.col("at") <= end)
    state = F.when(good, "permanent").when(as_of > end, "expired").otherwise("prospect")
    name = F.when(good, F.concat(F.lit("e_"), F.substring(F.sha2(F.col("cluster_id").cast("string"), 256), 1, 16))).otherwise(prospect_id(F.col("record_id")))
    return j.select("record_id", "cluster_id", name.alias("id"), state.alias("id_state"))
