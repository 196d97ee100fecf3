"""Content identity of tables and files: digests, Merkle roots, hash chains, collisions, shards, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.placement import positioned

GENESIS = "0" * 64


def row_hash(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``row_sha``: SHA-256 of a row's canonical text: per column, in name order, its name, the length of its value and the value."""
    def part(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.concat(F.lit(f"{name}="), F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("null")))

    return df.withColumn("row_sha", F.sha2(F.concat_ws(";", *map(part, sorted(columns or df.columns))), 256))


def table_digest(df: DataFrame, keys: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """One digest of all rows (per ``keys``), whatever their order or partitioning.

    Row hashes are added up word by word (four words of 64 bits), so partial sums are all that moves; the digest is the
    SHA-256 of the number of rows and the four sums. Repeated rows count as often as they occur.
    """
    keys = keys or []
    h = row_hash(df, columns).select(*keys, "row_sha")
    word = lambda i: F.conv(F.substring("row_sha", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)")
    part = h.groupBy(*keys).agg(F.count("*").alias("rows"), *(F.sum(word(i)).alias(f"_s{i}") for i in range(4)))
    text = F.concat(F.col("rows").cast("string"), F.lit(":"), F.concat_ws(",", *(F.col(f"_s{i}").cast("string") for i in range(4))))
    return part.select(*keys, F.sha2(text, 256).alias("digest"), "rows")


def same_table(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets of rows."""
    return not a.exceptAll(b).limit(1).count() and not b.exceptAll(a).limit(1).count()


def merkle_leaves(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, leaf): SHA-256 of 00, the path, 00 and the bytes."""
    zero = F.unhex(F.lit("00"))
    leaf = F.sha2(F.concat(zero, F.encode(F.col(path), "UTF-8"), zero, F.col(content).cast("binary")), 256)
    return files.select(F.col(path).alias("path"), leaf.alias("leaf"))


def merkle_root(leaves: DataFrame) -> str:
    """Root over leaves in path order; an odd node is promoted; no leaves: the hash of nothing.

    Positions come from the stored placement, so no task sees all leaves; each level halves the table.
    """
    level = positioned(leaves, ["path"]).select("pos", F.col("leaf").alias("h"))
    n = level.count()
    if not n:
        return "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    depth = 0
    while n > 1:
        pair = level.groupBy(F.floor(F.col("pos") / 2).alias("pos")).agg(F.min_by("h", "pos").alias("l"), F.max_by("h", "pos").alias("r"), F.count("*").alias("k"))
        node = F.sha2(F.concat(F.unhex(F.lit("01")), F.unhex("l"), F.unhex("r")), 256)
        level = pair.select("pos", F.when(F.col("k") == 2, node).otherwise(F.col("l")).alias("h"))
        n, depth = (n + 1) // 2, depth + 1
        if n <= 4096:
            break
    # at most 4096 nodes remain: they are folded in one place
    rows = [bytes.fromhex(r["h"]) for r in level.orderBy("pos").collect()]
    import hashlib

    while len(rows) > 1:
        rows = [hashlib.sha256(b"\1" + rows[i] + rows[i + 1]).digest() if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
    return rows[0].hex()


def verify_root(leaves: DataFrame, recorded: str) -> bool:
    """Does a recorded root still stand for the leaves?"""
    return merkle_root(leaves) == recorded


def chain(rows: DataFrame, line: str, seq: str) -> DataFrame:
    """``expected``: the hash of the line before (a fixed start for the first), in the order of ``seq``.

    The line before is the row at the place before in a stored order, so no task sees the whole chain.
    """
    placed = positioned(rows, [seq], "_pos")
    before = placed.select((F.col("_pos") + 1).alias("_pos"), F.sha2(F.col(line), 256).alias("expected"))
    return placed.join(before, "_pos", "left").withColumn("expected", F.coalesce("expected", F.lit(GENESIS))).drop("_pos")


def broken_links(rows: DataFrame, line: str, seq: str, prev: str) -> DataFrame:
    """Records of a stored chain whose ``prev`` is not the hash of the line before."""
    return chain(rows, line, seq).where(~F.col(prev).eqNullSafe(F.col("expected")))


def divergent(bundles: DataFrame) -> DataFrame:
    """(snapshot_id, payloads) of ids that stand for several contents."""
    return bundles.groupBy("snapshot_id").agg(F.countDistinct("payload").alias("payloads")).where("payloads > 1")


def collisions(bundles: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """(snapshot_id, day_a, hash_a, day_b, hash_b) of pairs of contents of one id that no errata excuse. ``bundles(snapshot_id, day, payload)``.

    Two contents are excused only if every pair of their days is excused (``allowed(snapshot_id, day_a, hash_a, day_b, hash_b)``,
    either way round). A pair that is not is reported once, with the first pair of days that no erratum names.

    Only ids that stand for several contents are paired. Days are counted, not paired: the work is that of the bundles and the errata.
    """
    days = bundles.select("snapshot_id", "day", "payload").distinct().join(divergent(bundles).select("snapshot_id"), "snapshot_id", "left_semi")
    one = days.groupBy("snapshot_id", "payload").agg(F.min("day").alias("day"), F.count("*").alias("n"))
    a, b = (one.select("snapshot_id", F.col("day").alias(f"day_{s}"), F.col("payload").alias(f"hash_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    pairs = a.join(b, "snapshot_id").where("hash_a < hash_b")
    if allowed is None:
        return pairs.drop("n_a", "n_b")
    # errata with the smaller content first, and of those only what names days that are there
    turned = F.col("hash_a") > F.col("hash_b")
    swap = lambda x: F.when(turned, F.col(f"{x}_b")).otherwise(F.col(f"{x}_a")).alias(f"{x}_a"), lambda x: F.when(turned, F.col(f"{x}_a")).otherwise(F.col(f"{x}_b")).alias(f"{x}_b")
    named = allowed.select("snapshot_id", *(f(x) for x in ("day", "hash") for f in swap)).distinct()
    for s in "ab":
        named = named.join(days.select("snapshot_id", F.col("day").alias(f"day_{s}"), F.col("payload").alias(f"hash_{s}")), ["snapshot_id", f"day_{s}", f"hash_{s}"], "left_semi")
    enough = named.groupBy("snapshot_id", "hash_a", "hash_b").agg(F.count("*").alias("named"))
    left = pairs.join(enough, ["snapshot_id", "hash_a", "hash_b"], "left").where("named IS NULL OR named < n_a * n_b")
    none, some = left.where("named IS NULL"), left.where("named IS NOT NULL").select("snapshot_id", "hash_a", "hash_b", "n_b")
    # the first day of a that is not named with every day of b, and the first day of b that is not named with it
    side = lambda s: days.select("snapshot_id", F.col("day").alias(f"day_{s}"), F.col("payload").alias(f"hash_{s}"))
    per_day = named.groupBy("snapshot_id", "hash_a", "hash_b", "day_a").agg(F.count("*").alias("named"))
    first_a = some.join(side("a"), ["snapshot_id", "hash_a"]).join(per_day, ["snapshot_id", "hash_a", "hash_b", "day_a"], "left").where("named IS NULL OR named < n_b")
    first_a = first_a.groupBy("snapshot_id", "hash_a", "hash_b").agg(F.min("day_a").alias("day_a"))
    key = ["snapshot_id", "day_a", "hash_a", "day_b", "hash_b"]
    first_b = first_a.join(side("b"), ["snapshot_id", "hash_b"]).join(named.select(key), key, "left_anti")
    return none.select(key).union(first_b.groupBy("snapshot_id", "day_a", "hash_a", "hash_b").agg(F.min("day_b").alias("day_b")).select(key))


def shards(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Contiguous shards whose sizes differ by at most one, the first ones larger (the rule of NTILE, without its single task)."""
    p = positioned(df, order, "_pos")
    total = df.agg(F.count("*").alias("_t"))
    small, extra = F.floor(F.col("_t") / n), F.col("_t") % n
    edge = extra * (small + 1)
    got = F.when(F.col("_pos") < edge, F.floor(F.col("_pos") / (small + 1))).otherwise(extra + F.floor((F.col("_pos") - edge) / F.greatest(small, F.lit(1))))
    return p.join(F.broadcast(total)).withColumn("shard", got.cast("long")).drop("_t", "_pos")


def first_of(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def merge_checked(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Union of two tables as a set; one key with two values raises when read."""
    n = a.select(key, value).unionByName(b.select(key, value)).groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return n.select(key, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.raise_error(F.concat(F.lit("conflict on "), F.col(key).cast("string")))).alias(value))


def reconcile(expected: DataFrame, observed: DataFrame, key: str, churn: float = 0.01) -> DataFrame:
    """(expected, observed, extra, absent, ok): no extras, and at most ``churn`` absent."""
    both = expected.select(key, F.lit(1).alias("e")).distinct().join(observed.select(key, F.lit(1).alias("o")).distinct(), key, "full_outer")
    got = both.agg(F.count("e").alias("expected"), F.count("o").alias("observed"), F.count_if(F.col("e").isNull()).alias("extra"), F.count_if(F.col("o").isNull()).alias("absent"))
    return got.withColumn("ok", (F.col("extra") == 0) & (F.col("absent") <= churn * F.col("expected")))


def rewrite_ids(rows: DataFrame, old: str, new: str, day) -> DataFrame:
    """Replace an id in the rows of one capture day only."""
    hit = (F.col("snapshot_id") == old) & (F.to_date("captured_at") == F.lit(day))
    return rows.withColumn("snapshot_id", F.when(hit, F.lit(new)).otherwise(F.col("snapshot_id")))


def rewrite_report(before: DataFrame, after: DataFrame, key: str, old: str, new: str, day) -> DataFrame:
    """(rewritten, touched, ok): rows of a table that changed as :func:`rewrite_ids` changes them, and rows that differ otherwise."""
    want = row_hash(rewrite_ids(before, old, new, day)).select(key, F.col("row_sha").alias("_w"))
    was, now = row_hash(before).select(key, F.col("row_sha").alias("_b")), row_hash(after).select(key, F.col("row_sha").alias("_a"))
    j = want.join(was, key).join(now, key, "full_outer")
    right = F.col("_a").eqNullSafe(F.col("_w"))
    got = j.agg(F.count_if(right & (F.col("_w") != F.col("_b"))).alias("rewritten"), F.count_if(~right).alias("touched"))
    return got.withColumn("ok", F.col("touched") == 0)


def source_manifest(rows: DataFrame, column: str) -> DataFrame:
    """Digest of the distinct values of a column."""
    return table_digest(rows.select(column).where(F.col(column).isNotNull()).distinct())
