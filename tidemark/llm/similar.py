"""Near-duplicates by SimHash, verified by the exact Jaccard similarity of word shingles.

Words as in :mod:`tidemark.llm.simhash`; a text is the set of its runs of ``SIZE`` words. Two texts are linked at a similarity
of 4/5 or more. At that similarity fingerprints lie about ten bits apart, too far for blocks of fingerprint bits to meet, so
fingerprints are dealt by shingles instead: under one order of all shingles, two such texts of at most n shingles share
one of their first n - ceil(4n/5) + 1, whatever the order is. Rare shingles come first (frequencies estimated on a sample), so
a common line joins nothing.

Links are found in three rounds, each of which joins only what the rounds before left unconnected. First, every text of a
shingle's group is compared with the group's least text. Then the groups are joined by the binary trie of
:mod:`tidemark.llm.simhash`: node pairs are traversed together and dropped beyond ``BUDGET`` differing bits, and every text
proposes the nearest one of another component. Last, the same join proposes all pairs that are still open. So a group of
copies sends one pair a member and shingle, not all its pairs. A proposal must also pass a bound that loses no link: two
texts' parity bitmaps differ in at most as many bits as their sets in shingles. Every link is then verified on whole
shingle sets. ``BUDGET`` is five standard deviations above the mean distance of texts at 4/5; nearer
ones are never lost, a pair at 4/5 with a probability below 2e-5 (the most is that of 5 shingles against 4, 1.3e-5).

Defined results: texts without words form one group; fewer words than ``SIZE``: the whole sequence is one shingle.
Texts are known by their 64-bit hash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, maybe_among
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import majority, shingle_hashes, signed, trie_pairs

SIZE, BUDGET, BITS = 5, 26, 2048
SAMPLE, FREQUENT = 5_000, 100_000  # texts that frequencies are estimated on, shingles kept of them; neither changes a result


def shingles(text: str) -> np.ndarray:
    """The distinct shingle hashes, sorted (one, of nothing, for a text without words)."""
    found = shingle_hashes(text, SIZE)
    return np.unique(found.view(np.int64)) if len(found) else np.zeros(1, np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def parity(found: np.ndarray) -> bytes:
    """``BITS`` bits, each the parity of the shingles that fall to it."""
    at = found.view(np.uint64) % np.uint64(BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()


def bitmaps(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of bitmaps, row by row: no more than the shingles in which the sets differ."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def prefix(found: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles that a similar text must share one of: the rarest, ties by hash."""
    n = len(found)
    keep = n - (4 * n + 4) // 5 + 1
    often = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        often = np.where(known[at] == found, counts[at], 0)
    return found[np.lexsort((found, often))[:keep]]


def node(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _near(m: str, n: str, a: str, b: str) -> Column:
    """Sizes and fingerprints that leave a similarity of 4/5 open."""
    return F.expr(f"5 * least({m}, {n}) >= 4 * greatest({m}, {n}) AND bit_count({a} ^ {b}) <= {BUDGET}")


def _kinds(texts: DataFrame) -> DataFrame:
    """(node, size, fp, bits, first) of every text."""
    spark = texts.sparkSession

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([shingles(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int64()))], ["shingles"])

    share = max(1, texts.count() // SAMPLE)
    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).dropDuplicates(["node"]).select("text").mapInArrow(sets, "shingles array<long>")
    often = some.select(F.explode("shingles").alias("s")).groupBy("s").count().where("count > 2").orderBy(F.desc("count"), "s").limit(FREQUENT)
    rows = sorted((r["s"], r["count"]) for r in often.toLocalIterator())
    shared = spark.sparkContext.broadcast((np.array([s for s, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)))

    def brief(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingles(t) for t in batch.column(1).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 256), pa.array([len(f) for f in found], pa.int64()), pa.array([signed(majority(f.view(np.uint64))) for f in found], pa.int64()),
                     pa.array([parity(f) for f in found], pa.binary()), pa.array([prefix(f, *shared.value) for f in found], pa.list_(pa.int64()))], ["node", "size", "fp", "bits", "first"])

    return materialize(texts.mapInArrow(brief, "node long, size long, fp long, bits binary, first array<long>"), "kinds")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) that are similar."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    held = maybe_among(texts, "node", wanted).join(wanted, "node", "left_semi").dropDuplicates(["node"])

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                got = [shingles(t) for t in batch.column(1).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(got, pa.list_(pa.int64()))], ["node", "shingles"])

    found = materialize(held.select("node", "text").mapInArrow(sets, "node long, shingles array<long>"), "sets")
    both = pairs.join(found.toDF("v", "b"), "v").join(found.toDF("u", "a"), "u")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            ok = [similar(a[i].values.to_numpy(), b[i].values.to_numpy()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return materialize(both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long"), "links")


def components(docs: DataFrame) -> DataFrame:
    """(node, component) of the texts that are similar to another; node is the text's xxhash64."""
    texts = docs.select(node().alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    kinds = _kinds(texts)
    by = Window.partitionBy("s")
    marks = kinds.select(F.explode("first").alias("s"), "node")
    shared = marks.select("s", "node", F.min("node").over(by).alias("u"), F.max("node").over(by).alias("top")).where("u < top").select("s", "u", "node").distinct()
    every = materialize(shared, "shared")
    one = materialize(kinds.drop("first").join(every.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "briefs")
    rays = every.where("node <> u").select("u", F.col("node").alias("v")).distinct()
    both = rays.join(one.toDF("v", "n", "b", "y"), "v").join(one.toDF("u", "m", "a", "x"), "u").where(_near("m", "n", "a", "b"))
    tried = materialize(_bounded(both.select("u", "v", "m", "n", "x", "y")), "stars")
    links = _verified(tried, texts)
    part = materialize(connected_components(links), "part")
    for nearest in (True, False):
        parted = every.select("s", "node").join(part, "node", "left").join(one, "node").select("s", "node", "size", "fp", "bits", F.coalesce("component", "node").alias("c"))
        mixed = parted.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo < hi AND n > 2").select("s")
        pairs = materialize(_across(parted.join(mixed, "s", "left_semi"), nearest).distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
        if not pairs.limit(1).count():
            continue
        more = _verified(pairs, texts)
        tried = tried.union(pairs)
        if more.limit(1).count():
            links = links.union(more)
            part = materialize(connected_components(links), "part")
    return part


def _bounded(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of (u, v, sizes, bitmaps) whose bitmaps leave a similarity of 4/5 open; u is the lesser."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ok = 9 * apart(bitmaps(batch.column(4)), bitmaps(batch.column(5))) <= batch.column(2).to_numpy() + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(run, "u long, v long")


def _across(rows: DataFrame, nearest: bool) -> DataFrame:
    """(u, v) with u < v: texts of one shingle and different components whose fingerprints, sizes and bitmaps are near.

    ``nearest``: of each text only its pair of fewest differing bits.
    """

    def run(batches):
        import pyarrow as pa

        def solve(t):
            s, n, size, c = (t.column(k).to_numpy() for k in ("s", "node", "size", "c"))
            fp, bits = t.column("fp").to_numpy().view(np.uint64), bitmaps(t.column("bits"))
            # a group's largest component is compared with the others, not with itself: it comes second
            parts, of, many = np.unique(np.stack([s, c]), axis=1, return_inverse=True, return_counts=True)
            group = np.unique(parts[0], return_inverse=True)[1]
            top = np.zeros(len(many), bool)
            rank = np.lexsort((many, group))
            top[rank[np.flatnonzero(np.diff(group[rank], append=-1))]] = True
            of = of.reshape(-1)
            order = np.lexsort((fp, top[of], group[of]))
            s, n, size, c, fp, bits = s[order], n[order], size[order], c[order], fp[order], bits[order]
            start = np.flatnonzero(np.diff(s, prepend=s[0] - 1 if len(s) else 0))
            stop = np.append(start[1:], len(s))
            mid = start + np.add.reduceat(~top[of][order], start, dtype=np.int64)
            frames = np.concatenate([np.stack([start, mid, start, mid], axis=1), np.stack([start, mid, mid, stop], axis=1)])
            best, mate = np.full(len(n), 1 << 40), np.full(len(n), -1)
            for a, b in trie_pairs(fp, frames, 63, BUDGET):
                ok = (c[a] != c[b]) & (5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b]))
                a, b = a[ok], b[ok]
                for at in range(0, len(a), 100_000):
                    x, y = a[at : at + 100_000], b[at : at + 100_000]
                    far = apart(bits[x], bits[y])
                    ok = 9 * far <= size[x] + size[y]
                    x, y, far = x[ok], y[ok], far[ok]
                    if nearest:
                        for one, other in ((x, y), (y, x)):
                            order_ = np.argsort(-far, kind="stable")  # of equal places the last assignment stays: the nearest
                            i, j, d = one[order_], other[order_], far[order_]
                            less = d < best[i]
                            best[i[less]], mate[i[less]] = d[less], j[less]
                    elif len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(n[x], n[y])), pa.array(np.maximum(n[x], n[y]))], ["u", "v"])
            found = np.flatnonzero(mate >= 0)
            if len(found):
                u, v = n[found], n[mate[found]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            cut = np.flatnonzero(np.diff(held.column("s").to_numpy()))
            if held.num_rows >= 50_000 and len(cut):
                yield from solve(held.slice(0, int(cut[-1]) + 1))
                held = held.slice(int(cut[-1]) + 1)
        if held is not None and held.num_rows:
            yield from solve(held)

    return rows.repartition("s").sortWithinPartitions("s").mapInArrow(run, "u long, v long")
