"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints: texts are lower-cased (A-Z only), cut at white space (space, 09-0D), and every run of ``size`` words
is hashed by XXH64 (UTF-8, seed 42). A bit is 1 if set in over half the hashes.

Links (at most ``budget`` differing bits) are found on distinct fingerprints. The 64 bits are cut into
``budget + 2`` blocks; fingerprints that differ in at most ``budget`` bits agree in two blocks at least, so each
fingerprint is dealt to every pair of blocks under the bits it has there. Within a task the dealt fingerprints,
rotated so that the agreed bits come first, form a binary trie over sorted integers. Pairs of trie nodes are
traversed together, the differing bits of their paths accumulate, and a pair is dropped as soon as they exceed the
budget. A group's links are reduced to a spanning forest before they leave the task, so copies and dense clusters
never emit all their pairs; the forests' union has the same components as all links. A group of more than ``HOT`` fingerprints
is dealt once more, by its next ``SUB`` bits: every pair of its sub-nodes within the budget is a group of its own.

Defined results: no words (null and empty texts too): fingerprint 0, linked like any other; fewer words than
``size``: the whole sequence is one shingle. A component's id is its smallest non-null doc_id (null where it has
none). Repeated rows give repeated results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.components import connected_components

BITS = 64
NO_ID = 1 << 62  # nodes of fingerprints whose documents all lack an id start here


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; of all words where there are fewer, none without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(lens)])
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    n = len(words) - size + 1
    cuts = zip(starts[:n].tolist(), (starts[size:] - 1).tolist(), strict=True)
    return np.fromiter((digest(view[a:b], 42) for a, b in cuts), np.uint64, n)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, counted a slice at a time: whatever their number, a few megabytes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(h)).tolist()))


def simhash(text: str, size: int = 4) -> int:
    return majority(shingle_hashes(text, size))


def signed(v: int) -> int:
    return v - (1 << BITS) if v >> (BITS - 1) else v


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fp = [signed(simhash(t, size)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fp long")


def block_bounds(budget: int) -> list[tuple[int, int]]:
    n = budget + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


class _Forest:
    """Union-find over array positions, merged by whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: np.ndarray) -> np.ndarray:
        r = self.root[i]
        while True:
            up = self.root[r]
            if (up == r).all():
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge and return the links that joined two trees (a spanning forest of what is new)."""
        keep_a, keep_b = [], []
        while len(a):
            ra, rb = self.find(a), self.find(b)
            new = ra != rb
            a, b, ra, rb = a[new], b[new], ra[new], rb[new]
            if not len(a):
                break
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            # each larger root hooks onto one smaller root a round; no cycles, as roots only decrease
            _, first = np.unique(hi, return_index=True)
            self.root[hi[first]] = lo[first]
            keep_a.append(a[first])
            keep_b.append(b[first])
            rest = np.ones(len(a), bool)
            rest[first] = False
            a, b = a[rest], b[rest]
        self.root = self.find(np.arange(len(self.root)))
        none = np.zeros(0, int)
        return (np.concatenate(keep_a), np.concatenate(keep_b)) if keep_a else (none, none)


HOT, SUB = 50_000, 3
LEAF = 8  # node pairs of at most this many values a side are compared value by value
FRONT = 200_000  # node pairs expanded at a time
LEAF_PAIRS = 2_000_000  # values compared at a time


def trie_links(values: np.ndarray, groups: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of pairs within ``budget`` bits, among equal ``groups``.

    ``values`` (unsigned) are sorted by (group, value); bits above ``depth`` are equal
    within a group, so each group is one trie node at that depth. Returns positions.
    """
    forest = _Forest(len(values))
    none = np.zeros(0, int)
    if not len(values):
        return none, none
    edge = np.flatnonzero(np.diff(groups) != 0) + 1
    lo = np.concatenate([[0], edge])
    hi = np.concatenate([edge, [len(values)]])
    got = [forest.link(a, b) for a, b in trie_pairs(values, np.stack([lo, hi, lo, hi], axis=1), depth, budget)]
    return (np.concatenate([a for a, _ in got]), np.concatenate([b for _, b in got])) if got else (none, none)


def trie_pairs(values: np.ndarray, frames: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within ``budget`` bits, in parts of bounded size.

    A frame is a pair of trie nodes, the sorted ranges [alo, ahi) and [blo, bhi), equal above ``depth``: the same range twice
    or two ranges of which the first comes before the second.
    """
    frames = frames[(frames[:, 1] > frames[:, 0]) & (frames[:, 3] > frames[:, 2])]
    frames = frames[~((frames[:, 0] == frames[:, 2]) & (frames[:, 1] - frames[:, 0] == 1))]
    # ``at``: the next bit to branch on; ``err``: bits in which the paths differ
    stack = [(frames, np.full(len(frames), depth, np.int64), np.zeros(len(frames), np.int64))]
    while stack:
        node, at, err = stack.pop()
        if len(node) > FRONT:
            stack.append((node[FRONT:], at[FRONT:], err[FRONT:]))
            node, at, err = node[:FRONT], at[:FRONT], err[:FRONT]
        na, nb = node[:, 1] - node[:, 0], node[:, 3] - node[:, 2]
        small = ((na <= LEAF) & (nb <= LEAF)) | (at < 0)
        if small.any():
            yield from _leaf_pairs(values, node[small], budget)
        node, at, err = node[~small], at[~small], err[~small]
        if not len(node):
            continue
        mid_a = _split(values, node[:, 0], node[:, 1], at)
        same = (node[:, 0] == node[:, 2]) & (node[:, 1] == node[:, 3])
        mid_b = _split(values, node[:, 2], node[:, 3], at)
        kids, errs, ats = [], [], []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            a0, a1 = (node[:, 0], mid_a) if x == 0 else (mid_a, node[:, 1])
            b0, b1 = (node[:, 2], mid_b) if y == 0 else (mid_b, node[:, 3])
            e = err + (x != y)
            ok = (a1 > a0) & (b1 > b0) & (e <= budget)
            if (x, y) == (1, 0):
                ok &= ~same  # its mirror image is already there
            # a single value paired with itself has no links
            ok &= ~((a0 == b0) & (a1 == b1) & (a1 - a0 == 1))
            kids.append(np.stack([a0, a1, b0, b1], axis=1)[ok])
            errs.append(e[ok])
            ats.append((at - 1)[ok])
        kid = np.concatenate(kids)
        if len(kid):
            stack.append((kid, np.concatenate(ats), np.concatenate(errs)))


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """First position in [lo, hi) whose ``bit`` is set: a binary search for all nodes at once."""
    a, b = lo.copy(), hi.copy()
    shift = bit.astype(np.uint64)
    while True:
        open_ = a < b
        if not open_.any():
            return a
        mid = (a + b) // 2
        one = ((values[np.minimum(mid, len(values) - 1)] >> shift) & np.uint64(1)).astype(bool)
        b = np.where(open_ & one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)


def _leaf_pairs(values: np.ndarray, node: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    size = (node[:, 1] - node[:, 0]) * (node[:, 3] - node[:, 2])
    if size.max() > LEAF_PAIRS:  # many equal values: rows of the first range in slices
        big = node[size > LEAF_PAIRS]
        step = np.maximum(1, LEAF_PAIRS // (big[:, 3] - big[:, 2]))
        for (a0, a1, b0, b1), k in zip(big.tolist(), step.tolist(), strict=True):
            for lo in range(a0, a1, k):
                for bo in range(b0, b1, LEAF_PAIRS):
                    yield from _compare(values, np.array([[lo, min(a1, lo + k), bo, min(b1, bo + LEAF_PAIRS)]]), budget)
        node, size = node[size <= LEAF_PAIRS], size[size <= LEAF_PAIRS]
    at = 0
    total = np.cumsum(size)
    while at < len(node):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + LEAF_PAIRS, "right")))
        yield from _compare(values, node[at:stop], budget)
        at = stop


def _compare(values: np.ndarray, node: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    na, nb = node[:, 1] - node[:, 0], node[:, 3] - node[:, 2]
    count = na * nb
    which = np.repeat(np.arange(len(node)), count)
    k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    a, b = node[which, 0] + k // nb[which], node[which, 2] + k % nb[which]
    ok = a < b
    a, b = a[ok], b[ok]
    near = np.bitwise_count(values[a] ^ values[b]) <= budget
    if near.any():
        yield a[near], b[near]


def links(nodes: DataFrame, budget: int = 4, hot: int = HOT) -> DataFrame:
    """Spanning links (u, v) over ``nodes(node, fp)`` with distinct fp, u and v node ids."""
    bounds = block_bounds(budget)
    pairs = list(itertools.combinations(range(len(bounds)), 2))

    def key(i: int, j: int):
        parts = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in (bounds[i], bounds[j])]
        free = next(lo for k, (lo, _) in enumerate(bounds) if k not in (i, j))
        return F.struct(
            F.lit(i * len(bounds) + j).alias("combo"), F.shiftleft(parts[0], bounds[j][1] - bounds[j][0]).bitwiseOR(parts[1]).alias("bits"),
            F.shiftrightunsigned("fp", free).bitwiseAND(F.lit((1 << SUB) - 1)).cast("int").alias("sub"),
        )

    dealt = nodes.select("node", "fp", F.explode(F.array(*[key(i, j) for i, j in pairs])).alias("k")).select("k.combo", "k.bits", "k.sub", "fp", "node")
    large = dealt.groupBy("combo", "bits").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).hint("merge")
    # a sub-node of a large group meets every other within the budget, and itself
    other = F.filter(F.sequence(F.lit(0), F.lit((1 << SUB) - 1)), lambda t: F.bit_count(t.bitwiseXOR(F.col("sub"))) <= budget)
    parts = F.transform(other, lambda t: F.least(t, F.col("sub")) * (1 << SUB) + F.greatest(t, F.col("sub")))
    parted = dealt.join(large, ["combo", "bits"], "left").select("combo", "bits", F.explode(F.when(F.col("_n").isNull(), F.array(F.lit(-1))).otherwise(parts)).alias("part"), "fp", "node")
    laid = parted.repartition("combo", "bits", "part").sortWithinPartitions("combo", "bits", "part", "fp")

    def run(batches):
        import pyarrow as pa

        def edges(table):
            return np.flatnonzero(np.any([np.diff(table.column(k).to_numpy()) != 0 for k in range(3)], axis=0))

        def solve(table):
            combo = table.column(0).to_numpy()
            fp, node = table.column(3).to_numpy().view(np.uint64), table.column(4).to_numpy()
            group = np.zeros(len(fp), np.int64)
            group[edges(table) + 1] = 1
            group = np.cumsum(group)
            size = np.bincount(group)
            keep = size[group] > 1
            fp, node, group, combo = fp[keep], node[keep], group[keep], combo[keep]
            for c in np.unique(combo):
                at = combo == c
                i, j = divmod(int(c), len(bounds))
                moved = _front(fp[at], bounds[i], bounds[j])
                order = np.lexsort((moved, group[at]))
                width = sum(hi - lo for lo, hi in (bounds[i], bounds[j]))
                a, b = trie_links(moved[order], group[at][order], BITS - 1 - width, budget)
                n = node[at][order]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(n[a]), pa.array(n[b])], ["u", "v"])

        # groups arrive whole and in order: solve what is complete, keep the last group; look again when twice as much is held
        held, rows, most = [], 0, 200_000
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < most:
                continue
            table = pa.concat_tables(held)
            cut = edges(table)
            if len(cut):
                yield from solve(table.slice(0, int(cut[-1]) + 1))
                table = table.slice(int(cut[-1]) + 1)
            held, rows = [table], table.num_rows
            most = max(200_000, 2 * rows)
        if rows:
            yield from solve(pa.concat_tables(held))

    return laid.mapInArrow(run, "u long, v long")


def _front(fp: np.ndarray, first: tuple[int, int], second: tuple[int, int]) -> np.ndarray:
    """The same bits in another order: the two agreed blocks on top, the rest below."""
    out = np.zeros(len(fp), np.uint64)
    rest = [b for b in ((0, first[0]), (first[1], second[0]), (second[1], BITS)) if b[1] > b[0]]
    at = BITS
    for lo, hi in (second, first, *reversed(rest)):
        w = hi - lo
        at -= w
        out |= ((fp >> np.uint64(lo)) & np.uint64((1 << w) - 1)) << np.uint64(at)
    return out


def near_duplicates(docs: DataFrame, size: int = 4, budget: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    prints = materialize(fingerprints(docs, size), "prints")
    no_id = F.lit(NO_ID).bitwiseOR(F.col("fp").bitwiseAND(F.lit(NO_ID - 1)))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).select("fp", F.coalesce("least", no_id).alias("node")), "nodes")
    part = connected_components(links(nodes, budget))
    named = materialize(
        nodes.join(part.hint("merge"), "node", "left").select("fp", F.coalesce("component", "node").alias("component")), "named"
    )
    component = F.when(F.col("component") < F.lit(NO_ID), F.col("component"))
    return prints.join(named.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))
