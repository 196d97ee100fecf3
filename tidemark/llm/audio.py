"""Audio fingerprints of media columns by chroma, and the search for recordings that share a passage.

A recording is a binary column of unsigned 8-bit mono PCM. Overlapping frames are transformed, their energy is folded
into twelve pitch classes, and an integral image over (time, pitch class) lets sixteen rectangle filters be read in a
few additions each. Every filter answer is put into one of four levels (two Gray-coded bits), so a frame position gives
one packed 32-bit integer.

Two recordings are aligned by the histogram of position offsets of equal integers, each distinct integer counting once an
offset (a held tone or silence proves no time). At the best offset, bits are compared along the run of positions that agree
best; they match where ``VOTES`` integers or more agree, two of them different and next to each other, and the run has
``LEAST_RUN`` positions or more of which at most ``MAX_ERROR`` of the bits differ. So a short passage inside two long
recordings is found.

The search compares the recordings of a query set with all recordings. A query is fingerprinted at ``PHASES`` shifts within a
hop, as a passage seldom begins on the other recording's frame grid. Equal fingerprints form a class and are searched once.
Candidates share a pair of neighbouring, different integers in one phase: every match does, so none is lost, while silence and
held tones join nothing and chance meetings of single integers are no candidates. Every candidate is aligned.

Links are as many as queries times their near copies, so nothing moves for a pair: queries are dealt to blocks of ``QUERY_INTS``
integers and all classes to slices, and a task holds one block and reads one slice past it. A class moves once a block, a query
once a slice, whatever they match.

The given tables hold no sound, so the registered query renders each document: its UTF-8 bytes are samples of an eighth of the
rate, each held for ``HELD`` samples.

Defined results: a recording under one span of frames is filled up with silence and has one integer; null and empty
recordings have none. Both match nothing. Recordings of under ``LEAST_RUN`` integers are a class if their samples are equal, null and empty ones
one of their own. A class is known by its least doc_id (null where no member has one). A query that matches nothing has one row with
null partner columns; repeated queries give repeated rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

RATE, FRAME, HOP, SPAN = 8000, 1024, 256, 16
VOTES, LEAST_RUN, MAX_ERROR, PHASES = 4, 8, 0.2, 4
EXPECTED = 0.25  # share of differing bits up to which a position lengthens a run
HELD = 8
QUERY_INTS, SLICE_INTS = 12_000_000, 500_000  # integers of queries that a task holds; fewer of a slice are not worth a task
QUERY = "doc_id % 100 = 0"
BLOCK = 1024  # frames transformed at a time
#: (shape, first pitch class, classes, frames): what each filter subtracts from what, within a span of SPAN frames
FILTERS = [(s, y, h, w) for s, h, w in ((0, 4, 15), (1, 4, 14), (2, 4, 10), (3, 3, 16)) for y in (0, 3, 6, 8)]
LEVELS = (-0.08, 0.0, 0.08)


def _pitch_classes() -> np.ndarray:
    """(bins, 12) weights: each spectrum bin from 60 Hz to 3500 Hz goes to its nearest pitch class."""
    f = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(f), 12), np.float32)
    use = (f >= 60) & (f <= 3500)
    note = np.round(12 * np.log2(np.maximum(f, 1) / 440.0)).astype(int) % 12
    out[np.flatnonzero(use), note[use]] = 1
    return out


_FOLD = _pitch_classes()
_WINDOW = np.hanning(FRAME).astype(np.float32)
_GRAY = np.array([0, 1, 3, 2], np.uint32)


def chroma(pcm: bytes) -> np.ndarray:
    """(frames, 12) pitch-class energies, each frame scaled to unit length."""
    x = np.frombuffer(pcm, np.uint8).astype(np.float32)
    if not len(x):
        return np.zeros((0, 12), np.float32)
    x = (x - x.mean()) / 128
    short = FRAME + (SPAN - 1) * HOP - len(x)
    if short > 0:
        x = np.concatenate([x, np.zeros(short, np.float32)])
    n = (len(x) - FRAME) // HOP + 1
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    parts = []
    for at in range(0, n, BLOCK):
        z = np.fft.rfft(frames[at : at + BLOCK] * _WINDOW, axis=1)
        parts.append((z.real**2 + z.imag**2).astype(np.float32) @ _FOLD)
    c = np.sqrt(np.concatenate(parts))
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def _filter_weights() -> np.ndarray:
    """((SPAN + 1) * 13, 2 * filters): what each filter's two sides add up of the integral image's corners in a span.

    Weights are halves and whole numbers, so with whole energies every sum is exact, in whatever order it is made.
    """
    out = np.zeros((SPAN + 1, 13, 2, len(FILTERS)))

    def add(k: int, side: int, t0: int, t1: int, y0: int, y1: int, by: float = 1.0) -> None:
        for t, y, sign in ((t1, y1, by), (t0, y1, -by), (t1, y0, -by), (t0, y0, by)):
            out[t, y, side, k] += sign

    for k, (shape, y, h, w) in enumerate(FILTERS):
        if shape == 0:  # all of the area against the rest of the span
            add(k, 0, 0, w, y, y + h)
            add(k, 1, 0, w, 0, 12, h / (12 - h))
            add(k, 1, 0, w, y, y + h, -h / (12 - h))
        elif shape == 1:  # earlier against later
            add(k, 0, 0, w // 2, y, y + h)
            add(k, 1, w // 2, w, y, y + h)
        elif shape == 2:  # low against high classes
            add(k, 0, 0, w, y, y + h // 2)
            add(k, 1, 0, w, y + h // 2, y + h)
        else:  # the middle third against its sides
            add(k, 0, w // 4, 3 * w // 4, y, y + h, 2.0)
            add(k, 1, 0, w, y, y + h)
    return out.reshape((SPAN + 1) * 13, 2 * len(FILTERS))


_WEIGHTS = _filter_weights()
_SHIFTS = np.uint32(2) * np.arange(len(FILTERS), dtype=np.uint32)
STEPS = 65536  # energies are whole numbers of so many parts


def fingerprint(pcm: bytes) -> np.ndarray:
    """Packed 32-bit integers, one per position of the span."""
    c = chroma(pcm)
    n = len(c) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(c) + 1, 13))
    total[1:, 1:] = np.rint(c * STEPS).cumsum(axis=0, dtype=np.float64).cumsum(axis=1)
    spans = np.lib.stride_tricks.sliding_window_view(total.reshape(-1), (SPAN + 1) * 13)[::13]
    out = np.empty(n, np.uint32)
    for at in range(0, n, BLOCK):
        sums = spans[at : min(n, at + BLOCK)] @ _WEIGHTS + 1e-6 * STEPS
        value = np.log(sums[:, : len(FILTERS)] / sums[:, len(FILTERS) :])
        level = sum((value > x).astype(np.intp) for x in LEVELS)
        out[at : at + len(value)] = np.bitwise_or.reduce(_GRAY[level] << _SHIFTS, axis=1)
    return out


def offset_votes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct integers that agree at each offset, from -(len(b) - 1) on: a[i + offset] meets b[i]."""
    votes = np.zeros(len(a) + len(b) - 1, np.int64)
    oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    common = np.intersect1d(a, b)
    la, ha = np.searchsorted(a[oa], common, "left"), np.searchsorted(a[oa], common, "right")
    lb, hb = np.searchsorted(b[ob], common, "left"), np.searchsorted(b[ob], common, "right")
    once = (ha - la == 1) & (hb - lb == 1)
    np.add.at(votes, oa[la[once]] - ob[lb[once]] + len(b) - 1, 1)
    for k in np.flatnonzero(~once).tolist():
        at, bt = oa[la[k] : ha[k]], ob[lb[k] : hb[k]]
        seen = np.zeros(len(votes), bool)
        for i in (at if len(at) <= len(bt) else bt).tolist():  # a repeat costs its rarer side
            seen[(i - bt if len(at) <= len(bt) else at - i) + len(b) - 1] = True
        votes += seen
    return votes


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, float, int, int]:
    """(offset, votes, bit error, run, steps): a[i + offset] meets b[i]; ties of votes go to the offset nearest zero.

    Steps are the neighbouring positions that both agree on different integers. The run is the stretch at that offset whose positions' bit errors, less ``EXPECTED``, have the least sum.
    """
    if not len(a) or not len(b):
        return 0, 0, 1.0, 0, 0
    votes = offset_votes(a, b)
    best = np.flatnonzero(votes == votes.max()) - (len(b) - 1)
    offset = int(min(best.tolist(), key=lambda o: (abs(o), o)))
    s = max(0, -offset)
    n = min(len(b) - s, len(a) - s - offset)
    wrong = np.bitwise_count(a[s + offset : s + offset + n] ^ b[s : s + n]) / 32
    gain = np.concatenate([[0.0], np.cumsum(EXPECTED - wrong)])
    low = np.minimum.accumulate(gain)
    stop = int((gain - low).argmax())
    start = int(np.flatnonzero(gain[: stop + 1] == low[stop])[-1])
    same = wrong == 0
    steps = int((same[:-1] & same[1:] & (b[s : s + n - 1] != b[s + 1 : s + n])).sum())
    return offset, int(votes.max()), float(wrong[start:stop].mean()) if stop > start else 1.0, stop - start, steps


def matches(votes: int, error: float, run: int, steps: int) -> bool:
    return votes >= VOTES and run >= LEAST_RUN and error <= MAX_ERROR and steps > 0


def best_phase(phases: list[np.ndarray], ref: np.ndarray, among: list[int] | None = None) -> tuple[int, int, float, int, int, int]:
    """The alignment of most votes over a query's phases, or those ``among`` them: (offset, votes, bit error, run, steps, phase)."""
    found = [(*align(phases[k], ref), k) for k in (range(len(phases)) if among is None else among)]
    return max(found, key=lambda x: (matches(*x[1:5]), x[1], -x[2], -x[5]), default=(0, 0, 1.0, 0, 0, 0))


def text_recordings(docs: DataFrame) -> DataFrame:
    """(doc_id, pcm): the media column derived from whole texts, at an eighth of the rate (``held`` of the search renders it)."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("pcm"))


def rendered(pcm: bytes, held: int) -> bytes:
    return pcm if held == 1 else np.repeat(np.frombuffer(pcm, np.uint8), held).tobytes()


def print_hash(prints: np.ndarray, pcm: bytes) -> str:
    """What a class of recordings shares: its integers, or, where they are too few to match, its samples."""
    import hashlib

    return hashlib.blake2b(prints.tobytes() if len(prints) >= LEAST_RUN else b"short" + pcm, digest_size=16).hexdigest()


def phases_of(pcm: bytes) -> list[np.ndarray]:
    """Fingerprints of a query, shifted by fractions of a hop."""
    return [fingerprint(pcm[k * HOP // PHASES :]) for k in range(PHASES)]


def fingerprint_recordings(recordings: DataFrame, pcm_col: str = "pcm", query: str = QUERY, held: int = 1) -> DataFrame:
    """(doc_id, prints array<int>, print_hash, phases array<array<int>>): one pass, no shuffle; phases of queries only (else null).

    Every sample is held for ``held`` samples.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pcm, asked = [rendered(x, held) for x in part.column(1).to_pylist()], part.column(2).to_pylist()
                prints = [fingerprint(p) for p in pcm]
                phases = [[x.view(np.int32).tolist() for x in phases_of(p)] if q else None for p, q in zip(pcm, asked, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([p.view(np.int32) for p in prints], pa.list_(pa.int32())), pa.array([print_hash(p, x) for p, x in zip(prints, pcm, strict=True)]),
                     pa.array(phases, pa.list_(pa.list_(pa.int32())))], ["doc_id", "prints", "print_hash", "phases"])

    rows = recordings.select(F.col("doc_id").cast("long"), F.coalesce(F.col(pcm_col), F.lit(b"")).alias("pcm"), F.coalesce(F.expr(query), F.lit(False)).alias("asked"))
    return rows.mapInArrow(run, "doc_id long, prints array<int>, print_hash string, phases array<array<int>>")


def steps_of(flat: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair of neighbouring, different integers as one number, its owner), of integers laid end to end."""
    use = np.flatnonzero((owner[1:] == owner[:-1]) & (flat[1:] != flat[:-1]))
    return (flat[use].astype(np.uint64) << np.uint64(32)) | flat[use + 1], owner[use]


class QueryBlock:
    """Queries held by a task, and the phases that have each pair of neighbouring integers."""

    def __init__(self, names: list[str], flat: list[np.ndarray], lengths: list[np.ndarray]):
        self.names, ints = names, np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        each = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        self.phases = np.split(ints, np.cumsum(each)[:-1])
        self.query = np.repeat(np.arange(len(names), dtype=np.int32), [len(x) for x in lengths])
        self.first = np.searchsorted(self.query, np.arange(len(names) + 1))
        steps, owner = steps_of(ints, np.repeat(np.arange(len(each), dtype=np.int32), each))
        order = np.argsort(steps, kind="stable")
        self.steps, self.owner = steps[order], owner[order]
        self.seen = np.zeros(len(each), bool)

    def candidates(self, flat: np.ndarray, owner: np.ndarray):
        """(owner, its queries' phases that share a step with it) of each recording that has any."""
        steps, of = steps_of(flat, owner)
        order = np.argsort(steps, kind="stable")
        steps, of = steps[order], of[order]
        low = np.searchsorted(self.steps, steps)
        hit = np.flatnonzero(low < len(self.steps))
        hit = hit[self.steps[low[hit]] == steps[hit]]
        hit = hit[np.argsort(of[hit], kind="stable")]
        low, high, of = low[hit], np.searchsorted(self.steps, steps[hit], "right"), of[hit]
        edges = np.flatnonzero(np.diff(of, prepend=-1, append=-1)) if len(of) else of
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            for x, y in zip(low[a:b].tolist(), high[a:b].tolist(), strict=True):
                self.seen[self.owner[x:y]] = True
            found = np.flatnonzero(self.seen)
            self.seen[found] = False
            yield int(of[a]), found

    def matches(self, name: str, ref: np.ndarray, found: np.ndarray):
        """(query, offset, votes, bit error, run, phase) of each query that matches a recording, of the phases found for it.

        A phase that shares no step does not match, so the best of those found is the best of all where any matches.
        """
        queries = self.query[found]
        for part in np.split(found, np.flatnonzero(np.diff(queries)) + 1):
            q = int(self.query[part[0]])
            if self.names[q] != name:
                at = int(self.first[q])
                best = best_phase(self.phases[at : int(self.first[q + 1])], ref, (part - at).tolist())
                if matches(*best[1:5]):
                    yield (self.names[q], *best[:4], best[5])


def _dealt(classes: DataFrame, queries: DataFrame) -> DataFrame:
    """Queries and the recordings they are compared with, a block and a slice to a partition, queries first."""
    asked = queries.agg(F.sum("n")).first()[0] or 1
    others = classes.where(F.col("n") >= LEAST_RUN)  # fewer cannot match
    held = others.agg(F.sum("n")).first()[0] or 1
    blocks = -(-asked // QUERY_INTS)
    slices = max(4, min(-(-held // SLICE_INTS), -(-blocks * held // (2 * asked))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("print_hash"), F.lit(n)).cast("int")
    mine = queries.withColumn("slice", every(slices)).select(
        (dealt(blocks) * slices + F.col("slice")).alias("cell"), F.lit(0).alias("side"), "print_hash", F.flatten("phases").alias("ints"),
        F.transform("phases", F.size).alias("lengths"), F.lit(None).cast("long").alias("ref_id"), F.lit(None).cast("long").alias("ref_members"))
    theirs = others.withColumn("block", every(blocks)).select(
        (F.col("block") * slices + dealt(slices)).alias("cell"), F.lit(1).alias("side"), "print_hash", F.col("prints").alias("ints"),
        F.lit(None).cast("array<int>").alias("lengths"), F.col("class_id").alias("ref_id"), F.col("members").alias("ref_members"))
    return mine.unionByName(theirs).repartitionById(blocks * slices, F.col("cell")).sortWithinPartitions("cell", "side")


def _compare(batches):
    """Links of the recordings of a partition to the queries that come before them in their cell."""
    import pyarrow as pa

    names = ["print_hash", "ref_id", "ref_members", "offset", "votes", "bit_error", "run", "phase"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    as_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, types, strict=True)], names)
    ints = lambda part: part.column(3).flatten().to_numpy().view(np.uint32)
    cell, waiting, block, rows = None, ([], [], []), None, []
    for batch in batches:
        where = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        edges = [0, *(np.flatnonzero(np.diff(where).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            if start == stop:
                continue
            part, (at, side) = batch.slice(start, stop - start), where[:, start].tolist()
            if at != cell:
                cell, waiting, block = at, ([], [], []), None
            if side == 0:
                waiting[0].extend(part.column(2).to_pylist())
                waiting[1].append(ints(part).copy())
                waiting[2].extend(np.array(x, np.int64) for x in part.column(4).to_pylist())
                continue
            if block is None:
                block, waiting = QueryBlock(*waiting), ([], [], [])
            flat, length = ints(part), part.column(3).value_lengths().to_numpy()
            end = np.cumsum(length)
            for k, found in block.candidates(flat, np.repeat(np.arange(len(length)), length)):
                ref_id, members = part.column(5)[k].as_py(), part.column(6)[k].as_py()
                for q, *best in block.matches(part.column(2)[k].as_py(), flat[end[k] - length[k] : end[k]], found):
                    rows.append((q, ref_id, members, *best))
                if len(rows) >= 10_000:
                    yield as_batch(rows)
                    rows = []
    yield as_batch(rows)


def _search(recordings: DataFrame, query: str, held: int) -> tuple[DataFrame, DataFrame]:
    """(own, links): a row per query recording with its class; a row per class of queries and class of recordings that match."""
    prints = materialize(fingerprint_recordings(recordings, query=query, held=held), "prints")
    classes = prints.groupBy("print_hash").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members"), F.first("prints").alias("prints"))
    classes = materialize(classes.withColumn("n", F.size("prints").cast("long")), "classes")
    asked = prints.where("phases IS NOT NULL")
    queries = asked.groupBy("print_hash").agg(F.first("phases").alias("phases"))
    queries = materialize(queries.withColumn("n", F.aggregate("phases", F.lit(0).cast("long"), lambda n, x: n + F.size(x))), "queries")
    links = "print_hash string, ref_id long, ref_members long, offset long, votes long, bit_error double, run long, phase long"
    aligned = materialize(_dealt(classes, queries).mapInArrow(_compare, links), "aligned")
    own = asked.select("doc_id", F.size("prints").cast("long").alias("n_prints"), "print_hash")
    return own.join(classes.select("print_hash", "class_id", "members"), "print_hash"), aligned


def align_recordings(recordings: DataFrame, query: str = QUERY, held: int = 1) -> DataFrame:
    """Per query recording and class of recordings that share a passage with it.

    Columns: doc_id, n_prints, print_hash, class_id, members (of the query's class), ref_id, ref_members (of the matched
    class), offset, votes, bit_error, run, phase.
    """
    own, aligned = _search(recordings, query, held)
    return own.join(aligned, "print_hash", "left").select(
        "doc_id", "n_prints", "print_hash", "class_id", "members", "ref_id", "ref_members", "offset", "votes", "bit_error", "run", "phase"
    )


def count_links(recordings: DataFrame, query: str = QUERY, held: int = 1) -> DataFrame:
    """The same search with one row per query recording: every link is found, verified and counted, none is listed.

    Columns: doc_id, n_prints, print_hash, class_id, members; links (classes that match), linked (recordings in them), links_hash
    (their ref_id, offset, votes, run and phase hashed and combined by exclusive or; 0 without any), and the link of most votes, then
    least error, then least ref_id, with the columns of ``align_recordings``.
    """
    own, aligned = _search(recordings, query, held)
    best = F.min(F.struct((-F.col("votes")).alias("less"), "bit_error", "ref_id", "ref_members", "offset", "votes", "run", "phase"))
    digest = F.bit_xor(F.xxhash64("ref_id", "offset", "votes", "run", "phase"))
    links = aligned.groupBy("print_hash").agg(F.count("*").alias("links"), F.sum("ref_members").alias("linked"), digest.alias("links_hash"), best.alias("best"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return own.join(links, "print_hash", "left").select(
        "doc_id", "n_prints", "print_hash", "class_id", "members", none(F.col("links")).alias("links"), none(F.col("linked")).alias("linked"), none(F.col("links_hash")).alias("links_hash"),
        *(F.col(f"best.{c}").alias(c) for c in ("ref_id", "ref_members", "offset", "votes", "bit_error", "run", "phase")),
    )
