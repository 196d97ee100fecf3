"""Homomorphic multiset hash of documents: paragraphs are hashed to wide vectors that add modulo powers of two.

A paragraph (a line that is not blank, without outer white space) becomes a vector of two parts:

* ``WIDE`` lanes of 64 bits from SHAKE-128 of its UTF-8 text, added modulo 2**64. Equal sums mean equal multisets.
* ``LANES`` lanes of 32 bits, added modulo 2**32 (more than a text has windows): each of its overlapping
  ``GRAM``-character windows adds +1 or -1 to one lane. The cosine of two such sums estimates the share of windows two documents have in common.

Both parts are sums, so a fingerprint ignores paragraph order, and a paragraph is inserted or deleted by adding or
subtracting its vector (:func:`insert`, :func:`delete`). Written as lower-case hex, wide part first.

Defined results: null and empty texts have the all-zero fingerprint; two zero fingerprints have likeness 1, a zero
and a non-zero one 0; equal fingerprints have likeness 1. Null doc_ids come last in the descending order, equal
doc_ids follow the hash of their text and then the text. A table of one row has itself as its next document; an
empty table gives no rows; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDE, LANES, GRAM = 16, 256, 8
MAX_BUCKETS = 20_000  # bounds and closing ids the driver holds at most; beyond it ranges grow instead
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _windows(code: np.ndarray) -> np.ndarray:
    """Signed lane sums of all windows of a code-point array; a window ends at its paragraph's end."""
    n = len(code)
    padded = np.zeros(n + GRAM - 1, np.uint64)
    padded[:n] = code
    line = code == 10
    h = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    edge = np.zeros(n + GRAM - 1, bool)
    edge[:n] = line
    for j in range(GRAM):
        alive &= ~edge[j : j + n]
        h = h * _MUL + np.where(alive, padded[j : j + n], np.uint64(0)) + np.uint64(1)
    h = h[~line]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    lane = (h & np.uint64(LANES - 1)).astype(np.int64)
    sign = 1 - 2 * ((h >> np.uint64(20)) & np.uint64(1)).astype(np.int64)
    return np.bincount(lane, sign, LANES).astype(np.int64)


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(wide, lanes) of a text: the sum over its paragraphs."""
    wide = np.zeros(WIDE, np.uint64)
    parts = [p for p in (line.strip() for line in text.split("\n")) if p]
    if not parts:
        return wide, np.zeros(LANES, np.uint32)
    raw = b"".join([hashlib.shake_128(p.encode("utf-8", "surrogatepass")).digest(8 * WIDE) for p in parts])
    wide = np.frombuffer(raw, "<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    lanes = np.zeros(LANES, np.int64)
    joined = "\n".join(parts)
    step = 1 << 20  # long texts in slices, cut at paragraph ends where there are any
    at = 0
    while at < len(joined):
        stop = min(len(joined), at + step)
        if stop < len(joined):
            cut = joined.rfind("\n", at, stop)
            stop = cut + 1 if cut > at else stop
            # a paragraph longer than a slice: overlap so that no window is lost
            tail = 0 if cut > at else GRAM - 1
        else:
            tail = 0
        piece = np.frombuffer(joined[at : stop + tail].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        got = _windows(piece)
        if tail:
            got = got - _windows(piece[stop - at :])
        lanes += got
        at = stop
    return wide, lanes.astype(np.uint32)


def insert(a, b):
    """Fingerprint vector of the union (as multisets of paragraphs)."""
    return a[0] + b[0], a[1] + b[1]


def delete(a, b):
    return a[0] - b[0], a[1] - b[1]


def to_hex(v) -> str:
    return v[0].astype("<u8").tobytes().hex() + v[1].astype("<u4").tobytes().hex()


def likeness(a, b) -> float:
    """1 for equal fingerprints, else the clipped cosine of the lane sums."""
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].view(np.int32).astype(float), b[1].view(np.int32).astype(float)
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return 0.0 if norm == 0 else float(min(1.0, max(0.0, (x @ y) / norm)))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every document, without any shuffle."""

    def run(frames):
        for pdf in frames:
            yield pdf.assign(fingerprint=[to_hex(vector(t)) for t in pdf["text"]])[["doc_id", "fingerprint"]]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).mapInPandas(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, bucket_rows: int = 2000) -> tuple[DataFrame, int]:
    """Documents dealt to id ranges, each range closed by a copy of the document that follows it.

    Rows: (bucket, guest, doc_id, text). Buckets are ranges of descending doc_id of about ``bucket_rows`` rows
    (bounds from an approximate quantile of the ids alone), so the whole text is shuffled once, and the only
    rows sent twice are one a bucket. Returns the frame and the number of buckets.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    n = ids.count()
    buckets = min(max(1, -(-n // bucket_rows)), MAX_BUCKETS)
    bounds = sorted({int(b) for b in ids.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)}) if buckets > 1 else []

    # bucket = number of bounds above the id, so bucket 0 holds the largest ids; bounds are one per bucket_rows rows
    def bucket_of(values):
        return len(bounds) - np.searchsorted(np.array(bounds, np.int64), values, side="right")

    @F.pandas_udf("long")
    def bucket_udf(v):
        import pandas as pd

        out = np.full(len(v), len(bounds), np.int64)
        known = v.notna().to_numpy()
        out[known] = bucket_of(v[known].astype("int64").to_numpy())
        return pd.Series(out)

    dealt = rows.withColumn("bucket", bucket_udf("doc_id"))
    heads = dealt.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    return _deal(dealt, heads, len(bounds) + 1), len(bounds) + 1


def _deal(dealt: DataFrame, heads: DataFrame, buckets: int) -> DataFrame:
    # one (bucket, largest id) row a bucket: bucket_rows times fewer than documents
    tops = {r["bucket"]: r["doc_id"] for r in heads.toLocalIterator()}
    order = sorted(tops)
    guest_of = {}
    for i, b in enumerate(order):
        nxt = order[(i + 1) % len(order)]
        guest_of.setdefault(tops[nxt], []).append(b)
    schema = "doc_id long, target long"
    pairs = [(k, b) for k, v in guest_of.items() for b in v]
    guests = dealt.sparkSession.createDataFrame(pairs, schema)
    sent = dealt.join(F.broadcast(guests), dealt["doc_id"].eqNullSafe(guests["doc_id"])).select(F.col("target").alias("bucket"), F.lit(1).alias("guest"), dealt["doc_id"], "text")
    return dealt.select("bucket", F.lit(0).alias("guest"), "doc_id", "text").unionByName(sent)


def edited_likeness(docs: DataFrame, bucket_rows: int = 2000) -> DataFrame:
    """Fingerprints of every text and of its edited text, with both likenesses (see the module text)."""
    dealt, buckets = with_next(docs, bucket_rows)
    laid = dealt.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")

    def run(frames):
        import pandas as pd

        held = None  # (bucket, guest, doc_id, text, vector)
        done = None
        for pdf in frames:
            rows = []
            for bucket, guest, doc_id, text in zip(pdf["bucket"], pdf["guest"], pdf["doc_id"], pdf["text"], strict=True):
                if bucket == done:
                    continue  # a tie of the closing document: only its first row follows the bucket
                v = vector(text)
                if held is not None and held[0] == bucket:
                    rows.append(_row(held, text, v))
                held = (bucket, guest, doc_id, text, v)
                if guest:
                    held, done = None, bucket
            if rows:
                out = pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
                out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
                yield out

    return laid.mapInPandas(run, SCHEMA)


def _row(held, following: str, next_vector):
    _, _, doc_id, text, v = held
    new = edited(text, following)
    w = vector(new)
    doc_id = None if doc_id != doc_id or doc_id is None else int(doc_id)
    return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), to_hex(v), to_hex(w), likeness(v, w), likeness(v, next_vector)

