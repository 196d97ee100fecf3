"""Cost-balanced packing of tokenised documents into fixed-length sequences.

The cost of a piece of n tokens is ``linear * n + quadratic * n**2`` (feed-forward plus attention within the
piece). Within one input partition, full-length pieces of long documents become sequences of their own; the
remaining tails go, longest first, to the sequence of lowest cost that has room for them. Only a tail that fits whole
in no sequence is cut, to fill the cheapest. What does not fill a sequence is carried into the next window of
documents, so only the last window of a partition can hold padding: less than one sequence a partition. Order and
choice hold within a window of ``window_tokens`` tokens of tails, which bounds memory together with one document and
one chunk of texts. Nothing is shuffled.

Defined results: null text counts as empty (its end id alone); null or repeated doc_ids are packed row by row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def place(lengths: list[tuple[int, int, int]], room: int, count: int, linear: float, quadratic: float):
    """Assign (item, start, length), longest first, to ``count`` sequences; returns (placed, left over).

    placed: (item, start, length, sequence, offset). Sequences are kept by the room they have left, each class with its
    cheapest on top, so the cheapest with enough room is the least of the classes from a length upward.
    """
    open_: list[list[tuple[float, int]]] = [[] for _ in range(room + 1)]
    open_[room] = [(0.0, s) for s in range(count)]
    least = np.full(room + 1, np.inf)
    least[room] = 0.0 if count else np.inf
    placed, left = [], []
    for item, start, length in sorted(lengths, key=lambda x: (-x[2], x[0], x[1])):
        while length:
            free = length + int(least[length:].argmin())
            if least[free] == np.inf:
                free = 1 + int(least[1:].argmin())
                if least[free] == np.inf:
                    left.append((item, start, length))
                    break
            cost, s = heapq.heappop(open_[free])
            least[free] = open_[free][0][0] if open_[free] else np.inf
            take = min(length, free)
            placed.append((item, start, take, s, room - free))
            start, length = start + take, length - take
            if free > take:
                cost += linear * take + quadratic * take * take
                heapq.heappush(open_[free - take], (cost, s))
                least[free - take] = open_[free - take][0][0]
    return placed, left


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, room: int = 2048, linear: float = 1.0,
    quadratic: float = 1 / 4096, window_tokens: int = 2_000_000,
) -> DataFrame:
    """Pieces of every document: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    end = np.array([end_id], np.uint32)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tidemark.llm.token_encoder import TokenEncoder

        enc = TokenEncoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        made = 0
        ids: dict[int, tuple] = {}  # item -> (doc_id, ids from a position on, that position, tokens)
        waiting: list[tuple[int, int, int]] = []
        total = n_items = 0
        rows: list[tuple] = []

        def emit(item, start, length, seq, offset):
            doc_id, data, at, n = ids[item]
            rows.append((doc_id, start, length, zlib.crc32(data[start - at : start - at + length]), n, base + seq, offset))

        def pack(last: bool):
            nonlocal made, waiting, total, ids
            count = -(-total // room) if last else total // room
            placed, left = place(waiting, room, count, linear, quadratic)
            for item, start, length, s, offset in placed:
                emit(item, start, length, made + s, offset)
            made += count
            waiting, total = left, sum(x[2] for x in left)
            ids = {item: ids[item] for item, _, _ in left}

        def flush():
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            rows.clear()
            return out

        for batch in batches:
            for first, found, counts in enc.encode(batch.column(1)):
                ends = np.cumsum(counts)
                for doc_id, stop, n in zip(batch.column(0).slice(first, len(counts)).to_pylist(), ends.tolist(), counts.tolist(), strict=True):
                    data = np.concatenate([found[stop - n : stop], end])
                    n += 1
                    ids[n_items] = (doc_id, data, 0, n)
                    whole = n // room
                    for k in range(whole):
                        emit(n_items, k * room, room, made, 0)
                        made += 1
                    if n % room:
                        ids[n_items] = (doc_id, data[whole * room :].copy() if whole else data, whole * room, n)
                        waiting.append((n_items, whole * room, n % room))
                        total += n % room
                    else:
                        del ids[n_items]
                    n_items += 1
                    if total >= window_tokens:
                        pack(last=False)
                if len(rows) >= 10_000:
                    yield flush()
        pack(last=True)
        yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)
