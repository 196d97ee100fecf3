"""Token ids as ORC: stripes of run-length encoded integers, row indexes, Bloom filters on document ids.

Rows are range-partitioned and sorted by doc_id, so file and stripe statistics on doc_id are narrow and a
read for some documents skips the rest; the Bloom filter settles point look-ups inside a stripe's range.
``part`` (the range partition) and ``part_start`` (ids before the document within it) let a reader find every
global position from one small total per file.

Defined results: null text counts as empty (its end id alone); null doc_ids sort first; repeated doc_ids are
kept, ordered by a hash of their text and then the text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_FILES = 20_000  # beyond it files grow instead
MEMO_BYTES = 96 << 20  # of a task's memo of encoded words: ranges of doc_id mix all sources, so more words recur late
FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def id_bounds(ids: DataFrame, rows_per_range: int) -> list[int]:
    """Ascending bounds of doc_id ranges of about ``rows_per_range`` rows, from a scan of the ids alone (texts are not read)."""
    ranges = min(max(1, -(-ids.count() // rows_per_range)), MAX_FILES)
    return sorted({int(b) for b in ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)}) if ranges > 1 else []


def range_of(bounds: list[int]):
    """Column function: how many bounds are not above an id (0 for null)."""

    @F.pandas_udf("int")
    def number(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int32)
        known = v.notna().to_numpy()
        out[known] = np.searchsorted(np.array(bounds, np.int64), v[known].astype("int64").to_numpy(), side="right")
        return pd.Series(out)

    return number


def encode_sorted(docs: DataFrame, tokenizer_path: str, end_id: int, rows_per_file: int = 8000) -> DataFrame:
    """Documents in ascending doc_id order over range partitions, with their ids (end id appended)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from tidemark.llm.token_encoder import TokenEncoder

        enc, part, start = TokenEncoder(tokenizer_path, MEMO_BYTES), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, found, counts in enc.encode(batch.column(1)):
                n = counts + 1
                ends = np.concatenate([[0], np.cumsum(n)])
                with_end = np.full(ends[-1], end_id, np.int32)
                keep = np.ones(ends[-1], bool)
                keep[ends[1:] - 1] = False
                with_end[keep] = found.view(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(with_end))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(np.full(len(n), part, np.int32)), pa.array(start + ends[:-1]), pa.array(n), ids],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = id_bounds(rows.select("doc_id"), rows_per_file)
    return (
        rows.repartitionById(len(bounds) + 1, range_of(bounds)("doc_id"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .mapInArrow(run, FILE_SCHEMA)
    )


def write_token_orc(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, stripe_bytes: int = 16 << 20) -> None:
    (
        encode_sorted(docs, tokenizer_path, end_id).write.mode("overwrite")
        .option("compression", "zstd")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The stored rows; ``doc_ids`` becomes a pushed-down predicate that prunes files, stripes and row groups."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def positions(rows: DataFrame) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32); the window runs over one total per file."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_offset"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(3)
            ends, values = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False)).astype("<u4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            n = (ends[1:] - ends[:-1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(n), pa.array(crc, pa.int64())],
                ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
            )

    read = rows.select("doc_id", "part", "part_start", "ids").mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    return read.join(offsets, "part").select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
