"""Shared helpers of the training-data operators: tables, folds, scratch tables, bounded training samples."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; where that setting is unset, a local temporary one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage at a table that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAYBE_BITS = 1 << 23


def maybe_among(df: DataFrame, key: str, keys: DataFrame, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose 64-bit hash ``key`` may be in the column of that name of ``keys`` (or, not ``keep``, cannot be).

    A bitmap of fixed size decides: 131,072 words of 64 bits at most are broadcast, whatever the tables' sizes. It only
    spares joins rows that find no partner; where ``keys`` fills it, every row may be among them.
    """
    at = F.pmod(F.col(key), F.lit(MAYBE_BITS))
    words = keys.select((at / 64).cast("int").alias("_word"), F.expr(f"shiftleft(1L, CAST(pmod({key}, 64) AS INT))").alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = df.withColumn("_word", (at / 64).cast("int")).join(F.broadcast(words), "_word", "left")
    hit = F.coalesce(F.expr(f"(shiftrightunsigned(_bits, CAST(pmod({key}, 64) AS INT)) & 1L) = 1L"), F.lit(False))
    return found.where(hit if keep else ~hit).drop("_word", "_bits")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def texts_of(docs: DataFrame, ids: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each row of ``ids`` (few) that ``docs`` has, with ``text`` (null: empty) beside its columns.

    Where an id repeats in ``docs`` the text of least hash stands for it, so there are never more rows than ids.
    """
    found = docs.select(*by, F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), list(by))
    return found.groupBy(*ids.columns).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_mod: int, held_at: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled training rows as (doc_id, text, y).

    Rows of the held-out fold are never read as labels. The sample is the ``rows`` smallest hashes of doc_id
    among the labelled ids, so it does not depend on partitioning; the id list (16 bytes a row, at most
    ``rows`` of them) is small by construction and is broadcast.
    """
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), held_mod) != held_at))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return texts_of(docs, ids).select("doc_id", "text", "y")


SLICE = 256  # rows whose texts a scorer holds as Python strings at a time


def score_texts(docs: DataFrame, model, keep: list[str], out: str = "score") -> DataFrame:
    """The columns ``keep`` and, as ``out``, ``model.score`` of every text (null: empty), in one pass without a shuffle.

    Columns travel under positional names, so theirs may be any but ``out``; the text travels once.
    """
    if out in keep:
        raise ValueError(f"{out} is a column already")
    sent = keep if "text" in keep else [*keep, "text"]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(sent)))
    at, names = sent.index("text"), [f"_{i}" for i in range(len(keep))]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                scores = shared.value.score([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(scores, pa.float64())], [*names, "_score"])

    scored = rows.mapInArrow(run, rows.select(*names).schema.add("_score", "double"))
    return scored.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), F.col("_score").alias(out))
