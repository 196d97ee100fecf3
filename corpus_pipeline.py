"""The corpus pipeline: toxicity, quality, near-duplicates, packing. Counted as part of ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; :func:`run` writes every
stage's result as Parquet to the shared folder and reads it back as the next one's documents. Classifiers learn
from the training folds of ``labels`` among their own input's documents. Near-duplicates are texts whose five-word Jaccard
similarity is 0.8 or more (found by SimHash, every link verified exactly), and what such links connect.

Defined results: null text counts as empty, null doc_ids are scored and kept like others (of a group
of near-duplicates without any id one stays), repeated rows fall to one in the
near-duplicate stage, an empty table gives empty results, and columns beside those of documents pass through all
stages but the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, quality, similar, toxicity
from tidemark.llm.common import materialize, maybe_among, scratch_path, table
from tidemark.llm.token_encoder import default_path


def _row(docs: DataFrame) -> Column:
    """A document as one column, so that no column's name can clash with a stage's own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _free_name(docs: DataFrame) -> str:
    """A name longer than any column's."""
    return "_score" + "_" * max(map(len, docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_mod=5, held_at=0)
    score = _free_name(docs)
    return toxicity.score_documents(docs, model, docs.columns, score).where(F.col(score) < 0.5).drop(score)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), held_mod=4, held_at=2)
    score = _free_name(docs)
    return quality.score_documents(docs, model, docs.columns, score).where(F.col(score) >= 0.7).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts whose five-word Jaccard similarity is 0.8 or more: the least doc_id's."""
    key = [similar.node().alias("node"), F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id")]
    part = similar.components(docs)
    # ids only until the rows that stay are known; of the texts only those of groups move
    once = docs.select(*key).groupBy("node").agg(F.min(F.struct("none", "id")).alias("at"), F.count("*").alias("n"))
    named = once.join(part, "node", "left").select(F.coalesce("component", "node").alias("c"), "node", "n", F.struct("at.none", "at.id", "node").alias("at"))
    least = named.groupBy("c").agg(F.min("at").alias("at"), F.sum("n").alias("n"))
    groups = materialize(named.select("c", "node").join(least.where("n > 1"), "c").select("node", (F.col("at.node") == F.col("node")).alias("first"), "at.none", "at.id"), "groups")
    rows = docs.select(_row(docs), *key)
    alone = maybe_among(rows, "node", groups, keep=False)
    some = maybe_among(rows, "node", groups)
    other = some.join(groups.select("node"), "node", "left_anti")
    by = ["node", "none", "id"]
    stay = some.join(groups.where("first").select(*by), by, "left_semi").dropDuplicates(by)
    return alone.select("row").union(other.select("row")).union(stay.select("row")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, default_path())


STAGES = [("toxicity", drop_toxic), ("quality classifier", keep_quality), ("near-duplicates", drop_near_duplicates), ("packing", pack)]

#: Models, XXH64 fingerprints and a tokenizer cannot be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
