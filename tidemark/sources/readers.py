"""Readers with explicit schemas: tolerant, strict and counted JSON lines, partitioned series, checksum lists, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def snapshots(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Dated snapshot documents, one JSON object a file; ``dir_date`` comes from the path, a payload of another date raises when read."""
    rows = spark.read.schema(schema).option("multiLine", True).json(pattern)
    day = F.regexp_extract(F.col("_metadata.file_path"), "(\\d{4}-\\d{2}-\\d{2})/[^/]+$", 1)
    same = F.col("snapshot_date").cast("string") == day
    return rows.withColumn("dir_date", F.when(same, day).otherwise(F.raise_error(F.concat(F.lit("directory and payload dates differ: "), day)).cast("string")))


def jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines are skipped and a missing path is an empty table."""
    try:
        return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path).where(" OR ".join(f"`{f.name}` IS NOT NULL" for f in spark.createDataFrame([], schema).schema))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def jsonl_strict(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Rows whose keys are exactly the schema's, each ``key`` once; anything else raises when read."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    names = sorted(f.name for f in spark.createDataFrame([], schema).schema)
    ok = F.array_sort(F.json_object_keys("value")).eqNullSafe(F.array(*map(F.lit, names)))
    row = F.from_json("value", schema, {"mode": "FAILFAST"})
    got = lines.select(F.when(ok, row).otherwise(F.raise_error(F.concat(F.lit("unexpected keys: "), F.col("value")))).alias("r")).select("r.*")
    n = got.groupBy(key).agg(F.count("*").alias("_n"), *(F.any_value(c).alias(c) for c in got.columns if c != key))
    return n.withColumn(key, F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("duplicate "), F.col(key).cast("string"))))).select(*got.columns)


def jsonl_counted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines, unreadable ones with their text in ``corrupt``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = F.from_json("value", schema + ", corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return lines.select(row.alias("r")).select("r.*")


def series(backfill: DataFrame, live: DataFrame, asof) -> DataFrame:
    """(entity_id, snap, value) from two origins: matched rows not after ``asof``; the live row wins, then the later file."""
    both = backfill.withColumn("_o", F.lit(0)).unionByName(live.withColumn("_o", F.lit(1)))
    rows = both.where((F.col("coverage") == "matched") & (F.col("snap") <= F.lit(asof)))
    return rows.groupBy("entity_id", "snap").agg(F.max_by("value", F.struct("_o", "file_date")).alias("value"))


def labelled_series(parts: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Several sources as one panel (series, entity, snap, value): (label, rows, SQL of the value); the key falls back to the entity id."""
    out = None
    for name, rows, value in parts:
        key = F.coalesce("github_repo", F.col("entity_id").cast("string")) if "github_repo" in rows.columns else F.col("entity_id").cast("string")
        one = rows.select(F.lit(name).alias("series"), key.alias("entity"), "snap", F.expr(value).cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def registry(documents: DataFrame) -> DataFrame:
    """Flat rows of nested registries: ``verticals map<string, struct<label, entities array<struct>>>``."""
    v = documents.select("domain", F.explode("verticals").alias("vertical", "_v"))
    return v.select("domain", "vertical", F.col("_v.label").alias("label"), F.posexplode("_v.entities").alias("input_pos", "_e")).select("domain", "vertical", "label", "input_pos", "_e.*")


def checksum_list(spark: SparkSession, pattern: str) -> DataFrame:
    """(dir, file, sha) of ``<hash>  <file>`` lists."""
    rows = spark.read.text(pattern).select("value", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("dir"))
    return rows.where(F.trim("value") != "").select("dir", F.regexp_extract("value", "^[0-9a-f]+\\s+\\*?(.+)$", 1).alias("file"), F.regexp_extract("value", "^([0-9a-f]+)", 1).alias("sha"))


def archive(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """(path, content) of every file under a root, paths relative, one subtree left out."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    at = root.rstrip("/").rsplit("/", 1)[-1]
    rows = rows.select(F.regexp_extract("path", f"/{at}/(.*)$", 1).alias("path"), "content")
    return rows.where(~F.col("path").startswith(exclude)) if exclude else rows


def newest(rows: DataFrame, partition: str) -> DataFrame:
    """The newest partition's rows: a scalar over the partition column, then a pruned read."""
    top = rows.agg(F.max(partition).alias("_t"))
    return rows.join(F.broadcast(top), F.col(partition) == F.col("_t")).drop("_t")


def reconstructed(rows: DataFrame, signal: str) -> DataFrame:
    """Reconstructed points of one signal, never mixed with captured ones."""
    return rows.where(F.col("reconstructable") & (F.col("signal") == signal)).select("entity_id", "period", "value")
