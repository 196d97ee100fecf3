"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[str]] = []


def scratch(s: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; where that setting is unset, a local temporary one in local mode only."""
    base = s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", s.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        s.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES[-1:]:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables made inside, once what reads them is done: a result that was not collected or written is gone with them."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            discard(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: whatever reads the result again sees the same rows, and no lineage behind them."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose readers are done."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    files.getFileSystem(spark._jsc.hadoopConfiguration()).delete(files, True)
