"""Published sets of tables: written aside, listed with checksums and provenance, and made visible by their pointer last.

A set is a folder with one table a part, ``manifest`` (part, columns, digest, rows, files) and ``provenance``. Nothing refers to
it until its pointer, a file named after the day that holds the folder's name, is put in place by a rename. A reader takes the
newest pointer whose set has every part with every file of its manifest and whose rows still have the listed digests; a
set that is half there or tampered with is passed over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.identity import table_digest

MANIFEST = "part string, columns array<string>, digest string, rows long, files array<string>"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """``name:length`` of a table's data files, from the listing."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", ".")))


def write_set(spark: SparkSession, root: str, parts: dict[str, DataFrame], provenance: dict[str, str]) -> str:
    """Write a set's folder, unseen by readers; returns its name. What the manifest says is taken from the written files."""
    name = uuid.uuid4().hex
    at = f"{root}/sets/{name}"
    listed = None
    for part, rows in parts.items():
        rows.write.parquet(f"{at}/{part}")
        back = spark.read.schema(rows.schema).parquet(f"{at}/{part}")
        names = sorted(back.columns)
        one = table_digest(back).select(F.lit(part).alias("part"), F.array(*map(F.lit, names)).alias("columns"), "digest", "rows", F.array(*map(F.lit, data_files(spark, f"{at}/{part}"))).alias("files"))
        listed = one if listed is None else listed.unionByName(one)
    listed.coalesce(1).write.json(f"{at}/manifest")  # a row a part
    spark.createDataFrame(sorted(provenance.items()), "key string, value string").coalesce(1).write.json(f"{at}/provenance")
    return name


def point_to(spark: SparkSession, root: str, day: str, name: str) -> None:
    """Make a set the one of its day; a day that has one already is an error."""
    aside, fs = _fs(spark, f"{root}/aside/{day}-{name}")
    out = fs.create(aside, False)
    out.write(bytearray(name.encode()))
    out.close()
    to, _ = _fs(spark, f"{root}/pointers/{day}")
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(aside, to):
        raise ValueError(f"{day} is published already")


def publish(spark: SparkSession, root: str, day: str, parts: dict[str, DataFrame], provenance: dict[str, str]) -> str:
    name = write_set(spark, root, parts, provenance)
    point_to(spark, root, day, name)
    return name


def days(spark: SparkSession, root: str) -> list[str]:
    """Published days, newest first: a listing."""
    p, fs = _fs(spark, f"{root}/pointers")
    return sorted((s.getPath().getName() for s in fs.listStatus(p)), reverse=True) if fs.exists(p) else []


def folder(spark: SparkSession, root: str, day: str) -> str:
    p, fs = _fs(spark, f"{root}/pointers/{day}")
    name = spark.read.format("text").load(str(p)).first()
    return f"{root}/sets/{name['value'] if name else ''}"


def defects(spark: SparkSession, at: str, required: list[str]) -> list[str]:
    """Why a set may not be read: manifest or part gone, files that are not the listed ones, rows of another digest."""
    if not data_files(spark, f"{at}/manifest") or not data_files(spark, f"{at}/provenance"):
        return ["no manifest"]
    listed = {r["part"]: r for r in spark.read.schema(MANIFEST).json(f"{at}/manifest").collect()}
    found = [f"{p}: not listed" for p in required if p not in listed]
    for part, r in listed.items():
        if data_files(spark, f"{at}/{part}") != sorted(r["files"]):
            found.append(f"{part}: other files")
    for part, r in listed.items() if not found else ():
        now = table_digest(spark.read.parquet(f"{at}/{part}"), columns=r["columns"]).first()
        if (now["digest"], now["rows"]) != (r["digest"], r["rows"]):
            found.append(f"{part}: other rows")
    return found


def newest_complete(spark: SparkSession, root: str, required: list[str]) -> tuple[str, str]:
    """(day, folder) of the newest set without defects; raises where there is none. Rows are read of sets whose files are all there only."""
    passed = {}
    for day in days(spark, root):
        at = folder(spark, root, day)
        passed[day] = defects(spark, at, required)
        if not passed[day]:
            return day, at
    raise ValueError(f"no complete set under {root}: {passed}")
