"""Places of rows in a global order, and ranks inside groups of any size.

Rows are laid out once, in sorted range partitions of a stored table in which every row carries its partition and its place
there. Places and ranks are then the row's own place plus an offset of its partition. Offsets and rows come from the same
stored table: a range shuffle that is computed twice may cut its ranges differently the second time.

Nothing sorts or holds a whole group: a group that has most of the rows is spread over as many partitions as its rows fill.
Windows run over one row a partition, or one row a group and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import stored

_LOW = (1 << 33) - 1  # monotonically_increasing_id: the partition above 33 bits of the row's place in it


def laid_out(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """The rows, stored in range partitions by ``order``, with ``_part`` and ``_at`` (from 0 in each partition)."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return stored(laid.select("*", F.shiftright("_id", 33).cast("int").alias("_part"), F.col("_id").bitwiseAND(F.lit(_LOW)).alias("_at")).drop("_id"), "placed")


def positioned(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """``pos``: the place of each row in a total order, from 0."""
    rows = laid_out(df, order)
    n = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offset = n.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))  # one row a partition
    return rows.join(F.broadcast(offset), "_part").withColumn(name, (F.col("_before") + F.col("_at")).cast("long")).drop("_part", "_at", "_before")


def ranked(df: DataFrame, by: list[str], order: list[Column | str], name: str = "place", total: str | None = None) -> DataFrame:
    """``place``: the place of each row in its group by ``order``, from 0; ``total``: the rows of its group.

    ``by`` are columns of ``df``; a null is a group of its own.
    """
    rows = laid_out(df, [*by, *order])
    part = rows.groupBy("_part", *by).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    part = part.withColumns({"_before": F.coalesce(before, F.lit(0)), "_total": F.sum("_n").over(group)})
    # keyed by partition and group: no key has more rows than a partition
    renamed = part.select("_part", *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), "_first", "_before", "_total").alias("p")
    same = F.col("r._part") == F.col("p._part")
    for i, c in enumerate(by):
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"p._by{i}"))
    j = rows.alias("r").join(renamed, same).withColumn(name, (F.col("_at") - F.col("_first") + F.col("_before")).cast("long"))
    return j.select(*(F.col(f"r.{c}") for c in df.columns), name, *([F.col("_total").alias(total)] if total else []))
