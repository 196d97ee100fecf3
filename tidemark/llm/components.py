"""Connected components over an edge table by alternating large-star and small-star steps.

Both steps are aggregations and joins of (node, neighbour) rows keyed by node; a hub's rows are spread over
``SALTS`` sub-keys in the join that sends its minimum back, and the minimum itself is a partial aggregate, so no
task holds a hub's whole neighbourhood. Each round is written to the shared folder. Nothing is collected but one
changed/unchanged count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

SALTS = 8


def _min_to_neighbours(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(spread.hint("merge"), ["u", "salt"]).select("u", "v", "m")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``: component is the least node reachable.

    Self-loops are allowed and keep a node. Raises if ``max_rounds`` rounds do not settle it.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        large = _min_to_neighbours(_both(now)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every edge points from its larger end to its smaller one
        small = _min_to_neighbours(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        new = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = materialize(new, "edges")
        # settled when no node that is pointed at points elsewhere and every node points at one: a forest of stars
        unsettled = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not unsettled:
            heads = new.select(F.col("v").alias("u")).distinct()
            unsettled = new.select("u").join(heads.hint("merge"), "u", "left_semi").limit(1).count()
        now = new
        if not unsettled:
            break
    else:
        raise RuntimeError(f"components not settled in {max_rounds} rounds")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
