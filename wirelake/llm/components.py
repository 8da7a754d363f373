"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wirelake.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u and v, any orderable type); root is the smallest node.

    A node's neighbours are never gathered: each step takes their minimum (summed per task first) and
    joins it back to the edges, a join whose hot keys can be split. Every step is written to the shared folder.
    """
    cur = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), purpose)
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialise(large, purpose)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        cur = materialise(small.filter("u <> v").distinct(), purpose)
        before, state = state, _state(cur)
        if state == before:
            break
    roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
