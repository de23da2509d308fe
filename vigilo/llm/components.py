"""Connected components of an edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import Scratch


def _distinct_edges(df: DataFrame) -> DataFrame:
    return df.where("u != v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # an edge is stored once as (larger, smaller), so its larger end moves to the
    # least neighbour of its smaller end
    moved = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
    return moved


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` (longs) whose root is another node.

    ``root`` is the least node reachable. Each round rewrites the edges with partial
    aggregates (a hub of any degree is one partial row per task) and equi-joins, and is
    written to the shared folder; the edges end as one star per component. Edges are
    (larger, smaller) pairs. No adjacency list is ever built.
    """
    oriented = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = scratch.written(_distinct_edges(oriented), "edges")
    mark = _fingerprint(now)
    while mark[0]:
        step = _orient(_large_star(now))
        now = scratch.written(_distinct_edges(_orient(_small_star(_distinct_edges(step)))), "edges")
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _orient(df: DataFrame) -> DataFrame:
    return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
