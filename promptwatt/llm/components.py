"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minima and two joins; the edge table is written to the
shared folder after every round, so its lineage stays short and no round is lost
with an executor. Edges are held distinct, and a hot node (the centre of a large
star) is only ever a join key that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge, the component being its
    smallest node; edges are pairs (u, v) of longs in any order."""
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        e = stored(_small_star(_large_star(e)), "edges")
        # done when every node hangs on one centre that hangs on none
        n, now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, now) == mark:
            break
        mark = (n, now)
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
