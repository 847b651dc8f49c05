"""Connected components of an edge table by alternating large and small stars.

Every round is a handful of joins and aggregations over the edges; nothing of
the graph is collected. Rounds are cut off with reliable checkpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.session import checkpoint_root


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(least.select("u", F.col("m").alias("v"))))
    return moved.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; a component is its least node."""
    checkpoint_root(edges.sparkSession)
    now = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .where("u != v").distinct().checkpoint())
    mark = None
    while True:
        r = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
                    ).first()
        if (r["n"], r["s"]) == mark or r["n"] == 0:
            break
        mark = (r["n"], r["s"])
        now = _small_star(_large_star(now)).checkpoint()
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
