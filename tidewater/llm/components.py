"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.scratch import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: the greater ones; small: the lesser ones and itself) are tied to the least of all."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where(F.col("v") <= F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge: the root is the least node reachable.

    ``edges`` has columns ``u`` and ``v`` of one orderable type; loops and repeated edges are allowed, rows with a NULL
    are left out. Each round is written to the shared folder, so that a lost executor repeats one round at most; the
    driver sees one count and one hash sum per round. No edge: no row.
    """
    edges = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        edges = materialise(_star(_star(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().join(roots.select("node"), "node", "left_anti").select("node", "root"))
