"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch


#: A node of more edges is a hub: its minimum goes to the edges, not they to it.
#: Of 10^9 edges at most some 490,000 nodes (8 MB) are hubs.
HUB = 4096


def _smallest(edges: DataFrame) -> DataFrame:
    """node, its smallest neighbour, and its number of edges."""
    return edges.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("degree")).withColumnRenamed("a", "node")


def _beside(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``edges`` with the ``low`` of their ``a``.  The few hubs' minima are
    broadcast, so the edges of a hub stay where they are; the others meet by a
    shuffle, at most HUB of a node."""
    hubs = low.where(F.col("degree") > HUB).select(F.col("node").alias("hub"), F.col("low").alias("hub_low"))
    known = edges.join(F.broadcast(hubs), edges["a"] == hubs["hub"], "left")
    far = known.where("hub is not null").select("a", "b", F.col("hub_low").alias("low"))
    near = known.where("hub is null").select("a", "b")
    few = low.where(F.col("degree") <= HUB).select("node", "low")
    return near.join(few, near["a"] == few["node"]).select("a", "b", "low").unionAll(far)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node moves to the smallest node
    around it.  Small star: the smaller neighbours and the node itself do."""
    if large:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        low = _smallest(both).withColumn("low", F.least("node", "low"))
        out = _beside(both, low).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:  # edges hold a > b
        low = _smallest(edges)
        out = (_beside(edges, low).where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
               .union(low.select(F.col("node").alias("a"), F.col("low").alias("b"))))
    return out.where("a != b").distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node has one edge to a smaller node, or none and only takes."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                             F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    node = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.sum("e.down").alias("down"))
    return node.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge and is not its component's smallest.  ``edges`` has longs a, b, and
    is read more than once: pass a written table."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    while True:
        step = scratch.save(_star(_star(now, True), False), "star")
        if hasattr(now, "_scratch_path"):
            scratch.drop(now)
        now = step
        if _is_star_forest(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
