"""Connected components by alternating large-star and small-star steps on edge tables.

Each step rewires every node's neighbours to the smallest node it knows of, the large-star
step those that are larger than the node, the small-star step the others; the edges end as
stars around the smallest node of each component, and rounds go on only until they are. A
node's smallest neighbour is found by an aggregation that combines before its shuffle, and
joined back to the edges, so a node with very many neighbours is never held in one place.
Each step's edges, and the result, are written to the shared folder, which ends their lineage.

Defined results: edges with a null end or from a node to itself are ignored; repeated
edges count once; without edges the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import cut, discard, shuffles_freed


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour larger than the node is tied to the smallest of the node and its neighbours."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """The node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(least, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(least.select("u", F.col("low").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around their smallest nodes: each larger end has one edge and is no smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)")
    with shuffles_freed(edges.sparkSession):
        return odd.isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node and component (the smallest node reached) of all nodes that have an edge, as a table in the shared folder."""
    now = cut(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _settled(now):
        wide = cut(large_star(now), "edges")
        discard(now)
        now = cut(small_star(wide), "edges")
        discard(wide)
    found = cut(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "edges")
    discard(now)
    return found
