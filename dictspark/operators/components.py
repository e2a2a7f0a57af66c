"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _roots(parents: DataFrame) -> DataFrame:
    """``(node, parent)`` with every parent replaced by the last one above it; each round doubles the distance."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        further = cut_lineage(parents.join(above, "parent").select("node", "above", (F.col("above") != F.col("parent")).alias("moved")))
        parents = further.select("node", F.col("above").alias("parent"))
        if further.where("moved").isEmpty():
            return parents


def connected(edges: DataFrame, a: str = "src", b: str = "tgt") -> DataFrame:
    """``(node, component)`` of every node of an edge: the component is its smallest node, the node itself included.

    Nodes may be of any type that sorts, structs included. Edges have no direction; repeated edges and loops are allowed, edges with a null end are
    left out. Each round hangs every node under its smallest neighbour if that is smaller, follows these trees to their roots by pointer
    doubling, and contracts each tree to its root; what is left are the edges between trees. A tree has two nodes at least, so the
    rounds grow with the logarithm of the number of nodes, and so do the doublings, however long the paths are. A hub's
    neighbours are reduced before the shuffle. Every step is written to the shared folder.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    alone = ends.where("u = v").select(F.col("u").alias("node"))
    now = cut_lineage(ends.where("u <> v").unionByName(ends.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = None
    while not now.isEmpty():
        smallest = now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("parent"))
        trees = _roots(cut_lineage(smallest))
        if labels is None:
            labels = trees.select("node", F.col("parent").alias("component"))
        else:
            moved = trees.select(F.col("node").alias("component"), "parent")
            labels = cut_lineage(labels.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component")))
        of_u, of_v = (trees.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_root")) for end in ("u", "v"))
        between = now.join(of_u, "u").join(of_v, "v").where("u_root <> v_root")
        now = cut_lineage(between.select(F.col("u_root").alias("u"), F.col("v_root").alias("v")).distinct())
    looped = alone.distinct().select("node", F.col("node").alias("component"))
    if labels is None:
        return looped
    return labels.unionByName(looped.join(labels.select("node"), "node", "left_anti"))
