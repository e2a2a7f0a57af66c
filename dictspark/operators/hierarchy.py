"""Hierarchies: links, levels and paths, subtrees, measures rolled up to every node.

Nodes are rows of (node_id, parent_id, info_object, node_name, node_value, date_from, date_to,
version); a root has no parent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import numbered

# The default version and due date, and the columns of an extracted hierarchy.
ACTIVE = "A"
DUE_DATE = "99991231"
COLUMNS = ("node_id", "parent_id", "child_id", "next_id", "info_object", "node_name", "node_value", "date_from", "date_to", "level", "path")

#: The node of values whose own node is not in the hierarchy.
NOT_ASSIGNED = "NOT_ASSIGNED"


def valid_nodes(nodes: DataFrame, version: str = ACTIVE, date_to: str | None = None, name: str | None = None) -> DataFrame:
    """Nodes of a version that are valid on the due date, of the hierarchy ``name`` where nodes tell theirs (``hierarchy_name``)."""
    due = date_to or DUE_DATE
    if "hierarchy_name" in nodes.columns:
        nodes = (nodes if name is None else nodes.where(F.col("hierarchy_name") == name)).drop("hierarchy_name")
    return nodes.where((F.col("version") == version) & (F.col("date_from") <= due) & (F.col("date_to") >= due)).drop("version")


def links(nodes: DataFrame) -> DataFrame:
    """Nodes with their first child and next sibling, siblings ordered by node id.

    The next sibling is the row with the next number in one global order, so a parent with
    very many children is spread like any other rows.
    """
    first = nodes.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("_parent")).agg(F.min("node_id").alias("child_id"))
    order = numbered(nodes.select("node_id", "parent_id"), ["parent_id", "node_id"], "_no")
    after = order.select((F.col("_no") - 1).alias("_no"), F.col("node_id").alias("next_id"), F.col("parent_id").alias("_next_parent"))
    siblings = order.join(after, "_no").where(F.col("parent_id").eqNullSafe(F.col("_next_parent"))).select(F.col("node_id").alias("_node"), "next_id")
    out = nodes.join(first, F.col("node_id") == F.col("_parent"), "left").join(siblings, F.col("node_id") == F.col("_node"), "left")
    return out.drop("_parent", "_node")


def walk(nodes: DataFrame, root: Column | None = None) -> DataFrame:
    """(node_id, level, path, ancestors) of every node at or below the roots.

    Every node holds the way to one of its ancestors; a round puts the ancestor's own way before it, so ways double
    and a hierarchy of any depth takes as many rounds as its depth has binary digits. Each round is written, so the plan does not grow. Nodes that
    no root is above, also those in or below a cycle, are left out; a root ends the way whatever its parent. ``ancestors`` (itself included)
    makes subtrees and rollups need no further join.
    """
    is_root = F.col("parent_id").isNull() if root is None else root
    up = F.when(F.coalesce(is_root, F.lit(False)), F.lit(None)).otherwise(F.col("parent_id"))
    rooted = F.coalesce(is_root, F.lit(False)) | F.col("parent_id").isNotNull()
    ways = cut_lineage(nodes.where(rooted).select("node_id", up.alias("above"), F.array("node_id").alias("ancestors"), F.col("node_name").alias("names")))
    done = []
    while True:
        done.append(ways.where("above IS NULL"))
        rest = ways.where("above IS NOT NULL")
        if rest.isEmpty():
            break
        known = reduce(DataFrame.unionByName, [*done, rest])
        onto = known.select(F.col("node_id").alias("above"), F.col("above").alias("_above"), F.col("ancestors").alias("_before"), F.col("names").alias("_names"))
        joined = rest.join(onto, "above").select(
            "node_id", F.col("_above").alias("above"), F.concat("_before", "ancestors").alias("ancestors"), F.concat_ws("/", "_names", "names").alias("names")
        )
        ways = cut_lineage(joined.where(F.col("above").isNull() | (F.size(F.array_distinct("ancestors")) == F.size("ancestors"))))
    path = F.concat(F.lit("/"), "names").alias("path")
    return reduce(DataFrame.unionByName, done).select("node_id", F.size("ancestors").alias("level"), path, "ancestors")


def hierarchy(nodes: DataFrame, version: str = ACTIVE, date_to: str | None = None, name: str | None = None) -> DataFrame:
    """An extracted hierarchy with links, levels and paths."""
    valid = valid_nodes(nodes, version, date_to, name)
    return links(valid).join(walk(valid).select("node_id", "level", "path"), "node_id", "left").select(*COLUMNS)


def closure(walked: DataFrame) -> DataFrame:
    """(ancestor, node_id, distance) for every node and each of its ancestors, itself included."""
    pairs = walked.select("node_id", F.size("ancestors").alias("_size"), F.posexplode("ancestors").alias("_at", "ancestor"))
    return pairs.select("ancestor", "node_id", (F.col("_size") - 1 - F.col("_at")).alias("distance"))


def subtree(nodes: DataFrame, node_id) -> DataFrame:
    """The nodes at and below one node, walked from it and not from the root."""
    below = walk(nodes, F.col("node_id") == F.lit(node_id)).select("node_id", "level")
    return nodes.join(below, "node_id")


def rollup(walked: DataFrame, values: DataFrame, node: str, measures: dict[str, Column]) -> DataFrame:
    """Measures of ``values`` summed to every ancestor of the node they belong to.

    Values are reduced to one row per node before they meet the hierarchy; each such row then
    goes to its ancestors, and partial sums keep the root as cheap as any other node. Values of nodes
    outside the hierarchy are summed in a row without ``node_id``, there only if there are any.
    """
    per_node = values.groupBy(F.col(node).alias("node_id")).agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    kind = walked.schema["node_id"].dataType
    above = F.coalesce("ancestors", F.array(F.lit(None).cast(kind)))
    spread = per_node.join(walked.select("node_id", "ancestors"), "node_id", "left").select(F.explode(above).alias("node_id"), *measures)
    totals = spread.groupBy("node_id").agg(*[F.sum(n).alias(n) for n in measures])
    outside = totals.where(F.col("node_id").isNull()).select("node_id", F.lit(1).alias("level"), F.lit(f"/{NOT_ASSIGNED}").alias("path"), *measures)
    return walked.select("node_id", "level", "path").join(totals, "node_id", "left").unionByName(outside)
