"""Lineage: edge lists, graph documents, and traces along the edges."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import matches
from ..session import cut_lineage, work_dir
from .bounded import PART, part_by
from .components import connected

# Columns of an edge.
EDGE_COLUMNS = ("edge_type", "src_kind", "src_name", "src_field", "tgt_kind", "tgt_name", "tgt_field")
#: Arcs of one node that stay in one bucket; those of a hub are dealt to several.
HUB_ARCS = 1_000_000
#: Slots of the hash by which arcs are counted to find hubs.
HUB_SLOTS = 1_000_000
#: Edges of a graph document, about.
EDGES_PER_DOCUMENT = 10_000


def edges_of(
    df: DataFrame,
    edge_type: str,
    source: tuple[str, Column],
    target: tuple[str, Column],
    fields: tuple[Column | str, Column | str] = ("", ""),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Edges of one mapping: kinds and name columns of both ends, field names for field edges."""
    src_field, tgt_field = (f if isinstance(f, Column) else F.lit(f) for f in fields)
    return df.select(
        F.lit(edge_type).alias("edge_type"),
        F.lit(source[0]).alias("src_kind"),
        source[1].cast("string").alias("src_name"),
        src_field.cast("string").alias("src_field"),
        F.lit(target[0]).alias("tgt_kind"),
        target[1].cast("string").alias("tgt_name"),
        tgt_field.cast("string").alias("tgt_field"),
        *keep,
    )


def transform_edges(transformations: DataFrame, mappings: DataFrame) -> DataFrame:
    """Field edges of transformations (``transformation, source, target``) and their field mappings.

    A mapping of one field to one is an edge. The fields of a rule with several on both sides meet
    in a node of the rule, so its edges are as many as its fields.
    """
    rows = mappings.join(transformations.select("transformation", "source", "target"), "transformation")
    source, target = ("DATASOURCE", F.col("source")), ("PROVIDER", F.col("target"))
    rule, rule_field = ("TRANSFORMATION", F.col("transformation")), F.col("rule").cast("string")
    source_field, target_field = F.col("source_field"), F.col("target_field")
    paired = edges_of(rows.where(source_field.isNotNull() & target_field.isNotNull()), "MAPPING", source, target, (source_field, target_field))
    into = edges_of(rows.where(target_field.isNull()), "MAPPING", source, rule, (source_field, rule_field))
    out = edges_of(rows.where(source_field.isNull()), "MAPPING", rule, target, (rule_field, target_field))
    return paired.unionByName(into).unionByName(out)


def xref_edges(xref: DataFrame) -> DataFrame:
    """Object edges of a cross reference (``object_type, object, used_type, used``): what is used comes first."""
    return xref.select(
        F.lit("USES").alias("edge_type"),
        F.col("used_type").alias("src_kind"),
        F.col("used").alias("src_name"),
        F.lit("").alias("src_field"),
        F.col("object_type").alias("tgt_kind"),
        F.col("object").alias("tgt_name"),
        F.lit("").alias("tgt_field"),
    )


def lineage_edges(mappings: Sequence[DataFrame], scope: str | None = None) -> DataFrame:
    """All distinct edges of several mappings, or those that touch names matching ``scope``."""
    edges = reduce(DataFrame.unionByName, mappings)
    if scope is not None:
        edges = edges.where(matches("src_name", scope) | matches("tgt_name", scope))
    return edges.distinct()


def node(kind: str, name: str, field: str | None = None) -> Column:
    """Identity of a node: ``kind:name``, with ``.field`` at field level."""
    parts = F.concat(F.col(kind), F.lit(":"), F.col(name))
    return F.concat(parts, F.lit("."), F.col(field)) if field else parts


def pairs(edges: DataFrame, level: str = "object") -> DataFrame:
    """(src, tgt) of the edges at object or field level."""
    if level == "object":
        chosen, fields = edges.where((F.col("src_field") == "") & (F.col("tgt_field") == "")), (None, None)
    elif level == "field":
        chosen, fields = edges.where((F.col("src_field") != "") & (F.col("tgt_field") != "")), ("src_field", "tgt_field")
    else:
        raise ValueError("level must be 'object' or 'field'")
    return chosen.select(node("src_kind", "src_name", fields[0]).alias("src"), node("tgt_kind", "tgt_name", fields[1]).alias("tgt"))


class _Bucketed:
    """An external table in the shared folder, its rows dealt to buckets by some columns. The catalog forgets it once it is not written any more."""

    def __init__(self, spark, buckets: int, by: Sequence[str], partitions: Sequence[str] = ()):
        self.spark, self.buckets, self.by, self.partitions = spark, buckets, list(by), list(partitions)
        self.name, self.path = f"dictspark_{uuid.uuid4().hex}", work_dir(spark, "buckets")

    def append(self, rows: DataFrame) -> None:
        """Add rows, which are shuffled unless they already lie by the columns; every task writes one bucket."""
        write = rows.write.format("parquet").mode("append").option("path", self.path).bucketBy(self.buckets, *self.by)
        (write.partitionBy(*self.partitions) if self.partitions else write).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """The rows by their files, without the catalog."""
        return self.spark.read.schema(self.read().schema).parquet(self.path)

    def forget(self) -> None:
        """Drop the catalog entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _hubs(arcs: DataFrame, hub_arcs: int) -> DataFrame | None:
    """Nodes with more arcs than a bucket should hold of one, and the number of parts of each: fewer rows than arcs by that factor. None if there are none.

    Arcs are counted by slots of the hash first. Only the nodes of slots with so many arcs are counted by name.
    """
    slot = F.pmod(F.xxhash64("near"), F.lit(HUB_SLOTS)).alias("slot")
    full = cut_lineage(arcs.groupBy(slot).count().where(F.col("count") > hub_arcs).select("slot"))
    if full.isEmpty():
        return None
    parts = F.ceil(F.count(F.lit(1)) / hub_arcs).cast("int").alias("parts")
    hubs = cut_lineage(arcs.withColumn("slot", slot).join(full, "slot", "left_semi").groupBy("near").agg(parts).where("parts > 1"))
    return None if hubs.isEmpty() else hubs


def _reached(arcs: DataFrame, frontier: DataFrame, hubs: DataFrame | None, buckets: int) -> DataFrame:
    """Far ends of the arcs of the frontier's nodes, repeats included. Arcs are joined where they lie; of the frontier, hubs go to all their parts."""
    by, asked = ["near"], frontier.select(F.col("node").alias("near"))
    if hubs is not None:
        asked = asked.join(hubs, "near", "left").select("near", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        by = ["near", "part"]
    return arcs.join(asked.repartition(buckets, *by), by, "left_semi").select(F.col("far").alias("node"))


def _unseen(reached: DataFrame, seen: DataFrame, depth: int, buckets: int) -> DataFrame:
    """The reached nodes that are new, with their depth, lying by node like those that have been seen."""
    return reached.repartition(buckets, "node").distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(depth))


def trace(arcs: DataFrame, start: DataFrame, direction: str = "down", max_depth: int | None = None, buckets: int | None = None, hub_arcs: int = HUB_ARCS) -> DataFrame:
    """(node, depth): everything reachable from the ``start`` nodes, with the least depth. Arcs with a null end lead nowhere.

    Breadth first: each round follows only the nodes found last and drops those seen before, so
    cycles end. Arcs are written once, in buckets by their near end, and visited nodes in as many buckets by node, one partition for
    each depth. A round then shuffles the nodes of its frontier and those that it reaches, never the arcs nor the nodes seen before. Of a node with more
    than ``hub_arcs`` arcs, parts go to different buckets. The plan of a round stays the same, and a loss costs no earlier round.
    """
    if direction not in ("down", "up"):
        raise ValueError("direction must be 'down' or 'up'")
    spark = arcs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    near, far = ("src", "tgt") if direction == "down" else ("tgt", "src")
    arcs = arcs.where(F.col(near).isNotNull() & F.col(far).isNotNull()).select(F.col(near).alias("near"), F.col(far).alias("far"))
    # whatever the arcs come from is computed once; hubs are counted and buckets filled from what was written
    arcs = cut_lineage(arcs)
    hubs = _hubs(arcs, hub_arcs)
    by = ["near"]
    if hubs is not None:
        part = F.pmod(F.xxhash64("far"), F.coalesce("parts", F.lit(1))).cast("int")
        arcs, by = arcs.join(hubs, "near", "left").select("near", "far", part.alias("part")), ["near", "part"]
    stored, seen = _Bucketed(spark, buckets, by), _Bucketed(spark, buckets, ["node"], ["depth"])
    try:
        stored.append(arcs.repartition(buckets, *by))
        seen.append(start.select(F.col("node").cast("string").alias("node"), F.lit(0).alias("depth")).distinct().repartition(buckets, "node"))
        arcs = stored.read()
        for depth in count(1):
            if max_depth is not None and depth > max_depth:
                break
            frontier = seen.read().where(F.col("depth") == depth - 1)
            if frontier.isEmpty():
                break
            seen.append(_unseen(_reached(arcs, frontier, hubs, buckets), seen.read(), depth, buckets))
        return seen.files().select("node", "depth")
    finally:
        stored.forget()
        seen.forget()


def lineage_trace(edges: DataFrame, object_name: str, direction: str = "down", max_depth: int | None = None) -> DataFrame:
    """Objects reachable from one object (``kind:name``), itself at depth 0."""
    start = edges.sparkSession.createDataFrame([(object_name,)], "node string")
    return trace(pairs(edges), start, direction, max_depth)


def query_lineage(elements: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Source fields of the elements of one query, found along field edges upwards."""
    return trace(pairs(edges, "field"), elements, "up", max_depth).where(F.col("depth") > 0)


def graph_json(edges: DataFrame, scope: Sequence[str], edges_per_document: int = EDGES_PER_DOCUMENT) -> DataFrame:
    """Graph documents ``{"nodes":[{kind,name}],"edges":[{type,src,tgt}]}``: one for each connected part of each scope.

    ``component`` names it by its smallest node. A component of more than ``edges_per_document`` distinct edges is dealt to as many
    documents (``part``) as it takes, by the hash of the edge, so that a document stays of bounded size; together they hold every edge once, with the nodes of
    their edges.
    """
    distinct = cut_lineage(edges.select(*scope, *EDGE_COLUMNS).distinct())
    end = lambda side: F.struct(*scope, node(f"{side}_kind", f"{side}_name").alias("node"))
    found = connected(distinct.select(end("src").alias("src"), end("tgt").alias("tgt")))
    ended = distinct.withColumn("_end", end("src")).join(found.select(F.col("node").alias("_end"), F.col("component.node").alias("component")), "_end").drop("_end")
    sizes = ended.groupBy(*scope, "component").agg(F.ceil(F.count(F.lit(1)) / edges_per_document).alias("_parts"))
    # a null scope value is a scope, too
    same = reduce(Column.__and__, [F.col(f"e.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*scope, "component")])
    sized = ended.alias("e").join(sizes.alias("s"), same).select("e.*", "s._parts")
    parted = sized.withColumn(PART, part_by([F.col(c) for c in EDGE_COLUMNS], F.col("_parts")))
    ends = [F.struct(F.col(f"{side}_kind").alias("kind"), F.col(f"{side}_name").alias("name")) for side in ("src", "tgt")]
    edge = F.struct(
        F.col("edge_type").alias("type"), node("src_kind", "src_name").alias("src"), node("tgt_kind", "tgt_name").alias("tgt")
    )
    grouped = parted.groupBy(*scope, "component", PART).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(*ends))))).alias("nodes"),
        F.sort_array(F.collect_list(edge)).alias("edges"),
    )
    return grouped.select(*scope, "component", PART, F.to_json(F.struct("nodes", "edges")).alias("json"))
