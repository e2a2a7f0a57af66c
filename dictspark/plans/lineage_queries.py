"""Lineage over customers, orders, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage as L
from ..operators.metadata import transform_fields
from .inputs import lineitem, orders
from .registry import md5_slice_sql, query, row_text_sql, table

OBJECTS = """
SELECT DISTINCT 'DATA' AS edge_type, 'CUSTOMER' AS src_kind, CAST(o_custkey AS VARCHAR) AS src_name, '' AS src_field, 'ORDER' AS tgt_kind,
       CAST(o_orderkey AS VARCHAR) AS tgt_name, '' AS tgt_field FROM orders
UNION ALL
SELECT DISTINCT 'DATA', 'ORDER', CAST(l_orderkey AS VARCHAR), '', 'PART', CAST(l_partkey AS VARCHAR), '' FROM lineitem
UNION ALL
SELECT DISTINCT 'DATA', 'PART', CAST(l_partkey AS VARCHAR), '', 'SUPPLIER', CAST(l_suppkey AS VARCHAR), '' FROM lineitem
"""
FIELDS = """
SELECT DISTINCT 'FIELD' AS edge_type, 'CUSTOMER' AS src_kind, CAST(o_custkey AS VARCHAR) AS src_name, 'C_NAME' AS src_field, 'ORDER' AS tgt_kind,
       CAST(o_orderkey AS VARCHAR) AS tgt_name, 'O_CUSTKEY' AS tgt_field FROM orders
UNION ALL
SELECT DISTINCT 'FIELD', 'ORDER', CAST(l_orderkey AS VARCHAR), 'O_CUSTKEY', 'PART', CAST(l_partkey AS VARCHAR), 'P_BUYER' FROM lineitem
"""
EDGES = f"SELECT * FROM ({OBJECTS}) UNION ALL SELECT * FROM ({FIELDS})"
# one edge back from a supplier to a customer closes a cycle
CYCLE = f"SELECT * FROM ({OBJECTS}) UNION ALL SELECT DISTINCT 'DATA', 'SUPPLIER', CAST(l_suppkey AS VARCHAR), '', 'CUSTOMER', '1', '' FROM lineitem WHERE l_suppkey % 7 = 0"


def object_edges(spark, sf_dir):
    placed, items = orders(spark, sf_dir), lineitem(spark, sf_dir)
    return [
        L.edges_of(placed, "DATA", ("CUSTOMER", F.col("o_custkey")), ("ORDER", F.col("o_orderkey"))),
        L.edges_of(items, "DATA", ("ORDER", F.col("l_orderkey")), ("PART", F.col("l_partkey"))),
        L.edges_of(items, "DATA", ("PART", F.col("l_partkey")), ("SUPPLIER", F.col("l_suppkey"))),
    ]


def field_edges(spark, sf_dir):
    placed, items = orders(spark, sf_dir), lineitem(spark, sf_dir)
    return [
        L.edges_of(placed, "FIELD", ("CUSTOMER", F.col("o_custkey")), ("ORDER", F.col("o_orderkey")), ("C_NAME", "O_CUSTKEY")),
        L.edges_of(items, "FIELD", ("ORDER", F.col("l_orderkey")), ("PART", F.col("l_partkey")), ("O_CUSTKEY", "P_BUYER")),
    ]


def all_edges(spark, sf_dir):
    return L.lineage_edges(object_edges(spark, sf_dir) + field_edges(spark, sf_dir))


def cyclic_edges(spark, sf_dir):
    back = lineitem(spark, sf_dir).where(F.col("l_suppkey") % 7 == 0)
    closing = L.edges_of(back, "DATA", ("SUPPLIER", F.col("l_suppkey")), ("CUSTOMER", F.lit(1)))
    return L.lineage_edges([*object_edges(spark, sf_dir), closing])


def _trace_sql(edges: str, start: str, near: str, far: str, depth: int) -> str:
    return (
        f"WITH RECURSIVE e AS (SELECT DISTINCT src_kind || ':' || src_name AS src, tgt_kind || ':' || tgt_name AS tgt FROM ({edges})), "
        f"t AS (SELECT '{start}' AS node, 0 AS depth UNION SELECT e.{far}, t.depth + 1 FROM t JOIN e ON e.{near} = t.node WHERE t.depth < {depth}) "
        "SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM t GROUP BY node"
    )


@query("lineage_edges", EDGES)
def lineage_edges(spark, sf_dir):
    return all_edges(spark, sf_dir)


@query("lineage_edges_scoped", f"SELECT * FROM ({EDGES}) WHERE src_name LIKE '1_' OR tgt_name LIKE '1_'")
def lineage_edges_scoped(spark, sf_dir):
    return L.lineage_edges(object_edges(spark, sf_dir) + field_edges(spark, sf_dir), scope="1?")


# the rules of a transformation: sources have even, targets odd line numbers
MAPPED = (
    "WITH r AS (SELECT DISTINCT l_orderkey AS rule, l_linenumber % 2 AS side, 'F' || l_partkey AS f FROM lineitem), "
    "s AS (SELECT rule, count(*) FILTER (WHERE side = 0) AS ns, count(*) FILTER (WHERE side = 1) AS nt FROM r GROUP BY rule), "
    "x AS (SELECT 'T' || o_orderkey AS t, 'DS' || o_custkey AS source, 'P' || (o_orderkey % 100) AS target, CAST(o_orderkey AS VARCHAR) AS rule_field, ns, nt, o_orderkey AS rule "
    "FROM orders JOIN s ON rule = o_orderkey), a AS (SELECT rule, f FROM r WHERE side = 0), b AS (SELECT rule, f FROM r WHERE side = 1) "
)
MAPPED_EDGES = (
    f"{MAPPED} SELECT 'MAPPING' AS edge_type, 'DATASOURCE' AS src_kind, source AS src_name, a.f AS src_field, 'PROVIDER' AS tgt_kind, target AS tgt_name, b.f AS tgt_field "
    "FROM x JOIN a ON a.rule = x.rule JOIN b ON b.rule = x.rule WHERE ns = 1 OR nt = 1 "
    "UNION ALL SELECT 'MAPPING', 'DATASOURCE', source, a.f, 'TRANSFORMATION', t, rule_field FROM x JOIN a ON a.rule = x.rule WHERE nt = 0 OR (ns > 1 AND nt > 1) "
    "UNION ALL SELECT 'MAPPING', 'TRANSFORMATION', t, rule_field, 'PROVIDER', target, b.f FROM x JOIN b ON b.rule = x.rule WHERE ns = 0 OR (ns > 1 AND nt > 1) "
    "UNION ALL SELECT DISTINCT 'USES', 'PART', CAST(l_partkey AS VARCHAR), '', 'ORDER', CAST(l_orderkey AS VARCHAR), '' FROM lineitem"
)


@query("lineage_edges_metadata", MAPPED_EDGES)
def lineage_edges_metadata(spark, sf_dir):
    """Edges from metadata: field mappings of transformations, and the cross reference of objects."""
    items, placed = lineitem(spark, sf_dir), orders(spark, sf_dir)
    rules = items.selectExpr("concat('T', l_orderkey) AS transformation", "l_orderkey AS rule", "l_linenumber % 2 AS paramtype", "concat('F', l_partkey) AS field", "'A' AS version")
    transformations = placed.selectExpr("concat('T', o_orderkey) AS transformation", "concat('DS', o_custkey) AS source", "concat('P', o_orderkey % 100) AS target")
    xref = items.selectExpr("'ORDER' AS object_type", "CAST(l_orderkey AS STRING) AS object", "'PART' AS used_type", "CAST(l_partkey AS STRING) AS used")
    return L.lineage_edges([L.transform_edges(transformations, transform_fields(rules)), L.xref_edges(xref)])


@query("lineage_trace_down", _trace_sql(CYCLE, "CUSTOMER:1", "src", "tgt", 8))
def lineage_trace_down(spark, sf_dir):
    return L.lineage_trace(cyclic_edges(spark, sf_dir), "CUSTOMER:1", "down", 8)


@query("lineage_trace_up", _trace_sql(OBJECTS, "SUPPLIER:3", "tgt", "src", 10))
def lineage_trace_up(spark, sf_dir):
    return L.lineage_trace(L.lineage_edges(object_edges(spark, sf_dir)), "SUPPLIER:3", "up")


@query(
    "query_lineage",
    f"WITH f AS ({FIELDS}), q AS (SELECT 'PART:' || p_partkey || '.P_BUYER' AS node FROM part WHERE p_brand = 'Brand#3'), "
    "e AS (SELECT src_kind || ':' || src_name || '.' || src_field AS src, tgt_kind || ':' || tgt_name || '.' || tgt_field AS tgt FROM f), "
    "d1 AS (SELECT DISTINCT e.src AS node FROM e JOIN q ON e.tgt = q.node), d2 AS (SELECT DISTINCT e.src AS node FROM e JOIN d1 ON e.tgt = d1.node) "
    "SELECT node, 1 AS depth FROM d1 UNION ALL SELECT node, 2 FROM d2",
)
def query_lineage(spark, sf_dir):
    brand = table(spark, sf_dir, "part").where(F.col("p_brand") == "Brand#3")
    elements = brand.select(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string"), F.lit(".P_BUYER")).alias("node"))
    return L.query_lineage(elements, all_edges(spark, sf_dir))


EDGES_PER_DOCUMENT = 40
SCOPED = """
SELECT DISTINCT 'DATA' AS edge_type, 'CUSTOMER' AS src_kind, CAST(o_custkey AS VARCHAR) AS src_name, '' AS src_field, 'ORDER' AS tgt_kind,
       CAST(o_orderkey AS VARCHAR) AS tgt_name, '' AS tgt_field, c_nationkey AS scope FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT DISTINCT 'DAY', 'ORDER', CAST(o_orderkey AS VARCHAR), '', 'DAY', strftime(o_orderdate, '%Y-%m-%d'), '', c_nationkey
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0
"""
_EDGE_TEXT = row_text_sql(*L.EDGE_COLUMNS)


@query(
    "lineage_graph_json",
    f"WITH RECURSIVE e AS ({SCOPED}), a AS (SELECT scope, src_kind || ':' || src_name AS u, tgt_kind || ':' || tgt_name AS v FROM e), "
    "b AS MATERIALIZED (SELECT scope, u, v FROM a UNION SELECT scope, v, u FROM a), "
    "r AS (SELECT scope, u, v FROM b UNION SELECT r.scope, r.u, b.v FROM r JOIN b ON b.scope = r.scope AND b.u = r.v), "
    "c AS (SELECT scope, u, least(u, min(v)) AS component FROM r GROUP BY scope, u), "
    "x AS (SELECT e.*, c.component FROM e JOIN c ON c.scope = e.scope AND c.u = src_kind || ':' || src_name), "
    f"s AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY scope, component) / {EDGES_PER_DOCUMENT}.0) AS BIGINT) AS parts FROM x), "
    f"p AS (SELECT *, {md5_slice_sql(_EDGE_TEXT)} % parts AS part FROM s), "
    "n AS (SELECT scope, component, part, count(DISTINCT node) AS nodes FROM "
    "(SELECT scope, component, part, unnest([src_kind || ':' || src_name, tgt_kind || ':' || tgt_name]) AS node FROM p) GROUP BY ALL) "
    "SELECT scope, component, CAST(part AS BIGINT) AS part, count(*) AS edges, any_value(n.nodes) AS nodes, "
    "md5(string_agg(edge_type || ' ' || src_kind || ':' || src_name || ' ' || tgt_kind || ':' || tgt_name, ';' ORDER BY edge_type, src_kind || ':' || src_name, tgt_kind || ':' || tgt_name)) AS content "
    "FROM p JOIN n USING (scope, component, part) GROUP BY scope, component, part",
)
def lineage_graph_json(spark, sf_dir):
    scoped = orders(spark, sf_dir).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keep = [F.col("c_nationkey").alias("scope")]
    placed = L.edges_of(scoped, "DATA", ("CUSTOMER", F.col("o_custkey")), ("ORDER", F.col("o_orderkey")), keep=keep)
    urgent = scoped.where("o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0")
    days = L.edges_of(urgent, "DAY", ("ORDER", F.col("o_orderkey")), ("DAY", F.date_format("o_orderdate", "yyyy-MM-dd")), keep=keep)
    documents = L.graph_json(placed.unionByName(days), ["scope"], EDGES_PER_DOCUMENT)
    listed = F.from_json("json", "edges array<struct<type:string,src:string,tgt:string>>").getField("edges")
    content = F.md5(F.array_join(F.transform(listed, lambda e: F.concat_ws(" ", e["type"], e["src"], e["tgt"])), ";"))

    def held(part: str):
        return F.json_array_length(F.get_json_object("json", f"$.{part}")).cast("bigint").alias(part)

    return documents.select("scope", "component", "part", held("edges"), held("nodes"), content.alias("content"))


