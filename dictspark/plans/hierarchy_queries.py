"""Hierarchies over region, nation and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy as H
from .inputs import orders
from .registry import fixture, plain, query

# Every nation node exists twice: active and, with an ended validity, delivered.
NODES = """
SELECT CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, 'ROOT' AS info_object, 'ALL' AS node_name, CAST(NULL AS VARCHAR(30)) AS node_value,
       '19000101' AS date_from, '99991231' AS date_to, 'A' AS version
FROM {region} WHERE r_regionkey = 0
UNION ALL
SELECT 1000 + r_regionkey, 0, 'REGION', r_name, NULL, '19000101', '99991231', 'A' FROM {region}
UNION ALL
SELECT 2000 + n_nationkey, 1000 + n_regionkey, 'NATION', n_name, NULL, '19000101', '99991231', 'A' FROM {nation}
UNION ALL
SELECT 2000 + n_nationkey, 1000, 'NATION', n_name, NULL, '19000101', '20201231', 'D' FROM {nation}
UNION ALL
SELECT 100000 + c_custkey, 2000 + c_nationkey, 'CUSTOMER', c_name, CAST(c_custkey AS VARCHAR(30)), CASE WHEN c_custkey % 50 = 7 THEN '20300101' ELSE '20000101' END,
       '99991231', 'A' FROM {customer}
"""
WALK = f"""
WITH RECURSIVE nodes AS (SELECT * FROM ({plain(NODES)}) WHERE version = 'A' AND date_from <= '99991231' AND date_to >= '99991231'),
walk AS (
  SELECT node_id, node_name, 1 AS level, '/' || node_name AS path, [node_id] AS ancestors FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.node_id, n.node_name, w.level + 1, w.path || '/' || n.node_name, list_append(w.ancestors, n.node_id) FROM nodes n JOIN walk w ON n.parent_id = w.node_id
)
"""


def nodes(spark, sf_dir):
    return fixture(spark, sf_dir, NODES)


@query(
    "hierarchy_links",
    f"WITH v AS (SELECT * FROM ({plain(NODES)}) WHERE version = 'A' AND date_from <= '20251231' AND date_to >= '20251231') "
    "SELECT v.node_id, v.parent_id, c.child_id, lead(v.node_id) OVER (PARTITION BY v.parent_id ORDER BY v.node_id) AS next_id, info_object, node_name, node_value, "
    "date_from, date_to FROM v LEFT JOIN (SELECT parent_id AS p, min(node_id) AS child_id FROM v GROUP BY 1) c ON c.p = v.node_id",
)
def hierarchy_links(spark, sf_dir):
    return H.links(H.valid_nodes(nodes(spark, sf_dir), "A", "20251231")).select(
        "node_id", "parent_id", "child_id", "next_id", "info_object", "node_name", "node_value", "date_from", "date_to"
    )


@query("hierarchy_paths", f"{WALK} SELECT node_id, level, path FROM walk")
def hierarchy_paths(spark, sf_dir):
    return H.hierarchy(nodes(spark, sf_dir)).select("node_id", "level", "path")


@query(
    "hierarchy_closure",
    f"{WALK} SELECT unnest(ancestors) AS ancestor, node_id, level - list_position(ancestors, unnest(ancestors)) AS distance FROM walk",
)
def hierarchy_closure(spark, sf_dir):
    pairs = H.closure(H.walk(H.valid_nodes(nodes(spark, sf_dir))))
    return pairs.select("ancestor", "node_id", F.col("distance").cast("int").alias("distance"))


@query(
    "hierarchy_rollup",
    f"{WALK}, spread AS (SELECT unnest(ancestors) AS node_id, w.node_id AS leaf FROM walk w), "
    "val AS (SELECT CASE WHEN o_orderkey % 9 = 4 THEN -1 ELSE 100000 + o_custkey END AS leaf, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price FROM orders GROUP BY 1), "
    "tot AS (SELECT node_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(price) AS DOUBLE) AS price FROM spread JOIN val USING (leaf) GROUP BY 1) "
    "SELECT walk.node_id, level, path, n, price FROM walk LEFT JOIN tot USING (node_id) "
    "UNION ALL SELECT NULL, 1, '/NOT_ASSIGNED', CAST(sum(n) AS BIGINT), CAST(sum(price) AS DOUBLE) FROM val WHERE leaf = -1 HAVING count(*) > 0",
)
def hierarchy_rollup(spark, sf_dir):
    """Some orders belong to a node that the hierarchy doesn't have; the top node and that row add up to all orders."""
    walked = H.walk(H.valid_nodes(nodes(spark, sf_dir)))
    leaf = F.when(F.col("o_orderkey") % 9 == 4, F.lit(-1).cast("long")).otherwise(F.col("o_custkey") + 100000)
    facts = orders(spark, sf_dir).select(leaf.alias("leaf"), F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    totals = H.rollup(walked, facts.withColumn("one", F.lit(1)), "leaf", {"n": F.col("one"), "price": F.col("o_totalprice")})
    return totals.withColumn("price", F.col("price").cast("double"))


@query("hierarchy_subtree", f"{WALK} SELECT node_id, node_name FROM walk WHERE list_contains(ancestors, 1002)")
def hierarchy_subtree(spark, sf_dir):
    return H.subtree(H.valid_nodes(nodes(spark, sf_dir)), 1002).select("node_id", "node_name")
