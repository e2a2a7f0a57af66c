"""Cube queries over lineitem with its order, customer, nation and region."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.cube import Characteristic, Cube, Measure, Variable
from ..operators.ordering import numbered
from ..operators.saved import begin, define
from ..session import cut_lineage
from .inputs import lineitem, orders
from .registry import fixture, plain, query, table

CUBE = (
    "SELECT r_name AS region, n_name AS nation, n_nationkey AS nation_id, c_mktsegment AS segment, strftime(o_orderdate, '%Y-%m') AS month, l_returnflag AS flag, "
    "CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
FLAGS = ("A", "N", "R")

NATION_TEXTS = "SELECT n_name AS key, 'Land ' || n_nationkey AS text FROM {nation} WHERE n_nationkey % 4 <> 3"
NATION_NODES = """
SELECT CAST(0 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id, 'ROOT' AS info_object, 'ALL' AS node_name, CAST(NULL AS VARCHAR(30)) AS node_value,
       '19000101' AS date_from, '99991231' AS date_to, 'A' AS version
FROM {region} WHERE r_regionkey = 0
UNION ALL
SELECT 1000 + r_regionkey, 0, 'REGION', r_name, NULL, '19000101', '99991231', 'A' FROM {region}
UNION ALL
SELECT 2000 + n_nationkey, 1000 + n_regionkey, 'NATION', n_name, n_name, '19000101', '99991231', 'A' FROM {nation}
"""
VARIABLES = (
    Variable("ZREGION", "region", "Region", mandatory=True),
    Variable("ZMONTH", "month", "Month", selection_type="INTERVAL"),
    Variable("ZSEGMENT", "segment", "Segment", selection_type="MULTIPLE_VALUES"),
    Variable("ZTODAY", "month", "Filled by an exit", input_enabled=False, is_exit_variable=True),
    Variable("ZNODE", "nation", "Node", var_type="HIERARCHY_NODE", reference_char="nation"),
)
QUANTITY = Measure("quantity", name="quantity")
PRICE = Measure("price", name="price")


def facts(spark, sf_dir):
    return (
        lineitem(spark, sf_dir)
        .join(orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            F.col("c_mktsegment").alias("segment"),
            F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("month"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        )
    )


def cube(spark, sf_dir, *measures: Measure, with_nodes: bool = False, variables=()) -> Cube:
    nation = Characteristic(
        "nation",
        texts=fixture(spark, sf_dir, NATION_TEXTS),
        nodes=fixture(spark, sf_dir, NATION_NODES) if with_nodes else None,
    )
    plain_chars = [Characteristic(n) for n in ("region", "segment", "month", "flag")]
    return Cube.of(facts(spark, sf_dir), [nation, *plain_chars], measures or (QUANTITY, PRICE), variables)


def _sql(keys: list[str], leaves: str, where: str = "true", totals: bool = True, levels: str = "0", extra: str = "") -> str:
    """Detail rows and the grand total, in the shape of a cube result."""
    names = ", ".join([*keys, *[f"CAST({levels} AS INTEGER) AS {k}_HIER_LEVEL" for k in keys]])
    detail = f"SELECT {names}, {leaves} FROM cube WHERE {where} GROUP BY {', '.join(keys)}"
    labels = ["'SUMME'"] + ["''"] * (len(keys) - 1)
    total_names = ", ".join([*[f"{v} AS {k}" for v, k in zip(labels, keys)], *[f"CAST(0 AS INTEGER) AS {k}_HIER_LEVEL" for k in keys]])
    total = f" UNION ALL SELECT {total_names}, {leaves} FROM cube WHERE {where} HAVING count(*) > 0" if totals else ""
    return f"WITH cube AS ({CUBE}) {detail}{extra}{total}"


BOTH = "CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(price) AS DOUBLE) AS price"


@query("cube_rows", _sql(["region", "segment"], BOTH))
def cube_rows(spark, sf_dir):
    return cube(spark, sf_dir).rows("region", "segment").result()


PIVOT = ", ".join(f"CAST(sum({m}) FILTER (WHERE flag = '{f}') AS DOUBLE) AS {f}_{m}" for f in FLAGS for m in ("quantity", "price"))


@query("cube_pivot", _sql(["nation"], PIVOT))
def cube_pivot(spark, sf_dir):
    return cube(spark, sf_dir).rows("nation").columns("flag", members={"flag": FLAGS}).result()


@query("cube_pivot_discovered", _sql(["nation"], PIVOT))
def cube_pivot_discovered(spark, sf_dir):
    return cube(spark, sf_dir).rows("nation").columns("flag").result()


SUBTOTAL = (
    " UNION ALL SELECT region, 'SUMME' AS segment, CAST(0 AS INTEGER) AS region_HIER_LEVEL, CAST(0 AS INTEGER) AS segment_HIER_LEVEL, "
    "CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(price) AS DOUBLE) AS price FROM cube WHERE true GROUP BY region"
)


@query("cube_totals_show", _sql(["region", "segment"], BOTH, extra=SUBTOTAL))
def cube_totals_show(spark, sf_dir):
    return cube(spark, sf_dir).rows("region", "segment").totals("segment", "SHOW").result()


@query("cube_totals_hide", _sql(["region", "segment"], BOTH))
def cube_totals_hide(spark, sf_dir):
    return cube(spark, sf_dir).rows("region", "segment").totals("segment", "SHOW").totals("segment", "HIDE").result()


@query(
    "cube_multi_measure",
    _sql(
        ["segment"],
        "CAST(sum(price) AS DOUBLE) AS price, CAST(max(price) AS DOUBLE) AS \"Largest item\", CAST(count(quantity) AS DOUBLE) AS dyn_kf_3, "
        "CAST(min(quantity) AS DOUBLE) AS dyn_kf_4",
    ),
)
def cube_multi_measure(spark, sf_dir):
    measures = (PRICE, Measure("price", text="Largest item", agg="max"), Measure("quantity", agg="count"), Measure("quantity", agg="min"))
    return cube(spark, sf_dir, *measures).rows("segment").result()


@query(
    "cube_sort",
    f"WITH cube AS ({CUBE}) SELECT region, segment, CAST(sum(quantity) AS DOUBLE) AS quantity, row_number() OVER (ORDER BY region DESC, segment) AS row_no FROM cube GROUP BY region, segment",
)
def cube_sort(spark, sf_dir):
    """Rows are numbered in the order in which the cube returns them."""
    state = cube(spark, sf_dir, QUANTITY).rows("region", "segment").sort("region", "DESC").sort("segment", "ASC")
    rows = state.result(grand_total=False).withColumn("place", F.monotonically_increasing_id())
    return numbered(rows, ["place"]).select("region", "segment", "quantity", "row_no")


@query("cube_filter_set", _sql(["nation"], BOTH, "segment IN ('BUILDING', 'MACHINERY')"))
def cube_filter_set(spark, sf_dir):
    state = cube(spark, sf_dir).rows("nation").filter("segment", "FURNITURE")
    return state.filter("segment", "BUILDING", "MACHINERY", op="SET").result()


@query("cube_filter_add_remove", _sql(["nation"], BOTH, "region IN ('ASIA', 'EUROPE')"))
def cube_filter_add_remove(spark, sf_dir):
    state = cube(spark, sf_dir).rows("nation").filter("region", "ASIA", "AFRICA")
    return state.filter("region", "EUROPE").filter("region", "AFRICA", op="REMOVE").result()


@query("cube_filter_clear", _sql(["region"], BOTH))
def cube_filter_clear(spark, sf_dir):
    return cube(spark, sf_dir).rows("region").filter("region", "ASIA").filter("region", op="SET").result()


@query("cube_variables", _sql(["nation"], BOTH, "region IN ('ASIA', 'AMERICA') AND month BETWEEN '1996-01' AND '1997-06'"))
def cube_variables(spark, sf_dir):
    values = [
        {"NAME": "ZREGION", "LOW": "ASIA"},
        {"NAME": "ZREGION", "SIGN": "I", "OP": "EQ", "LOW": "AMERICA", "HIGH": ""},
        {"NAME": "ZMONTH", "LOW": "1996-01", "HIGH": "1997-06"},
    ]
    return cube(spark, sf_dir, variables=VARIABLES).begin(variables=values).rows("nation").result()


@query("cube_hierarchy_variable", _sql(["nation"], BOTH, "region = 'EUROPE'"))
def cube_hierarchy_variable(spark, sf_dir):
    node = {"NAME": "ZNODE", "LOW": "EUROPE", "HIERARCHY_NAME": "NATIONS", "HIERARCHY_VERSION": "A", "HIERARCHY_DUE_DATE": ""}
    state = cube(spark, sf_dir, with_nodes=True, variables=VARIABLES[1:]).begin(hierarchy_variables=[node])
    return _without_nodes(state).rows("nation").result()


def _saved(spark, sf_dir):
    """A cube and a query over it, saved under names, with a variant of the query; definitions are read back from a written table."""
    base = cube(spark, sf_dir, variables=VARIABLES[:3])
    state = Cube.of(base.df, base.characteristics.values(), (PRICE,)).rows("nation").columns("flag", members={"flag": FLAGS}).filter("segment", "BUILDING", "MACHINERY")
    definitions = define(spark, "Q_PRICES", "C_SALES", state).unionByName(define(spark, "Q_OTHER", "C_SALES", base.rows("month")))
    values = [("Q_PRICES", "ASIAN", "ZREGION", "I", "EQ", "ASIA", ""), ("Q_PRICES", "ASIAN", "ZMONTH", "I", "BT", "1994-01", "1996-12"), ("Q_OTHER", "ASIAN", "ZREGION", "I", "EQ", "EUROPE", "")]
    variants = spark.createDataFrame(values, "QUERY string, VARIANT string, NAME string, SIGN string, OP string, LOW string, HIGH string")
    return {"C_SALES": base}, cut_lineage(definitions), variants


PRICE_PIVOT = ", ".join(f"CAST(sum(price) FILTER (WHERE flag = '{f}') AS DOUBLE) AS {f}_price" for f in FLAGS)


@query("cube_begin_query", _sql(["nation"], PRICE_PIVOT, "region = 'ASIA' AND month BETWEEN '1994-01' AND '1996-12' AND segment IN ('BUILDING', 'MACHINERY')"))
def cube_begin_query(spark, sf_dir):
    """A saved query opened by its name, its variables filled from a saved variant."""
    cubes, definitions, variants = _saved(spark, sf_dir)
    return begin("Q_PRICES", cubes, definitions, variant="ASIAN", variants=variants).result()


@query("cube_begin_cube", _sql(["region"], BOTH, "region IN ('ASIA', 'EUROPE')"))
def cube_begin_cube(spark, sf_dir):
    """A cube opened by its name."""
    cubes, definitions, _ = _saved(spark, sf_dir)
    return begin("C_SALES", cubes, definitions, [{"NAME": "ZREGION", "LOW": r} for r in ("ASIA", "EUROPE")]).rows("region").result()


def _without_nodes(state: Cube) -> Cube:
    """The same query with the nation shown flat."""
    flat = {n: Characteristic(n, c.column, c.texts) for n, c in state.characteristics.items()}
    return Cube(state.df, flat, state.measures, state.variables, options=state.options, subtrees=state.subtrees)


@query(
    "cube_hierarchy_rows",
    f"WITH cube AS ({CUBE}), lifted AS (SELECT nation AS node, 3 AS lvl, quantity FROM cube UNION ALL SELECT region, 2, quantity FROM cube UNION ALL SELECT 'ALL', 1, quantity FROM cube) "
    "SELECT node AS nation, CAST(lvl AS INTEGER) AS nation_HIER_LEVEL, CAST(sum(quantity) AS DOUBLE) AS quantity FROM lifted GROUP BY node, lvl "
    "UNION ALL SELECT 'SUMME', 0, CAST(sum(quantity) AS DOUBLE) FROM cube",
)
def cube_hierarchy_rows(spark, sf_dir):
    return cube(spark, sf_dir, QUANTITY, with_nodes=True).rows("nation").result()


OUTSIDE = f"WITH cube AS ({CUBE}), inside AS (SELECT * FROM cube WHERE region <> 'ASIA')"


@query(
    "cube_hierarchy_outside",
    f"{OUTSIDE}, lifted AS (SELECT nation AS node, 3 AS lvl, quantity FROM inside UNION ALL SELECT region, 2, quantity FROM inside UNION ALL SELECT 'ALL', 1, quantity FROM inside "
    "UNION ALL SELECT 'NOT_ASSIGNED', 1, quantity FROM cube WHERE region = 'ASIA') "
    "SELECT node AS nation, CAST(lvl AS INTEGER) AS nation_HIER_LEVEL, CAST(sum(quantity) AS DOUBLE) AS quantity FROM lifted GROUP BY node, lvl "
    "UNION ALL SELECT 'SUMME', 0, CAST(sum(quantity) AS DOUBLE) FROM cube",
)
def cube_hierarchy_outside(spark, sf_dir):
    """The hierarchy lacks the nations of one region; their values stand at a node of their own, so the first level adds up to the total."""
    state = cube(spark, sf_dir, QUANTITY, with_nodes=True)
    whole = state.characteristics["nation"]
    asia = whole.nodes.where("node_name = 'ASIA'").select(F.col("node_id").alias("gone"))
    nodes = whole.nodes.join(asia, (F.col("node_id") == F.col("gone")) | (F.col("parent_id") == F.col("gone")), "left_anti")
    chars = [Characteristic("nation", texts=whole.texts, nodes=nodes), *[c for n, c in state.characteristics.items() if n != "nation"]]
    return Cube.of(state.df, chars, state.measures).rows("nation").result()


@query("cube_filter_emptied", f"WITH cube AS ({CUBE}) SELECT region, CAST(0 AS INTEGER) AS region_HIER_LEVEL, {{leaves}} FROM cube WHERE false GROUP BY region".replace("{leaves}", "CAST(sum(quantity) AS DOUBLE) AS quantity"))
def cube_filter_emptied(spark, sf_dir):
    """A filter whose only member is removed lets nothing through."""
    state = cube(spark, sf_dir, QUANTITY).rows("region").filter("region", "ASIA")
    return state.filter("region", "ASIA", op="REMOVE").result(grand_total=False)


@query(
    "cube_columns_sorted",
    f"WITH cube AS ({CUBE}) SELECT region, CAST(position AS INTEGER) AS position, leaf FROM (SELECT DISTINCT region FROM cube), (SELECT flag || '_quantity' AS leaf, row_number() OVER (ORDER BY flag DESC) + 2 AS position FROM (SELECT DISTINCT flag FROM cube))",
)
def cube_columns_sorted(spark, sf_dir):
    """A column axis in descending order: the names of the result's columns by their place."""
    wide = cube(spark, sf_dir, QUANTITY).rows("region").columns("flag").sort("flag", "DESC").result(grand_total=False)
    places = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("leaf")) for i, name in enumerate(wide.columns, 1) if i > 2])
    return wide.select("region", F.inline(places))


TEXT_SQL = (
    f"WITH cube AS ({CUBE}), t AS ({plain(NATION_TEXTS)}), g AS (SELECT nation, CAST(sum(quantity) AS DOUBLE) AS quantity FROM cube GROUP BY nation) "
    "SELECT {label} AS nation, CAST(0 AS INTEGER) AS nation_HIER_LEVEL, quantity FROM g LEFT JOIN t ON t.key = g.nation "
    "UNION ALL SELECT 'SUMME', 0, CAST(sum(quantity) AS DOUBLE) FROM cube"
)


@query("cube_display_text", TEXT_SQL.replace("{label}", "coalesce(t.text, g.nation)"))
def cube_display_text(spark, sf_dir):
    return cube(spark, sf_dir, QUANTITY).rows("nation").display("nation", "TEXT").result()


@query("cube_display_both", TEXT_SQL.replace("{label}", "concat_ws(' ', g.nation, t.text)"))
def cube_display_both(spark, sf_dir):
    return cube(spark, sf_dir, QUANTITY).rows("nation").display("nation", "BOTH").result()


def _describe_sql(where: str, placed: str) -> str:
    counts = " UNION ALL ".join(f"SELECT '{n}' AS name, count(DISTINCT {n}) AS members FROM cube WHERE {where}" for n in ("nation", "region", "segment", "month", "flag"))
    return (
        f"WITH cube AS ({CUBE}), m AS ({counts}), s(axis, position, name, display, totals, sort) AS (VALUES {placed}) "
        "SELECT axis, CAST(position AS INTEGER) AS position, s.name, display, totals, sort, members FROM s JOIN m ON s.name = m.name"
    )


BEGUN = (
    "('ROWS', 1, 'nation', 'TEXT', 'HIDE', 'ASC'), ('ROWS', 2, 'segment', 'KEY', 'SHOW', 'ASC'), ('COLUMNS', 1, 'flag', 'KEY', 'HIDE', 'DESC'), "
    "('FREE', 1, 'region', 'KEY', 'HIDE', 'ASC'), ('FREE', 2, 'month', 'KEY', 'HIDE', 'ASC')"
)


@query("cube_begin", _describe_sql("region = 'ASIA'", BEGUN))
def cube_begin(spark, sf_dir):
    variants = facts(spark, sf_dir).select(
        F.lit("MINE").alias("VARIANT"), F.lit("ZREGION").alias("NAME"), F.lit("I").alias("SIGN"), F.lit("EQ").alias("OP"), F.col("region").alias("LOW"), F.lit("").alias("HIGH")
    )
    saved = variants.where(F.col("LOW") == "ASIA").distinct()
    state = cube(spark, sf_dir, variables=VARIABLES).begin(variant="MINE", variants=saved).rows("nation", "segment").columns("flag")
    return state.display("nation", "TEXT").totals("segment", "SHOW").sort("flag", "DESC").describe()


@query("cube_axis_ops", _sql(["month", "region"], BOTH))
def cube_axis_ops(spark, sf_dir):
    state = cube(spark, sf_dir).rows("nation", "segment").rows("month", op="SET").rows("region", "flag").rows("flag", op="REMOVE")
    return state.result()


@query("cube_result_shape", _sql(["flag", "month"], BOTH, totals=False))
def cube_result_shape(spark, sf_dir):
    return cube(spark, sf_dir).rows("flag", "month").result(grand_total=False)


@query("cube_empty_schema", _sql(["region"], PIVOT, "region = 'ATLANTIS'"))
def cube_empty_schema(spark, sf_dir):
    return cube(spark, sf_dir).rows("region").columns("flag", members={"flag": FLAGS}).filter("region", "ATLANTIS").result()
