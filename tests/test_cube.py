"""Cube queries and hierarchies against small hand-made facts."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dictspark.operators import hierarchy as H
from dictspark.operators import saved
from dictspark.operators.cube import Characteristic, Cube, Measure, Variable, edited, measure_names, row_names
from dictspark.operators.ordering import numbered

FACTS = [("DE", "A", "2024", 1.0), ("DE", "B", "2024", 2.0), ("FR", "A", "2025", 4.0), (None, "A", "2025", 8.0)]
TEXTS = [("DE", "Germany"), ("FR", "France")]
NODES = [
    (1, None, "ROOT", "WORLD", None, "19000101", "99991231", "A"),
    (2, 1, "AREA", "EU", None, "19000101", "99991231", "A"),
    (3, 2, "C", "N-DE", "DE", "19000101", "99991231", "A"),
    (4, 2, "C", "N-FR", "FR", "19000101", "99991231", "A"),
    (5, 1, "AREA", "OLD", None, "19000101", "20201231", "A"),
    (6, 1, "AREA", "DRAFT", None, "19000101", "99991231", "D"),
]
NODE_ROW = "node_id bigint, parent_id bigint, info_object string, node_name string, node_value string, date_from string, date_to string, version string"


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame(NODES, NODE_ROW)


@pytest.fixture(scope="module")
def cube(spark, nodes):
    facts = spark.createDataFrame(FACTS, "country string, product string, year string, amount double")
    texts = spark.createDataFrame(TEXTS, "key string, text string")
    chars = [Characteristic("country", texts=texts), Characteristic("product"), Characteristic("year"), Characteristic("tree", "country", nodes=nodes)]
    variables = [Variable("YEAR", "year", mandatory=True), Variable("EXIT", "year", input_enabled=False), Variable("NODE", "tree")]
    return Cube.of(facts, chars, [Measure("amount", "amount")], variables)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_axis_operations():
    assert edited(("a",), ("b", "a"), None) == ("a", "b")
    assert edited(("a", "b"), ("c",), "SET") == ("c",)
    assert edited(("a", "b"), ("a",), "REMOVE") == ("b",)
    assert edited(("a",), (), None) == ()
    with pytest.raises(ValueError):
        edited((), (), "NOPE")
    assert row_names(["a", "", ""], ["x", "y"]) == ["a", "y", "ROW_3"]
    assert measure_names([Measure("x", "n", "t"), Measure("x", text="t"), Measure("x")]) == ["n", "t", "dyn_kf_3"]


def test_null_members_are_not_totals(cube):
    assert rows(cube.rows("country").result()) == [(None, 0, 8.0), ("DE", 0, 3.0), ("FR", 0, 4.0), ("SUMME", 0, 15.0)]


def test_totals_follow_their_rows(cube):
    out = rows(cube.rows("country", "product").totals("product", "SHOW").result().select("country", "product", "amount"))
    assert out == [
        (None, "A", 8.0), (None, "SUMME", 8.0), ("DE", "A", 1.0), ("DE", "B", 2.0), ("DE", "SUMME", 3.0), ("FR", "A", 4.0), ("FR", "SUMME", 4.0), ("SUMME", "", 15.0),
    ]


def test_columns_and_schema(cube):
    out = cube.rows("country").columns("product").result(grand_total=False)
    assert out.dtypes == [("country", "string"), ("country_HIER_LEVEL", "int"), ("A_amount", "double"), ("B_amount", "double")]
    assert ("DE", 0, 1.0, 2.0) in rows(out)
    empty = cube.rows("country").columns("product", members={"product": ["A", "B"]}).filter("year", "1999").result()
    assert empty.dtypes == out.dtypes and rows(empty) == []
    assert rows(cube.result()) == [(15.0,)]


def test_display_and_sort(cube):
    shown = cube.rows("country").sort("country", "DESC")
    assert [r[0] for r in rows(shown.display("country", "TEXT").result())] == ["Germany", "France", None, "SUMME"]
    assert [r[0] for r in rows(shown.display("country", "BOTH").result())][:2] == ["FR France", "DE Germany"]
    with pytest.raises(ValueError):
        cube.display("country", "NOPE")
    with pytest.raises(ValueError, match="no texts"):
        cube.rows("product").display("product", "TEXT").result()


def test_variables(cube, spark):
    assert rows(cube.begin([{"NAME": "YEAR", "LOW": "2024"}]).rows("year").result(grand_total=False)) == [("2024", 0, 3.0)]
    for values, message in (([], "without a value: YEAR"), ([{"NAME": "NOPE", "LOW": "1"}], "unknown variable"), ([{"NAME": "EXIT", "LOW": "1"}], "not ready")):
        with pytest.raises(ValueError, match=message):
            cube.begin(values)
    saved = spark.createDataFrame([("V", "YEAR", "I", "EQ", "2025", "")], "VARIANT string, NAME string, SIGN string, OP string, LOW string, HIGH string")
    assert rows(cube.begin(variant="V", variants=saved).rows("year").result(grand_total=False)) == [("2025", 0, 12.0)]
    with pytest.raises(ValueError, match="not saved"):
        cube.begin(variant="W", variants=saved)
    assert [r.entry_type for r in cube.list_variables().orderBy("name").collect()] == ["OPTIONAL", "OPTIONAL", "MANDATORY"]


def test_hierarchy_variable(cube):
    state = cube.begin([{"NAME": "YEAR", "LOW": "2024", "HIGH": "2025"}], hierarchy_variables=[{"NAME": "NODE", "LOW": "EU"}])
    assert rows(state.rows("country").result(grand_total=False)) == [("DE", 0, 3.0), ("FR", 0, 4.0)]


def test_hierarchy_rows(cube):
    out = rows(cube.rows("tree").result(grand_total=False))
    assert sorted(out) == [("EU", 2, 7.0), ("N-DE", 3, 3.0), ("N-FR", 3, 4.0), ("NOT_ASSIGNED", 1, 8.0), ("WORLD", 1, 7.0)]


def test_describe(cube):
    state = {r.name: r for r in cube.rows("product").columns("year").sort("year", "DESC").describe().collect()}
    assert (state["product"].axis, state["year"].axis, state["country"].axis) == ("ROWS", "COLUMNS", "FREE")
    assert state["year"].sort == "DESC" and state["country"].members == 2


def test_hierarchy(nodes):
    out = {r.node_id: r for r in H.hierarchy(nodes).collect()}
    assert set(out) == {1, 2, 3, 4}
    assert (out[1].child_id, out[1].next_id, out[1].level, out[1].path) == (2, None, 1, "/WORLD")
    assert (out[3].child_id, out[3].next_id, out[3].level, out[3].path) == (None, 4, 3, "/WORLD/EU/N-DE")
    assert H.hierarchy(nodes, date_to="20200101").count() == 5
    assert tuple(H.hierarchy(nodes).columns) == H.COLUMNS
    assert sorted(map(tuple, H.closure(H.walk(H.valid_nodes(nodes))).where("node_id = 4").collect())) == [(1, 4, 2), (2, 4, 1), (4, 4, 0)]
    assert sorted(r.node_id for r in H.subtree(H.valid_nodes(nodes), 2).collect()) == [2, 3, 4]


def test_wide_parent(spark):
    """A root with very many children: links and rollup stay right."""
    root = spark.sql("SELECT 0L AS node_id, CAST(NULL AS BIGINT) AS parent_id, 'r' AS node_name")
    many = root.unionByName(spark.range(1, 5001).selectExpr("id AS node_id", "0L AS parent_id", "concat('n', id) AS node_name"))
    linked = H.links(many)
    assert linked.where("next_id = node_id + 1").count() == 4999
    assert linked.where("node_id = 0").first().child_id == 1
    totals = H.rollup(H.walk(many), spark.range(1, 5001).selectExpr("id AS n", "1 AS one"), "n", {"one": F.col("one")})
    assert totals.where("node_id = 0").first().one == 5000


def test_deep_and_broken_hierarchies(spark):
    """A chain of 1,500 levels takes 11 rounds; cycles, what hangs below them and nodes without a parent that exists are left out."""
    chain = spark.range(1500).selectExpr("id AS node_id", "CASE WHEN id > 0 THEN id - 1 END AS parent_id", "CAST(id % 10 AS STRING) AS node_name")
    broken = spark.createDataFrame([(9001, 9002, "a"), (9002, 9003, "b"), (9003, 9001, "c"), (9004, 9001, "d"), (9005, 9005, "e"), (9006, 77777, "f"), (9007, 700, "g")], chain.schema)
    walked = H.walk(chain.unionByName(broken)).select("node_id", "level", F.length("path").alias("n"), F.col("ancestors")[0].alias("top")).collect()
    assert sorted((r.node_id, r.level, r.n, r.top) for r in walked) == sorted([(i, i + 1, 2 * (i + 1), 0) for i in range(1500)] + [(9007, 702, 1404, 0)])
    assert sorted(r.node_id for r in H.subtree(chain.unionByName(broken), 1490).collect()) == list(range(1490, 1500))
    assert sorted(r.node_id for r in H.subtree(chain.unionByName(broken), 9001).collect()) == [9001, 9002, 9003, 9004]
    assert H.walk(chain.limit(0)).collect() == []


def test_numbered(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g")
    out = numbered(df, [F.desc("g"), "id"]).orderBy("row_no").collect()
    assert [r.row_no for r in out] == list(range(1, 1001))
    assert [(r.g, r.id) for r in out] == sorted(((i % 7, i) for i in range(1000)), key=lambda p: (-p[0], p[1]))


def test_pivot_of_counts_and_extremes(spark):
    facts = spark.createDataFrame([("a", "x", 1.0), ("a", "x", None), ("a", "y", 5.0), ("b", "x", 3.0), ("b", None, 9.0)], "r string, c string, v double")
    for agg, want in {
        "sum": [("a", 1.0, 5.0), ("b", 3.0, None), ("SUMME", 4.0, 5.0)],
        "count": [("a", 1.0, 1.0), ("b", 1.0, 0.0), ("SUMME", 2.0, 1.0)],
        "max": [("a", 1.0, 5.0), ("b", 3.0, None), ("SUMME", 3.0, 5.0)],
    }.items():
        cube = Cube.of(facts, [Characteristic("r"), Characteristic("c")], [Measure("v", "v", agg=agg)])
        assert rows(cube.rows("r").columns("c").result().select("r", "x_v", "y_v")) == want


def test_hierarchies_by_name(spark, nodes):
    other = nodes.withColumn("hierarchy_name", F.lit("B")).withColumn("node_id", F.col("node_id") + 100).withColumn("parent_id", F.col("parent_id") + 100)
    both = nodes.withColumn("hierarchy_name", F.lit("A")).unionByName(other)
    assert sorted(map(tuple, H.hierarchy(both, name="A").collect()), key=str) == sorted(map(tuple, H.hierarchy(nodes).collect()), key=str)
    facts = spark.createDataFrame(FACTS, "country string, product string, year string, amount double")

    def result(frame, name):
        return sorted(rows(Cube.of(facts, [Characteristic("tree", "country", nodes=frame, hierarchy=name)], [Measure("amount", "amount")]).rows("tree").result()), key=str)

    assert result(both, "B") == result(nodes, "")


def test_mandatory_variables_that_must_not_be_initial(cube):
    strict = Cube.of(cube.df, cube.characteristics.values(), cube.measures, [Variable("YEAR", "year", mandatory=True, initial_allowed=False)])
    assert strict.list_variables().first().entry_type == "MANDATORY_NOT_INITIAL"
    with pytest.raises(ValueError, match="must not be initial"):
        strict.begin(variables=[{"NAME": "YEAR", "SIGN": "I", "OP": "EQ", "LOW": " "}])
    assert strict.begin(variables=[{"NAME": "YEAR", "SIGN": "I", "OP": "EQ", "LOW": "2020"}]).options


def test_saved_queries(cube, spark):
    state = cube.rows("country", "product").filter("product", "A").totals("product", "SHOW").sort("country", "DESC")
    table = saved.define(spark, "Q1", "C1", state).unionByName(saved.define(spark, "Q2", "C1", cube.rows("product")))
    cubes, value = {"C1": cube}, [{"NAME": "YEAR", "LOW": "2024", "HIGH": "2025"}]
    opened = saved.begin("Q1", cubes, table, value)
    assert (opened.row_axis, opened.members, opened.properties, opened.measures) == (state.row_axis, state.members, state.properties, cube.measures)
    assert rows(opened.result()) == rows(state.begin(value).result())
    assert saved.provider_of("Q1", cubes, table) == saved.provider_of("C1", cubes) == "C1"
    assert saved.begin("C1", cubes, variables=value).row_axis == ()
    none = replace(cube, members={"product": ()})
    assert saved.begin("Q3", cubes, saved.define(spark, "Q3", "C1", none), value).members == {"product": ()}
    variants = spark.createDataFrame([("Q1", "V", "YEAR", "I", "EQ", "2025", ""), ("Q2", "V", "YEAR", "I", "EQ", "2024", "")], "QUERY string, VARIANT string, NAME string, SIGN string, OP string, LOW string, HIGH string")
    assert [o["LOW"] for o in saved.begin("Q2", cubes, table, variant="V", variants=variants).options] == ["2024"]
    bad = spark.createDataFrame([("Q9", "C1", "NOPE", 1, "x", None), ("Q8", "C7", "ROWS", 1, "country", None), ("Q7", "C1", "MEASURE", 1, "zz", None)], saved.DEFINITION)
    for name, message in (("Q5", "unknown cube or query 'Q5', expected one of C1, Q7, Q8, Q9"), ("Q9", "unknown parts: NOPE"), ("Q8", "one known cube, not C7"), ("Q7", "unknown measures: zz")):
        with pytest.raises(ValueError, match=message):
            saved.begin(name, cubes, bad, value)
    with pytest.raises(ValueError, match="without a value: YEAR"):
        saved.begin("Q1", cubes, table)
