"""Paths, pointers, list edits, argument shaping, JSON."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dictspark.functions.jsonrows import rows_from_json, rows_to_json
from dictspark.functions.nested import drop_unsupported, get_at, list_append, list_remove_at, list_remove_value, set_at, tokens, unzip_rows, zip_columns
from dictspark.operators.arguments import EXPORT, TABLES, Parameter, load_signature, shape_arguments
from dictspark.operators.paths import select_path, unnest_recursive


@pytest.fixture(scope="module")
def nested(spark):
    return spark.sql(
        "SELECT named_struct('a', 123, 'b', 'TEST', 'd', named_struct('x', 456, 'y', 'BAR')) AS s, "
        "array(named_struct('x', 1, 'y', 'A'), named_struct('x', 2, 'y', 'B'), named_struct('x', 3, 'y', 'C')) AS t, array('p', 'q') AS l, struct() AS e"
    )


def value(df, column):
    out = df.select(column.alias("v")).first()["v"]
    return out.asDict(recursive=True) if hasattr(out, "asDict") else out


def at(df, name):
    return F.col(name), df.schema[name].dataType


def test_tokens():
    assert tokens("/a//b~1c/~0d/") == ["a", "b/c", "~d"]


def test_pointers(nested):
    assert value(nested, get_at(*at(nested, "s"), "/d/y")) == "BAR"
    assert value(nested, get_at(*at(nested, "t"), "/1/y")) == "B"
    assert value(nested, set_at(*at(nested, "s"), "/d/y", F.lit("FOO")))["d"] == {"x": 456, "y": "FOO"}
    assert value(nested, F.to_json(set_at(*at(nested, "t"), "/0/x", F.lit("8")))) == '[{"x":8,"y":"A"},{"x":2,"y":"B"},{"x":3,"y":"C"}]'
    with pytest.raises(ValueError, match="expected one of a, b, d"):
        get_at(*at(nested, "s"), "/nope")
    with pytest.raises(ValueError, match="cannot descend"):
        get_at(*at(nested, "s"), "/a/b")
    for expression in (get_at(*at(nested, "t"), "/3/x"), set_at(*at(nested, "t"), "/3/x", F.lit(1))):
        with pytest.raises(Exception, match="out of bounds"):
            nested.select(expression).collect()


def test_lists(nested):
    assert value(nested, list_append(*at(nested, "l"), F.lit(7))) == ["p", "q", "7"]
    assert value(nested, list_remove_value(*at(nested, "l"), F.lit("p"))) == ["q"]
    assert value(nested, list_remove_at(F.col("l"), 1)) == ["p"]
    columns = nested.select(unzip_rows(*at(nested, "t")).alias("c"))
    assert columns.first()["c"].asDict() == {"x": [1, 2, 3], "y": ["A", "B", "C"]}
    assert columns.select(zip_columns(*at(columns, "c")).alias("r")).first()["r"] == nested.first()["t"]
    with pytest.raises(ValueError, match="not a list"):
        zip_columns(*at(nested, "s"))


def test_paths(nested):
    assert select_path(nested, "/t").collect() == nested.select(F.inline("t")).collect()
    assert [r.y for r in select_path(nested, "/t/y").collect()] == ["A", "B", "C"]
    assert select_path(nested, "/s/d").columns == ["x", "y"]
    assert select_path(nested, "/s/a").collect()[0].asDict() == {"a": 123}
    assert [r.l for r in select_path(nested, "/l").collect()] == ["p", "q"]
    assert select_path(nested, "/e").collect()[0].ok is True
    for path in ("/nope", "/s/nope", "/s/a/b"):
        with pytest.raises(ValueError):
            select_path(nested, path)


def test_unnest(spark):
    deep = spark.sql("SELECT 1 AS k, array(named_struct('a', 1, 'k', 2, 'in', array(named_struct('z', 'u'), named_struct('z', 'v')))) AS c")
    assert [tuple(r) for r in unnest_recursive(deep, "c").collect()] == [(1, 1, 2, "u"), (1, 1, 2, "v")]
    with pytest.raises(ValueError, match="side by side"):
        unnest_recursive(spark.sql("SELECT named_struct('a', array(1), 'b', array(2)) AS c"), "c")


SIGNATURE = [Parameter("ID", T.LongType()), Parameter("OUT", T.StringType(), EXPORT), Parameter("NAME", T.StringType(), "changing"), Parameter("ROWS", T.ArrayType(T.IntegerType()), TABLES)]


def test_arguments(spark):
    calls = spark.createDataFrame([(1, "a"), (None, "b")], "ID int, NAME string")
    shaped = shape_arguments(calls, SIGNATURE)
    assert [tuple(r.arguments) for r in shaped.collect()] == [(1, "a", None), (None, "b", None)]
    assert shaped.schema["arguments"].dataType.names == ["ID", "NAME", "ROWS"]
    assert [tuple(r.arguments) for r in shape_arguments(calls, SIGNATURE, "positional").collect()] == [(1, "a", None), (None, "b", None)]
    with pytest.raises(ValueError, match="unknown parameter"):
        shape_arguments(calls.withColumnRenamed("ID", "id"), SIGNATURE)
    with pytest.raises(ValueError, match="export"):
        shape_arguments(calls.withColumnRenamed("NAME", "OUT"), SIGNATURE)
    with pytest.raises(ValueError, match="too many"):
        shape_arguments(spark.range(1).selectExpr("1 a", "'b' b", "array(1) c", "2 d"), SIGNATURE, "positional")
    with pytest.raises(ValueError, match="'ID' is bigint"):
        shape_arguments(spark.range(1).selectExpr("'x' AS ID"), SIGNATURE)
    lenient = shape_arguments(spark.range(1).selectExpr("'x' AS ID"), SIGNATURE, strict=False).first()
    assert lenient.invalid == "ID" and lenient.arguments.ID is None


def test_signature_rows(spark):
    rows = spark.createDataFrame([(2, "B", "array<int>", "tables"), (1, "A", "bigint", "import")], "pos int, name string, type string, direction string")
    assert load_signature(rows) == [Parameter("A", T.LongType()), Parameter("B", T.ArrayType(T.IntegerType()), "tables")]


def test_drop_unsupported(spark):
    df = spark.sql("SELECT named_struct('HANDLE', '0042', 'AUTORETRY', '', 'TYPO', 'x') AS a")
    kind = df.schema["a"].dataType

    def names(supported, droppable):
        return df.select(drop_unsupported(F.col("a"), kind, supported, droppable).alias("a")).schema["a"].dataType.names

    assert names(["handle"], ["autoretry"]) == ["HANDLE", "TYPO"]
    assert names(["HANDLE", "AUTORETRY"], ["AUTORETRY"]) == ["HANDLE", "AUTORETRY", "TYPO"]
    assert names(["HANDLE"], []) == ["HANDLE", "AUTORETRY", "TYPO"]


ALL = "SELECT 'TEST' AS s, 123 AS i, CAST(5 AS SMALLINT) AS h, 9L AS l, 123.456D AS d, true AS b, CAST(NULL AS INT) AS n, DATE '2020-01-01' AS day, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS ts, CAST('TEST' AS BINARY) AS raw, CAST(1.50 AS DECIMAL(9,2)) AS p, named_struct('e', 456) AS st, array(named_struct('a', 1)) AS li, CAST(NULL AS STRUCT<e: INT>) AS ns"


def test_json(spark):
    df = spark.sql(ALL)
    plain = json.loads(rows_to_json(df).first()["json"])
    assert plain == {
        "s": "TEST", "i": 123, "h": 5, "l": 9, "d": 123.456, "b": True, "n": None, "day": "2020-01-01", "ts": "2020-01-01 00:00:00", "raw": "VEVTVA==",
        "p": "1.50", "st": {"e": 456}, "li": [{"a": 1}], "ns": None,
    }
    typed = rows_to_json(df, typed=True)
    document = json.loads(typed.first()["json"])
    assert document["$type"] == "STRUCT"
    assert document["$value"]["i"] == {"$type": "INTEGER", "$value": 123}
    assert document["$value"]["li"]["$value"][0]["$value"]["a"] == {"$type": "INTEGER", "$value": 1}
    assert document["$value"]["p"] == {"$type": "DECIMAL(9,2)", "$value": "1.50"}
    assert rows_from_json(typed, df.schema).collect() == df.collect()
