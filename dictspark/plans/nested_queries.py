"""Paths, pointers, lists, argument shaping and JSON over nested rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonrows import rows_from_json, rows_to_json, value_to_json
from ..functions.nested import drop_unsupported, get_at, list_append, list_remove_at, list_remove_value, set_at, unzip_rows, zip_columns
from ..operators.arguments import EXPORT, TABLES, Parameter, shape_arguments
from ..operators.bounded import PART, part_at
from ..operators.paths import select_path, unnest_recursive
from .inputs import orders
from .registry import query, table

TURNS_PER_ROW = 4
# conversations with the list they are nested into and their place in it
PLACED = (
    "(SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) AS place "
    f"FROM (SELECT *, turn // {TURNS_PER_ROW} AS part FROM conversations))"
)


def nested_turns(spark, sf_dir):
    """Conversations as (conv_id, part, turns): a list for every few turns in their order, so a long one takes several rows."""
    turn = F.struct(F.col("turn"), F.struct(F.col("role"), F.col("text")).alias("said"))
    parted = table(spark, sf_dir, "conversations").withColumn(PART, part_at(F.col("turn"), TURNS_PER_ROW))
    return parted.groupBy("conv_id", PART).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


@query("path_struct", "SELECT o_custkey, o_orderstatus FROM orders")
def path_struct(spark, sf_dir):
    nested = orders(spark, sf_dir).select(F.struct(F.struct("o_custkey", "o_orderstatus").alias("HEAD")).alias("RESULT"))
    return select_path(nested, "/RESULT/HEAD")


@query("path_table", "SELECT turn, role AS said_role, text AS said_text FROM conversations")
def path_table(spark, sf_dir):
    rows = select_path(nested_turns(spark, sf_dir), "/turns")
    return rows.select("turn", F.col("said.role").alias("said_role"), F.col("said.text").alias("said_text"))


@query("path_scalar", "SELECT role FROM conversations")
def path_scalar(spark, sf_dir):
    return select_path(nested_turns(spark, sf_dir), "/turns/said/role")


@query("path_empty_ok", "SELECT true AS ok, count(*) AS n FROM orders")
def path_empty_ok(spark, sf_dir):
    empty = orders(spark, sf_dir).select(F.struct().alias("RESULT"))
    return select_path(empty, "/RESULT").groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@query("pointer_get", f"SELECT conv_id, role AS first_role, text AS first_text FROM {PLACED} WHERE place = 1")
def pointer_get(spark, sf_dir):
    nested = nested_turns(spark, sf_dir)
    kind = nested.schema["turns"].dataType
    return nested.select(
        "conv_id",
        get_at(F.col("turns"), kind, "/0/said/role").alias("first_role"),
        get_at(F.col("turns"), kind, "/0/said/text").alias("first_text"),
    )


@query("pointer_set", f"SELECT conv_id, turn, CASE WHEN place = 1 THEN 'opener' ELSE role END AS role, text FROM {PLACED}")
def pointer_set(spark, sf_dir):
    nested = nested_turns(spark, sf_dir)
    edited = set_at(F.col("turns"), nested.schema["turns"].dataType, "/0/said/role", F.lit("opener"))
    turns = nested.select("conv_id", F.inline(edited))
    return turns.select("conv_id", "turn", "said.role", "said.text")


@query("list_append", f"SELECT conv_id, turn FROM conversations UNION ALL SELECT conv_id, -1 FROM {PLACED} WHERE place = 1")
def append_turn(spark, sf_dir):
    nested = nested_turns(spark, sf_dir).select("conv_id", F.transform("turns", lambda t: t.getField("turn")).alias("turns"))
    longer = list_append(F.col("turns"), nested.schema["turns"].dataType, F.lit("-1"))
    return nested.select("conv_id", F.explode(longer).alias("turn"))


@query(
    "list_remove",
    f"SELECT conv_id, 'value' AS way, role FROM conversations WHERE role <> 'user' UNION ALL SELECT conv_id, 'position', role FROM {PLACED} WHERE place <> 2",
)
def remove_turns(spark, sf_dir):
    nested = nested_turns(spark, sf_dir).select("conv_id", F.transform("turns", lambda t: t.getField("said").getField("role")).alias("roles"))
    kind = nested.schema["roles"].dataType
    by_value = nested.select("conv_id", F.lit("value").alias("way"), F.explode(list_remove_value(F.col("roles"), kind, F.lit("user"))).alias("role"))
    by_position = nested.select("conv_id", F.lit("position").alias("way"), F.explode(list_remove_at(F.col("roles"), 1)).alias("role"))
    return by_value.unionByName(by_position)


@query("zip_columns", "SELECT conv_id, turn, role FROM conversations")
def zip_turns(spark, sf_dir):
    columns = nested_turns(spark, sf_dir).select(
        "conv_id",
        F.struct(
            F.transform("turns", lambda t: t.getField("turn")).alias("turn"),
            F.transform("turns", lambda t: t.getField("said").getField("role")).alias("role"),
        ).alias("columns"),
    )
    return columns.select("conv_id", F.inline(zip_columns(F.col("columns"), columns.schema["columns"].dataType)))


@query(
    "unzip_rows",
    "SELECT conv_id, CAST(part AS BIGINT) AS part, CAST(sum(turn) AS BIGINT) AS turns, string_agg(role, ',' ORDER BY place) AS roles "
    f"FROM {PLACED} GROUP BY conv_id, part",
)
def unzip_turns(spark, sf_dir):
    nested = nested_turns(spark, sf_dir).select(
        "conv_id", PART, F.transform("turns", lambda t: F.struct(t.getField("turn").alias("turn"), t.getField("said").getField("role").alias("role"))).alias("turns")
    )
    lists = nested.select("conv_id", PART, unzip_rows(F.col("turns"), nested.schema["turns"].dataType).alias("c"))
    total = F.aggregate("c.turn", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return lists.select("conv_id", PART, total.alias("turns"), F.array_join("c.role", ",").alias("roles"))


@query("unnest_recursive", f"SELECT conv_id, CAST(part AS BIGINT) AS part, turn, role, text FROM {PLACED}")
def unnest_turns(spark, sf_dir):
    return unnest_recursive(nested_turns(spark, sf_dir), "turns")


SIGNATURE = [
    Parameter("ORDER_ID", T.LongType()),
    Parameter("MESSAGE", T.StringType(), EXPORT),
    Parameter("STATUS", T.StringType()),
    Parameter("PRICE", T.DecimalType(15, 2), "changing"),
    Parameter("ITEMS", T.ArrayType(T.LongType()), TABLES),
]
SHAPED = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS ORDER_ID, CAST(o_totalprice AS DECIMAL(15,2)) AS PRICE"


@query(
    "arguments_named",
    f"SELECT {SHAPED}, CAST(NULL AS VARCHAR) AS STATUS, o_orderkey % 7 = 0 AS failed FROM orders",
)
def arguments_named(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_orderkey").cast("string"))
    calls = orders(spark, sf_dir).select(key.alias("ORDER_ID"), F.col("o_totalprice").alias("PRICE"))
    shaped = shape_arguments(calls, SIGNATURE, "named", strict=False)
    return shaped.select("arguments.ORDER_ID", "arguments.PRICE", "arguments.STATUS", (F.col("invalid") == "ORDER_ID").alias("failed"))


@query("arguments_positional", f"SELECT {SHAPED}, o_orderstatus AS STATUS FROM orders")
def arguments_positional(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey"))
    calls = orders(spark, sf_dir).select(key.alias("a"), F.col("o_orderstatus").alias("b"), F.col("o_totalprice").alias("c"))
    shaped = shape_arguments(calls, SIGNATURE, "positional")
    return shaped.select("arguments.ORDER_ID", "arguments.PRICE", "arguments.STATUS")


@query("drop_unsupported", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def drop_fields(spark, sf_dir):
    nested = orders(spark, sf_dir).select(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("args"))
    kept = drop_unsupported(F.col("args"), nested.schema["args"].dataType, ["O_ORDERKEY", "o_custkey"], ["O_OrderPriority", "o_custkey"])
    return nested.select(kept.alias("args")).select("args.*")


JSON_ROW = "o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderdate"


def json_source(spark, sf_dir):
    return orders(spark, sf_dir).selectExpr("o_orderkey", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query(
    "json_plain",
    f"SELECT o_orderkey, CAST(to_json({{'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, 'o_totalprice': o_totalprice, "
    f"'o_orderdate': CAST(o_orderdate AS VARCHAR)}}) AS VARCHAR) AS json FROM (SELECT {JSON_ROW} FROM orders)",
)
def json_plain(spark, sf_dir):
    return rows_to_json(json_source(spark, sf_dir), keep=("o_orderkey",))


def _wrap_sql(kind: str, value: str) -> str:
    return f"{{'$type': '{kind}', '$value': {value}}}"


@query(
    "json_typed",
    "SELECT conv_id, turn, CAST(to_json("
    + _wrap_sql("STRUCT", "{'turn': " + _wrap_sql("BIGINT", "turn") + ", 'said': " + _wrap_sql("STRUCT", "{'role': " + _wrap_sql("VARCHAR", "role") + ", 'text': " + _wrap_sql("VARCHAR", "text") + "}") + "}")
    + ") AS VARCHAR) AS json FROM conversations",
)
def json_typed(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    nested = turns.select("conv_id", "turn", F.struct("role", "text").alias("said"))
    row = nested.select("conv_id", F.struct("turn", "said").alias("row"))
    return row.select("conv_id", "row.turn", value_to_json(F.col("row"), row.schema["row"].dataType, typed=True).alias("json"))


@query("json_typed_roundtrip", f"SELECT {JSON_ROW}, CAST(o_totalprice AS DECIMAL(15,2)) AS price, hex(o_orderpriority) AS raw FROM orders")
def json_typed_roundtrip(spark, sf_dir):
    rows = orders(spark, sf_dir).selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS price", "encode(o_orderpriority, 'UTF-8') AS raw",
    )
    back = rows_from_json(rows_to_json(rows, typed=True), rows.schema)
    return back.withColumn("raw", F.hex("raw"))
