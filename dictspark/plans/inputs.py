"""Derived inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.sqltext import name
from ..functions.types import Field
from ..sources.dictionary import TEXT_LANGUAGE
from .registry import TABLES, table

ORDERS = [
    Field("o_orderkey", "NUMC", 10, key=True),
    Field("o_custkey", "NUMC", 10),
    Field("o_orderstatus", "CHAR", 1),
    Field("o_totalprice", "CURR", 15, 2),
    Field("o_orderdate", "DATS", 8),
    Field("o_orderpriority", "CHAR", 15),
]
LINEITEM = [
    Field("l_orderkey", "NUMC", 10),
    Field("l_partkey", "NUMC", 10),
    Field("l_suppkey", "NUMC", 10),
    Field("l_linenumber", "INT4", 4),
    Field("l_quantity", "QUAN", 13, 3),
    Field("l_extendedprice", "CURR", 15, 2),
    Field("l_discount", "DEC", 5, 2),
    Field("l_tax", "DEC", 5, 2),
    Field("l_returnflag", "CHAR", 1),
    Field("l_linestatus", "CHAR", 1),
    Field("l_shipdate", "DATS", 8),
]
EVENTS = [
    Field("event_id", "NUMC", 10, key=True),
    Field("ts", "UTCL", 27, 7),
    Field("user_id", "INT8", 8),
    Field("event_type", "CHAR", 10),
    Field("value", "DEC", 15, 2),
    Field("props", "STRING"),
]
DOCUMENT = [Field("doc_id", "NUMC", 10, key=True), Field("lang", "LANG", 2), Field("source", "STRING"), Field("text", "STRING")]

KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": [], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"],
    "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def entries(spark: SparkSession) -> DataFrame:
    """Dictionary entries of the test tables."""
    return spark.createDataFrame(
        [(t, f"table {t}", "TRANSP", TEXT_LANGUAGE) for t in TABLES],
        "table_name string, text string, class string, language string",
    )


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and bytes as hex, so both engines print the same values."""
    forms = {T.DateType: "CAST({} AS STRING)", T.BinaryType: "hex({})", T.ShortType: "CAST({} AS INT)"}
    names = {f.name: name(f.name) for f in df.schema}
    return df.selectExpr(*[f"{forms.get(type(f.dataType), '{}').format(names[f.name])} AS {names[f.name]}" for f in df.schema])


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
