"""Scans, layouts, decoding, catalogs and file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import types as D
from ..functions.decode import date_cell, decode_cell, flag_cell, raw_cell, time_cell, utc_cell
from ..functions.encode import encode_cell, flag_text
from ..functions.types import Field
from ..session import work_dir
from ..sources.catalog import attach, federate
from ..sources.extract import decode_cells, decode_extract, encode_extract
from ..sources.files import read_csv, write_table
from ..sources.reader import read_table
from .inputs import DOCUMENT, EVENTS, LINEITEM, ORDERS, entries, events, lineitem, orders, portable
from .registry import query, table

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


# --- typed scans -------------------------------------------------------------------------------


@query("read_table_full", f"SELECT {ORDER_COLUMNS} FROM orders")
def read_table_full(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet")


@query("read_table_count", "SELECT count(*) AS n FROM lineitem")
def read_table_count(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/lineitem.parquet", columns=[]).agg(F.count(F.lit(1)).alias("n"))


@query("read_table_columns", "SELECT o_totalprice, o_orderkey FROM orders")
def read_table_columns(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", columns=["o_totalprice", "o_orderkey"])


@query("read_table_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def read_table_filter(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_orderpriority"], filter="o_orderstatus = 'F'")


@query(
    "read_table_filter_combined",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000 AND o_orderpriority = '1-URGENT'",
)
def read_table_filter_combined(spark, sf_dir):
    scan = read_table(spark, f"{sf_dir}/orders.parquet", filter="o_orderstatus = 'F' AND o_totalprice > 1000")
    return scan.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")


@query("read_table_max_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25")
def read_table_max_rows(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_custkey"], max_rows=25, sorted_by_key=["o_orderkey"])


@query("read_table_key_sorted", "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey")
def read_table_key_sorted(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/customer.parquet", columns=["c_custkey", "c_name", "c_nationkey"], sorted_by_key=["c_custkey"])


@query(
    "read_table_parallel_multiset",
    "SELECT threads, count(*) AS n, sum(l_orderkey) AS keys, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price "
    "FROM lineitem CROSS JOIN (VALUES (1), (4)) t(threads) GROUP BY threads",
)
def read_table_parallel_multiset(spark, sf_dir):
    def summary(threads: int):
        scan = read_table(spark, f"{sf_dir}/lineitem.parquet", columns=["l_orderkey", "l_extendedprice"], threads=threads)
        return scan.agg(
            F.lit(threads).alias("threads"),
            F.count(F.lit(1)).alias("n"),
            F.sum("l_orderkey").alias("keys"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        )

    return summary(1).unionByName(summary(4))


# --- layouts and decoding ----------------------------------------------------------------------

LINEITEM_TYPED = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS l_orderkey, lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS l_partkey,
       lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_quantity AS DECIMAL(13,3)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice,
       CAST(l_discount AS DECIMAL(5,2)) AS l_discount, CAST(l_tax AS DECIMAL(5,2)) AS l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
"""


@query("decode_fixed_width", LINEITEM_TYPED)
def decode_fixed_width(spark, sf_dir):
    lines = encode_extract(lineitem(spark, sf_dir), LINEITEM, "fixed")
    return portable(decode_extract(lines, LINEITEM, "fixed"))


@query(
    "decode_delimited",
    "SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
)
def decode_delimited(spark, sf_dir):
    lines = encode_extract(orders(spark, sf_dir), ORDERS, "delimited", "|")
    return portable(decode_extract(lines, ORDERS, "delimited", "|"))


UNIT_SEPARATOR = "\x1f"


@query(
    "layout_bucket",
    "SELECT doc_id, w AS width, CASE WHEN w <= 128 THEN 128 WHEN w <= 512 THEN 512 WHEN w <= 2048 THEN 2048 WHEN w <= 8192 THEN 8192 "
    "WHEN w <= 30000 THEN 30000 END AS bucket FROM (SELECT doc_id, CAST(13 + length(lang) + length(source) + length(text) AS INTEGER) AS w FROM documents)",
)
def layout_bucket(spark, sf_dir):
    lines = encode_extract(table(spark, sf_dir, "documents"), DOCUMENT, "delimited_wide", UNIT_SEPARATOR, keep=["doc_id"])
    return lines.select("doc_id", F.length("line").alias("width"), "bucket")


def _decoded(rows, key, cell, decoder, out):
    """``key`` and the decoded cell, the cell given as a Column."""
    return rows.select(*key, cell.alias("cell")).selectExpr(*key, f"{decoder('cell')} AS {out}")


@query(
    "decode_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate FROM orders",
)
def decode_dates(spark, sf_dir):
    key = F.col("o_orderkey")
    clean = F.expr(encode_cell("o_orderdate", Field("o_orderdate", "DATS", 8)))
    cell = (
        F.when(key % 7 == 0, F.lit("        "))
        .when(key % 11 == 0, F.lit("00000000"))
        .when(key % 17 == 0, F.lit("20230230"))
        .when(key % 19 == 0, F.concat(clean, F.lit("xx")))
        .otherwise(clean)
    )
    return portable(_decoded(orders(spark, sf_dir), ["o_orderkey"], cell, date_cell, "o_orderdate"))


@query(
    "decode_times",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL "
    "WHEN strftime(ts, '%H%M%S') = '000000' THEN NULL ELSE strftime(ts, '%H:%M:%S') END AS clock FROM events",
)
def decode_times(spark, sf_dir):
    key = F.col("event_id")
    clean = F.translate(F.substring(F.col("ts").cast("string"), 12, 8), ":", "")
    cell = F.when(key % 7 == 0, F.lit("      ")).when(key % 11 == 0, F.lit("000000")).when(key % 13 == 0, F.lit("240000")).otherwise(clean)
    return _decoded(events(spark, sf_dir), ["event_id"], cell, time_cell, "clock")


@query(
    "decode_utc",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 1 THEN date_trunc('second', ts) "
    "WHEN event_id % 3 = 2 THEN date_trunc('minute', ts) ELSE ts END AS ts FROM events",
)
def decode_utc(spark, sf_dir):
    key = F.col("event_id")

    def clean(name: str):
        return F.expr(encode_cell("ts", Field("ts", name)))

    cell = (
        F.when(key % 7 == 0, F.lit("00000000000000"))
        .when(key % 3 == 1, clean("UTCS"))
        .when(key % 3 == 2, clean("UTCM"))
        .otherwise(clean("UTCL"))
    )
    return _decoded(events(spark, sf_dir), ["event_id"], cell, utc_cell, "ts")


@query(
    "decode_decimal_trailing_minus",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN -CAST(o_totalprice AS DECIMAL(15,2)) "
    "ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS o_totalprice FROM orders",
)
def decode_decimal_trailing_minus(spark, sf_dir):
    price = Field("o_totalprice", "CURR", 15, 2)
    signed = encode_cell("if(o_orderkey % 13 = 0, -o_totalprice, o_totalprice)", price)
    cell = F.when(F.col("o_orderkey") % 7 == 0, F.lit(" ")).otherwise(F.expr(signed))
    return _decoded(orders(spark, sf_dir), ["o_orderkey"], cell, lambda c: decode_cell(c, price), "o_totalprice")


@query(
    "decode_raw_hex",
    "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN NULL ELSE hex(c_name) END AS raw FROM customer",
)
def decode_raw_hex(spark, sf_dir):
    key = F.col("c_custkey")
    digits = F.hex(F.col("c_name"))
    cell = (
        F.when(key % 7 == 0, F.lit("  "))
        .when(key % 11 == 0, F.lit("ABC"))
        .when(key % 13 == 0, F.lit("00GG"))
        .when(key % 17 == 0, F.concat(F.lower(digits), F.lit("  ")))
        .otherwise(digits)
    )
    return portable(_decoded(table(spark, sf_dir, "customer"), ["c_custkey"], cell, raw_cell, "raw"))


BLANKED = {"n": ("l_linenumber", 5, Field("n", "INT4")), "price": ("l_extendedprice", 7, Field("price", "DEC", 15, 2)), "quantity": ("l_quantity", 11, Field("quantity", "FLTP"))}


@query(
    "decode_blank_numerics",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS n, "
    "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS price, "
    "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS quantity FROM lineitem",
)
def decode_blank_numerics(spark, sf_dir):
    cells = [f"if(l_partkey % {modulus} = 0, '   ', {encode_cell(column, field)}) AS {out}" for out, (column, modulus, field) in BLANKED.items()]
    rows = lineitem(spark, sf_dir).selectExpr("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", *cells)
    return decode_cells(rows, [field for _, _, field in BLANKED.values()])


@query("decode_numc", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS numc FROM customer")
def decode_numc(spark, sf_dir):
    field = Field("numc", "NUMC", 10)
    cell = F.expr(encode_cell("c_custkey", field))
    return _decoded(table(spark, sf_dir, "customer"), ["c_custkey"], cell, lambda c: decode_cell(c, field), "numc")


@query("decode_xflag", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus = 'F' END AS finished FROM orders")
def decode_xflag(spark, sf_dir):
    cell = F.when(F.col("o_orderkey") % 7 == 0, F.lit("?")).otherwise(F.expr(flag_text("o_orderstatus = 'F'")))
    return _decoded(orders(spark, sf_dir), ["o_orderkey"], cell, flag_cell, "finished")


def _type_cell(name: str) -> tuple[str, Field]:
    """A well-formed cell of a dictionary type from an order, and its field."""
    if name in D.DATE_TYPES + D.UTC_TYPES:
        return encode_cell("o_orderdate", Field("x", name)), Field(name, name, 27)
    if name in D.TIME_TYPES:
        return "'235959'", Field(name, name, 6)
    if name in D.RAW_TYPES:
        return "hex(o_orderpriority)", Field(name, name, 16)
    if name in D.DECIMAL_TYPES:
        return "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)", Field(name, name, 15, 2)
    if name in D.INTEGER_TYPES or name in D.DURATION_TYPES or name in D.FLOAT_TYPES:
        return "CAST(o_orderkey % 100 AS STRING)", Field(name, name, 4)
    return "o_orderpriority", Field(name, name, 20)


TYPE_NAMES = sorted(D.ALL_TYPES)
NEVER_NULL = sorted((*D.TEXT_TYPES, *D.OPAQUE_TYPES))


@query(
    "decode_type_map",
    "SELECT t.name AS sap_type, count(*) AS cells, count(*) FILTER (WHERE o_orderkey % 7 = 0 AND t.name NOT IN ("
    + ", ".join(f"'{n}'" for n in NEVER_NULL)
    + ")) AS nulls FROM orders CROSS JOIN (VALUES "
    + ", ".join(f"('{n}')" for n in TYPE_NAMES)
    + ") t(name) GROUP BY t.name",
)
def decode_type_map(spark, sf_dir):
    cells = {name: _type_cell(name) for name in TYPE_NAMES}
    rows = orders(spark, sf_dir).selectExpr(*[f"if(o_orderkey % 7 = 0, '   ', {cell}) AS {name}" for name, (cell, _) in cells.items()])
    decoded = decode_cells(rows, [field for _, field in cells.values()])
    nulls = [F.count_if(F.col(n).isNull()).alias(n) for n in TYPE_NAMES]
    counts = decoded.agg(F.count(F.lit(1)).alias("cells"), *nulls)
    return counts.unpivot("cells", TYPE_NAMES, "sap_type", "nulls").select("sap_type", "cells", "nulls")


@query(
    "decode_roundtrip",
    "SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(15,2)) AS value, props FROM events",
)
def decode_roundtrip(spark, sf_dir):
    lines = encode_extract(events(spark, sf_dir), EVENTS, "delimited")
    return decode_extract(lines, EVENTS, "delimited").withColumn("event_id", F.col("event_id").cast("bigint"))


@query(
    "encode_extract",
    "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || rpad(o_orderstatus, 1, ' ') "
    "|| lpad(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || ' ', 17, ' ') || strftime(o_orderdate, '%Y%m%d') || rpad(o_orderpriority, 15, ' ') AS line FROM orders",
)
def encode_orders(spark, sf_dir):
    return encode_extract(orders(spark, sf_dir), ORDERS, "fixed", keep=["o_orderkey"])


# --- catalogs, files ---------------------------------------------------------------------------


def _table_counts(catalog):
    out = None
    for name in catalog.tables():
        rows = catalog.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _counts_sql(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in names)


@query("attach_list", _counts_sql("orders", "customer"))
def attach_list(spark, sf_dir):
    return _table_counts(attach(spark, sf_dir, "orders, customer", "sys"))


@query("attach_pattern", _counts_sql("lineitem", "nation", "part", "pages"))
def attach_pattern(spark, sf_dir):
    return _table_counts(attach(spark, sf_dir, "line*,?ation,pa*", "sys", entries(spark)))


@query("attach_dedup", _counts_sql("orders", "nation", "region"))
def attach_dedup(spark, sf_dir):
    return _table_counts(attach(spark, sf_dir, "orders,ORDERS,ord%,nation,region,re*", "sys", entries(spark)))


@query(
    "attach_join",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'",
)
def attach_join(spark, sf_dir):
    sales = attach(spark, sf_dir, "orders", "sales")
    master = attach(spark, sf_dir, "customer", "master")
    left = sales.table("orders", filter="o_orderstatus = 'P'")
    return left.join(master.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query(
    "federated_union",
    "SELECT source_system, c_mktsegment, count(*) AS n FROM (SELECT 'east' AS source_system, * FROM customer UNION ALL "
    "SELECT 'west' AS source_system, * FROM customer) GROUP BY ALL",
)
def federated_union(spark, sf_dir):
    systems = [attach(spark, sf_dir, "customer", alias) for alias in ("east", "west")]
    return federate(systems, "customer").groupBy("source_system", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "csv_join",
    "SELECT l_orderkey, l_partkey, o_orderstatus, CAST(l_extendedprice AS DECIMAL(15,2)) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'BUILDING'",
)
def csv_join(spark, sf_dir):
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").write.csv(path, header=True)
    segments = read_csv(spark, path, "c_custkey bigint, c_mktsegment string").where(F.col("c_mktsegment") == "BUILDING")
    return (
        lineitem(spark, sf_dir)
        .join(orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(segments, F.col("o_custkey") == F.col("c_custkey"))
        .select("l_orderkey", "l_partkey", "o_orderstatus", F.col("l_extendedprice").cast("decimal(15,2)").alias("price"))
    )


@query("sink_parquet_roundtrip", f"SELECT {ORDER_COLUMNS} FROM orders")
def sink_parquet_roundtrip(spark, sf_dir):
    scan = read_table(spark, f"{sf_dir}/orders.parquet")
    return write_table(scan, work_dir(spark, "sink"), partition_by=("o_orderstatus",)).select(*scan.columns)
