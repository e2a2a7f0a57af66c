"""Predicates, select-options, joins, aggregates, set operations, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.selection import option, select_options
from ..operators.reconcile import differing_columns, except_all, fingerprint, narrow, reconcile
from ..operators.versions import prefer_active
from ..sources.extract import computed_once, decode_extract, encode_extract, number_keys
from ..sources.files import table_bytes
from ..sources.reader import read_table
from .inputs import LINEITEM, events, lineitem, orders
from .registry import ORACLES, fixture, md5_slice_sql, plain, query, row_text_sql, table

MONEY = "decimal(18,2)"

# --- predicates --------------------------------------------------------------------------------


def _orders_where(name: str, condition: str):
    @query(name, f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE {condition}")
    def run(spark, sf_dir):
        return read_table(spark, f"{sf_dir}/orders.parquet", filter=condition).select("o_orderkey", "o_custkey", "o_orderstatus")

    return run


_orders_where("filter_eq", "o_orderpriority = '1-URGENT'")
_orders_where("filter_in_small", "o_custkey IN (3, 5, 7, 11, 13)")
_orders_where("filter_in_large", "o_custkey IN (3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41)")
_orders_where("filter_range", "o_totalprice > 1000.5 AND o_totalprice <= 250000.25 AND o_orderstatus <> 'P'")
_orders_where("filter_or", "o_orderstatus = 'F' OR (o_totalprice < 5000 AND o_orderpriority <> '5-LOW')")


@query(
    "filter_null",
    "SELECT o_orderkey, o_totalprice IS NULL AS is_blank FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice "
    "FROM orders) WHERE o_totalprice IS NULL OR o_totalprice > 400000",
)
def filter_null(spark, sf_dir):
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    sparse = orders(spark, sf_dir).select("o_orderkey", price.alias("o_totalprice"))
    kept = sparse.where(F.col("o_totalprice").isNull() | (F.col("o_totalprice").isNotNull() & (F.col("o_totalprice") > 400000)))
    return kept.select("o_orderkey", F.col("o_totalprice").isNull().alias("is_blank"))


@query("filter_struct_field", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 2 = 0")
def filter_struct_field(spark, sf_dir):
    nested = orders(spark, sf_dir).select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("head"))
    return nested.where((F.col("head.o_orderstatus") == "P") & (F.col("head.o_custkey") % 2 == 0)).select("o_orderkey", "head.o_custkey")


# --- select-options ----------------------------------------------------------------------------


def _selection(name: str, options: list[dict[str, str]], condition: str, combine: str = "all"):
    @query(name, f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE {condition}")
    def run(spark, sf_dir):
        picked = select_options(orders(spark, sf_dir), options, combine)
        return picked.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")

    return run


_selection(
    "selopt_eq",
    [option("o_custkey", "3", op="EQ", sign="I"), option("o_custkey", "5", op="EQ", sign="I")],
    "o_custkey IN (3, 5)",
)
_selection("selopt_between", [option("o_orderdate", "19960101", "19961231", "I", "BT")], "o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
_selection(
    "selopt_exclude",
    [option("o_custkey", "10", "40", "I", "BT"), option("o_custkey", "20", "", "E", "EQ"), option("o_custkey", "30", "33", "E", "BT")],
    "o_custkey BETWEEN 10 AND 40 AND o_custkey <> 20 AND NOT (o_custkey BETWEEN 30 AND 33)",
)
_selection(
    "selopt_multi_field",
    [option("o_orderstatus", "F"), option("o_orderstatus", "P"), option("o_totalprice", "300000", op="GE"), option("o_orderpriority", "5-LOW", op="NE")],
    "o_orderstatus IN ('F', 'P') AND o_totalprice >= 300000 AND o_orderpriority <> '5-LOW'",
)
_selection(
    "selopt_any_field",
    [option("o_orderstatus", "P"), option("o_totalprice", "450000", op="GT")],
    "o_orderstatus = 'P' OR o_totalprice > 450000",
    combine="any",
)
_selection(
    "selopt_pattern",
    [option("o_orderpriority", "+-*H*", op="CP"), option("o_orderstatus", "F*", op="NP")],
    "o_orderpriority LIKE '_-%H%' AND o_orderstatus NOT LIKE 'F%'",
)
_selection(
    "selopt_defaults",
    [{"NAME": "o_custkey", "LOW": "100", "HIGH": "120"}, {"NAME": "o_custkey", "LOW": "7"}, {"NAME": "o_orderstatus", "LOW": "O"}],
    "(o_custkey BETWEEN 100 AND 120 OR o_custkey = 7) AND o_orderstatus = 'O'",
)

# --- joins -------------------------------------------------------------------------------------

FLAGSHIP = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, strftime(l.l_shipdate, '%Y-%m-%d') AS shipped, c.c_name AS buyer, nf.n_name AS nation_from,
       nt.n_name AS nation_to, CAST(round(CAST(l.l_extendedprice AS DECIMAL(15,2)), 1) AS DOUBLE) AS price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation nf ON s.s_nationkey = nf.n_nationkey JOIN nation nt ON c.c_nationkey = nt.n_nationkey
ORDER BY 1, 2, 3, 4, 5, 6, 7, 8 LIMIT 100
"""


@query("flagship_join", FLAGSHIP)
def flagship_join(spark, sf_dir):
    """A decoded fixed-width extract joined to four tables, the nations once per role.

    The tables of the buyer are joined among themselves first, so the extract is shuffled once, by its order.
    """
    lines = computed_once(encode_extract(lineitem(spark, sf_dir), LINEITEM, "fixed"))
    items = number_keys(decode_extract(lines, LINEITEM, "fixed"), ["l_orderkey", "l_partkey", "l_suppkey"])
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("from_key"), F.col("n_name").alias("nation_from"))
    target = nation.select(F.col("n_nationkey").alias("to_key"), F.col("n_name").alias("nation_to"))
    buyers = table(spark, sf_dir, "customer").join(target, F.col("c_nationkey") == F.col("to_key"))
    placed = orders(spark, sf_dir).join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    sellers = table(spark, sf_dir, "supplier").join(origin, F.col("s_nationkey") == F.col("from_key"))
    joined = items.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    out = joined.select(
        "l_orderkey",
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        "l_partkey",
        F.col("l_shipdate").cast("string").alias("shipped"),
        F.col("c_name").alias("buyer"),
        "nation_from",
        "nation_to",
        F.round("l_extendedprice", 1).cast("double").alias("price"),
    )
    return out.orderBy(*out.columns).limit(100)


@query(
    "join_composite_key",
    "WITH p AS (SELECT l_orderkey AS k1, l_linenumber AS k2, l_returnflag AS k3, count(*) AS n FROM lineitem GROUP BY ALL), "
    "q AS (SELECT l_orderkey AS k1, l_linenumber AS k2, l_returnflag AS k3, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL) "
    "SELECT p.k1, p.k2, p.k3, n, qty FROM p JOIN q ON p.k1 = q.k1 AND p.k2 = q.k2 AND p.k3 = q.k3",
)
def join_composite_key(spark, sf_dir):
    keyed = lineitem(spark, sf_dir).select(
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_returnflag").alias("k3"), "l_quantity", "l_linestatus"
    )
    keys = ["k1", "k2", "k3"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    closed = keyed.where(F.col("l_linestatus") == "F").groupBy(*keys).agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    return counts.join(closed, keys, "inner")


TEXTS = """
SELECT 'nation' AS object, n_nationkey AS id, l.language, n_name || CASE l.language WHEN 'E' THEN '' ELSE ' (D)' END AS text
FROM {nation} CROSS JOIN (VALUES ('E'), ('D')) l(language) WHERE l.language = 'E' OR n_nationkey % 3 <> 0
"""


@query(
    "join_left_texts",
    f"WITH t AS ({plain(TEXTS)}) SELECT c_custkey, t.text AS nation_text FROM customer LEFT JOIN t ON t.id = c_nationkey AND t.language = 'D'",
)
def join_left_texts(spark, sf_dir):
    texts = fixture(spark, sf_dir, TEXTS).where(F.col("language") == "D").select("id", F.col("text").alias("nation_text"))
    customer = table(spark, sf_dir, "customer")
    return customer.join(texts, F.col("c_nationkey") == F.col("id"), "left").select("c_custkey", "nation_text")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_semi(spark, sf_dir):
    large = orders(spark, sf_dir).where(F.col("o_totalprice") > 400000)
    customer = table(spark, sf_dir, "customer")
    return customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_anti(spark, sf_dir):
    large = orders(spark, sf_dir).where(F.col("o_totalprice") > 400000)
    customer = table(spark, sf_dir, "customer")
    return customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


# --- aggregates --------------------------------------------------------------------------------


@query(
    "agg_count",
    "SELECT 'scan' AS step, count(*) AS n FROM lineitem UNION ALL SELECT 'filter', count(*) FROM lineitem WHERE l_returnflag = 'R' "
    "UNION ALL SELECT 'join', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'",
)
def agg_count(spark, sf_dir):
    items = lineitem(spark, sf_dir)
    partial = orders(spark, sf_dir).where(F.col("o_orderstatus") == "P")
    steps = {
        "scan": items,
        "filter": items.where(F.col("l_returnflag") == "R"),
        "join": items.join(partial, F.col("l_orderkey") == F.col("o_orderkey")),
    }
    out = None
    for step, rows in steps.items():
        counted = rows.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "quality_null_profile",
    "SELECT count(*) AS n, sum(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) > 0 AS has_blank_dates, "
    "CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS blank_dates, count(*) FILTER (WHERE o_totalprice > 300000) AS large FROM orders",
)
def quality_null_profile(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    rows = orders(spark, sf_dir).select(day.alias("day"), "o_totalprice")
    blanks = F.sum(F.when(F.col("day").isNull(), 1).otherwise(0))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        (blanks > 0).alias("has_blank_dates"),
        blanks.alias("blank_dates"),
        F.count_if(F.col("o_totalprice") > 300000).alias("large"),
    )


@query("agg_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def agg_distinct(spark, sf_dir):
    return lineitem(spark, sf_dir).select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


def _digest_sql(*columns: str) -> str:
    text = row_text_sql(*columns)
    lo, hi = md5_slice_sql(text, 1), md5_slice_sql(text, 16)
    return f"count(*) AS n, CAST(sum({lo}) AS VARCHAR) AS digest, CAST(sum({hi}) AS VARCHAR) AS digest2"


@query(
    "fingerprint_grouped",
    f"SELECT o_orderstatus, {_digest_sql('o_orderkey', 'o_custkey', 'CAST(o_totalprice AS DECIMAL(18,2))', 'o_orderpriority')} FROM orders GROUP BY o_orderstatus",
)
def fingerprint_grouped(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderstatus", "o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY), "o_orderpriority")
    return fingerprint(rows, by=["o_orderstatus"], algorithm="md5")


@query("fingerprint_table", f"SELECT {_digest_sql('l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'CAST(l_extendedprice AS DECIMAL(18,2))', 'l_returnflag')} FROM lineitem")
def fingerprint_table(spark, sf_dir):
    rows = lineitem(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_extendedprice").cast(MONEY), "l_returnflag"
    )
    return fingerprint(rows, algorithm="md5")


CHANGED = ("less", "cell", "swapped", "null")
#: Bytes of the input whose rows make one partition of the table that is dealt anew, about.
DEALT_BYTES = 32_000_000


@query("fingerprint_table_fast", f"SELECT count(*) AS n, true AS same_in_any_order, {', '.join(f'true AS differs_{kind}' for kind in CHANGED)} FROM lineitem")
def fingerprint_table_fast(spark, sf_dir):
    """The fast hash is not one that SQL knows, so its properties are compared: neither order nor partitions count, and every change does, also one that leaves the number of rows as it is."""
    rows = lineitem(spark, sf_dir)
    least = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    marked = rows.crossJoin(F.broadcast(rows.agg(F.min(least).alias("least")))).withColumn("hit", least == F.col("least")).drop("least")

    def changed(**values):
        """The table with some cells of its first row changed."""
        return marked.withColumns({c: F.when(F.col("hit"), v).otherwise(F.col(c)) for c, v in values.items()}).select(*rows.columns)

    kinds = {
        "whole": rows,
        "dealt": rows.repartition(max(5, table_bytes(rows) // DEALT_BYTES), "l_suppkey", "l_orderkey"),
        "less": marked.where("NOT hit").drop("hit"),
        "cell": changed(l_partkey=F.col("l_partkey") + 1),
        "swapped": changed(l_partkey=F.col("l_suppkey"), l_suppkey=F.col("l_partkey") + F.when(F.col("l_partkey") == F.col("l_suppkey"), 1).otherwise(0)),
        "null": changed(l_returnflag=F.lit(None).cast("string")),
    }
    digests = [fingerprint(df).select(F.lit(kind).alias("kind"), "n", F.concat_ws(" ", "digest", "digest2").alias("digest")) for kind, df in kinds.items()]

    def of(kind: str, column: str):
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    whole = of("whole", "digest")
    differs = [(whole != of(kind, "digest")).alias(f"differs_{kind}") for kind in CHANGED]
    return reduce(DataFrame.unionByName, digests).agg(of("whole", "n").alias("n"), (whole == of("dealt", "digest")).alias("same_in_any_order"), *differs)


# --- versions, top-k ---------------------------------------------------------------------------

VERSIONED = """
SELECT c_custkey AS id, v.version, c_name || ' ' || v.version AS name, c_nationkey AS nation
FROM {customer} CROSS JOIN (VALUES ('A'), ('D')) v(version)
WHERE (v.version = 'A' AND c_custkey % 5 <> 0) OR (v.version = 'D' AND c_custkey % 3 <> 1)
"""


@query(
    "prefer_active_version",
    f"SELECT id, version, name, nation FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version) AS rn FROM ({plain(VERSIONED)})) WHERE rn = 1",
)
def prefer_active_version(spark, sf_dir):
    return prefer_active(fixture(spark, sf_dir, VERSIONED), ["id"])


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY 2 DESC, 1 LIMIT 50")
def topk(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


# --- set operations and reconciliation ---------------------------------------------------------


@query("setop_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def setop_union(spark, sf_dir):
    buyers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    sellers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return buyers.union(sellers).distinct()


@query(
    "setop_union_all",
    "SELECT 'customer' AS role, c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier",
)
def setop_union_all(spark, sf_dir):
    buyers = table(spark, sf_dir, "customer").select(F.lit("customer").alias("role"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    sellers = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("role"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return buyers.unionByName(sellers)


PAIR_OLD = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM {orders}"
PAIR_NEW = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS o_totalprice
FROM {orders} WHERE o_orderkey % 17 <> 0
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) FROM {orders} WHERE o_orderkey % 150 = 0
"""
PAIR = f"WITH a AS ({plain(PAIR_OLD)}), b AS ({plain(PAIR_NEW)})"


def snapshot_pair(spark, sf_dir):
    old, new = (fixture(spark, sf_dir, sql) for sql in (PAIR_OLD, PAIR_NEW))
    return old, new.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


@query(
    "reconcile_except_all",
    f"{PAIR} SELECT *, 'extra' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL "
    "UNION ALL SELECT *, 'missing', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL",
)
def reconcile_except_all(spark, sf_dir):
    return except_all(*snapshot_pair(spark, sf_dir))


@query(
    "reconcile_pk_pivot",
    f"{PAIR} SELECT o_orderkey, concat_ws(',', CASE WHEN a.o_custkey IS DISTINCT FROM b.o_custkey THEN 'o_custkey' END, "
    "CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END, "
    "CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END) AS columns FROM a JOIN b USING (o_orderkey) "
    "WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice",
)
def reconcile_pk_pivot(spark, sf_dir):
    return differing_columns(*snapshot_pair(spark, sf_dir), ["o_orderkey"])


@query(
    "reconcile_summary",
    f"{PAIR} SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS extra, "
    "(SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS missing, "
    "(SELECT count(*) FROM a JOIN b USING (o_orderkey) WHERE a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus "
    "OR a.o_totalprice IS DISTINCT FROM b.o_totalprice) AS different, CAST(0 AS BIGINT) AS ambiguous",
)
def reconcile_summary(spark, sf_dir):
    return reconcile(*snapshot_pair(spark, sf_dir), ["o_orderkey"])


@query("reconcile_narrowed", ORACLES["reconcile_pk_pivot"])
def reconcile_narrowed(spark, sf_dir):
    """The same changes, found after parts that are equal on both sides were left out by their digests."""
    keys = ["o_orderkey"]
    return differing_columns(*narrow(*snapshot_pair(spark, sf_dir), keys), keys)


@query("reconcile_narrowed_rows", ORACLES["reconcile_except_all"])
def reconcile_narrowed_rows(spark, sf_dir):
    return except_all(*narrow(*snapshot_pair(spark, sf_dir), ["o_orderkey"]))
