"""Registration of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derived input, written once as SQL that both engines read: ``{orders}`` names a table."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SQL with plain table names, for the oracle."""
    return sql.format(**{name: name for name in TABLES})


def row_text_sql(*columns: str) -> str:
    """The oracle's form of :func:`dictspark.operators.bounded.row_text`."""
    return " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)


def md5_slice_sql(text: str, start: int = 1, digits: int = 15) -> str:
    return f"CAST(('0x' || substr(md5({text}), {start}, {digits})) AS BIGINT)"


def part_sql(text: str, parts: int) -> str:
    """The oracle's form of :func:`dictspark.operators.bounded.part_by`."""
    return f"{md5_slice_sql(text)} % {parts}"
