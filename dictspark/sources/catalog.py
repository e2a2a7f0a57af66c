"""Attach a folder of tables as a named catalog with an allow-list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.globs import is_glob, like_pattern
from .dictionary import TABLE_CLASSES, TEXT_LANGUAGE
from .reader import shape_scan

MAX_TABLES = 5000


class Catalog:
    """Tables of one attached system. With an allow-list, nothing else can be read."""

    def __init__(self, spark: SparkSession, path: str, alias: str, allowed: Sequence[str] | None, suffix: str = ".parquet"):
        self.spark, self.path, self.alias, self.suffix = spark, path.rstrip("/"), alias, suffix
        self._allowed = None if allowed is None else {name.upper(): name for name in allowed}

    def tables(self) -> list[str]:
        """The allow-list; empty for an on-demand catalog, which lists nothing."""
        return list(self._allowed.values()) if self._allowed is not None else []

    def view_name(self, name: str) -> str:
        return f"{self.alias}__{name}"

    def table(self, name: str, **scan) -> DataFrame:
        """A lazy scan of a table; ``scan`` takes the options of :func:`shape_scan`."""
        if self._allowed is not None:
            if name.upper() not in self._allowed:
                raise KeyError(f"table {name!r} is not attached to {self.alias!r}")
            name = self._allowed[name.upper()]
        return shape_scan(self.spark.read.parquet(f"{self.path}/{name}{self.suffix}"), **scan)

    def with_source(self, name: str, **scan) -> DataFrame:
        """A table with the name of its system, for unions over several systems."""
        return self.table(name, **scan).withColumn("source_system", F.lit(self.alias))

    def register(self) -> Catalog:
        """Temporary views ``alias__table`` for SQL."""
        for name in self.tables():
            self.table(name).createOrReplaceTempView(self.view_name(name))
        return self

    def listing(self, entries: DataFrame) -> DataFrame:
        """The entries of a dictionary that this catalog exposes."""
        return entries.where(F.upper("table_name").isin(*(self._allowed or {})))


def resolve_tables(entries: DataFrame, patterns: str | Sequence[str]) -> list[str]:
    """Names and globs → table names, in order of the patterns, first spelling wins.

    Globs search the dictionary entries, those of table classes in English where entries tell both. Exact names take the spelling of their entry, or stay as
    they are without one. The answer is plan-time metadata and is capped: one name beyond the cap
    is an error, not a cut.
    """
    parts = list(dict.fromkeys(p.strip() for p in (patterns.split(",") if isinstance(patterns, str) else patterns) if p.strip()))
    if {"class", "language"} <= set(entries.columns):
        entries = entries.where(F.col("class").isin(*TABLE_CLASSES) & (F.col("language") == TEXT_LANGUAGE))
    exact = list(dict.fromkeys(p.upper() for p in parts if not is_glob(p)))
    listed = entries.where(F.upper("table_name").isin(*exact)).groupBy(F.upper("table_name").alias("name")).agg(F.min("table_name").alias("spelling")) if exact else None
    spelled = {r["name"]: r["spelling"] for r in listed.collect()} if exact else {}  # a row for each name asked for, at most
    found: dict[str, str] = {}
    for part in parts:
        if is_glob(part):
            hits = entries.where(F.upper("table_name").like(like_pattern(part.upper())))
            names = [r[0] for r in hits.select("table_name").distinct().orderBy("table_name").limit(MAX_TABLES + 1).collect()]
        else:
            names = [spelled.get(part.upper(), part)]
        for name in names:
            found.setdefault(name.upper(), name)
        if len(found) > MAX_TABLES:
            raise ValueError(f"the patterns match more than {MAX_TABLES} tables")
    return list(found.values())


def attach(
    spark: SparkSession,
    path: str,
    tables: str | Sequence[str] | None = None,
    alias: str = "src",
    entries: DataFrame | None = None,
) -> Catalog:
    """Attach a folder. Without ``tables`` every name is looked up on demand."""
    if tables is None:
        return Catalog(spark, path, alias, None)
    if entries is None:
        parts = tables.split(",") if isinstance(tables, str) else tables
        if any(is_glob(p) for p in parts):
            raise ValueError("patterns need dictionary entries to search")
        entries = spark.createDataFrame([], "table_name string")
    names = resolve_tables(entries, tables)
    return Catalog(spark, path, alias, names).register()


def federate(catalogs: Mapping[str, Catalog] | Sequence[Catalog], name: str, **scan) -> DataFrame:
    """One table over several systems, rows marked with their system."""
    catalogs = list(catalogs.values()) if isinstance(catalogs, Mapping) else list(catalogs)
    out = catalogs[0].with_source(name, **scan)
    for catalog in catalogs[1:]:
        out = out.unionByName(catalog.with_source(name, **scan))
    return out
