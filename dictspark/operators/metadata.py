"""Metadata views: declared reads of dictionary extracts, each one filter, join and projection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versions import prefer_active

# Provider types, and the parameter types of a mapping rule.
PROVIDER_TYPES = ("CUBE", "ADSO", "HCPR", "ODSO", "ODSVIEW")
SOURCE_PARAMETER, TARGET_PARAMETER = 0, 1


@dataclass(frozen=True)
class MetaView:
    """A view: the extract it reads, what it shows, and which arguments filter which column."""

    extract: str
    columns: tuple[str, ...]
    arguments: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    predicate: str = ""
    versioned_by: tuple[str, ...] = ()
    join: str = ""
    on: tuple[str, ...] = ()


# The fourteen views.
VIEWS: dict[str, MetaView] = {
    "providers": MetaView("providers", ("provider", "type", "text", "version"), {"provider_type": "type"}, versioned_by=("provider",)),
    "provider_fields": MetaView("provider_fields", ("provider", "field", "pos", "role"), {"provider": "provider"}, join="providers", on=("provider",)),
    "datasources": MetaView("datasources", ("datasource", "source_system", "text", "version"), versioned_by=("datasource", "source_system")),
    "datasource_fields": MetaView("datasource_fields", ("datasource", "field", "pos", "type"), {"datasource": "datasource"}, ("datasource",)),
    "transformations": MetaView("transformations", ("transformation", "source", "target", "version"), versioned_by=("transformation",)),
    "transform_fields": MetaView("transform_fields", ("transformation", "rule", "source_field", "target_field"), {"transformation": "transformation"}),
    "composites": MetaView("providers", ("provider", "text", "version"), predicate="type = 'HCPR'", versioned_by=("provider",)),
    "composite_mapping": MetaView("composite_mapping", ("provider", "field", "part_provider", "part_field"), {"provider": "provider"}),
    "queries": MetaView("queries", ("query", "text", "provider", "version"), versioned_by=("query",)),
    "query_usage": MetaView("query_usage", ("query", "object_type", "object"), {"query": "query"}),
    "query_elements": MetaView("query_elements", ("query", "element", "element_type", "text"), {"query": "query"}),
    "query_stats": MetaView("query_stats", ("query", "runs", "runtime", "longest")),
    "objxref": MetaView("objxref", ("object_type", "object", "used_type", "used")),
    "infoobjects": MetaView("infoobjects", ("info_object", "type", "text", "version"), versioned_by=("info_object",)),
}


def meta_view(extracts: Mapping[str, DataFrame], name: str, **arguments: str) -> DataFrame:
    """One of the views over the given extracts, the active version of versioned objects only."""
    if name not in VIEWS:
        raise ValueError(f"unknown view {name!r}, expected one of {', '.join(VIEWS)}")
    view = VIEWS[name]
    unknown = set(arguments) - set(view.arguments)
    if unknown:
        raise ValueError(f"view {name!r} has no argument {', '.join(sorted(unknown))}")
    missing = [a for a in view.required if a not in arguments]
    if missing:
        raise ValueError(f"view {name!r} needs {', '.join(missing)}")
    df = extracts[view.extract]
    if view.predicate:
        df = df.where(view.predicate)
    for argument, value in arguments.items():
        df = df.where(F.col(view.arguments[argument]) == value)
    if view.versioned_by:
        df = prefer_active(df, view.versioned_by)
    if view.join:
        df = df.join(extracts[view.join].select(*view.on), list(view.on), "left_semi")
    return df.select(*view.columns)


def transform_fields(rules: DataFrame) -> DataFrame:
    """Field mappings of transformations from the parameter rows of their rules.

    A rule is read in its active version where it has one. With one target (or one source) every
    source (or target) shows beside it. A rule with several of both shows each field once, the
    other side NULL: together with the rule it says the same as all pairs, in as many rows as the
    rule has fields.
    """
    keys = ["transformation", "rule"]
    is_source, is_target = F.col("paramtype") == SOURCE_PARAMETER, F.col("paramtype") == TARGET_PARAMETER
    rows = rules.select(*keys, "version", "paramtype", "field").distinct()
    sides = rows.groupBy(*keys, "version").agg(
        F.count_if(is_source).alias("_sources"),
        F.count_if(is_target).alias("_targets"),
        F.max(F.when(is_source, F.col("field"))).alias("_source"),
        F.max(F.when(is_target, F.col("field"))).alias("_target"),
    )
    best = prefer_active(sides, keys)
    one_source, one_target = F.col("_sources") == 1, F.col("_targets") == 1
    shown = (is_source & ~(one_source & (F.col("_targets") > 1))) | (is_target & (~one_target | (F.col("_sources") == 0)))
    return (
        rows.join(best, [*keys, "version"])
        .where(shown)
        .select(
            *keys,
            F.when(is_source, F.col("field")).when(one_source, F.col("_source")).alias("source_field"),
            F.when(is_target, F.col("field")).when(one_target, F.col("_target")).alias("target_field"),
        )
    )


def usage_stats(log: DataFrame, by: str = "object") -> DataFrame:
    """Runs, total, mean and longest runtime of each object of a usage log."""
    stats = log.groupBy(by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("runtime").alias("_sum"),
        F.max("runtime").alias("_max"),
        F.min("ts").alias("first_run"),
        F.max("ts").alias("last_run"),
    )
    total = F.col("_sum").cast("double")
    return stats.select(
        by, "runs", total.alias("runtime"), (total / F.col("runs")).alias("mean_runtime"), F.col("_max").cast("double").alias("longest"), "first_run", "last_run"
    )
