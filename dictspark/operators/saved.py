"""Cube queries saved as rows and opened by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cube import PROPERTIES, Cube, measure_names

DEFINITION = "query string, provider string, part string, position int, name string, value string"
#: Rows that a definition may have, and names that an error lists.
MAX_ROWS, NAMES_SHOWN = 10_000, 20
HEAD, MEASURE, ROWS, COLUMNS, FILTER = "QUERY", "MEASURE", "ROWS", "COLUMNS", "FILTER"


def define(spark: SparkSession, name: str, provider: str, state: Cube) -> DataFrame:
    """The rows that save the state of a cube query: its measures, axes, member filters and properties, in order. Values of variables are not part of it."""
    rows = [(HEAD, 0, provider, None)]
    rows += [(MEASURE, i, m, None) for i, m in enumerate(measure_names(state.measures), 1)]
    rows += [(ROWS, i, c, None) for i, c in enumerate(state.row_axis, 1)]
    fixed = dict(state.column_members)
    for i, char in enumerate(state.column_axis, 1):
        rows += [(COLUMNS, i, char, None if m is None else str(m)) for m in fixed.get(char) or (None,)]
    for char, members in state.members.items():
        rows += [(FILTER, i, char, m) for i, m in enumerate(members, 1)] or [(FILTER, 0, char, None)]
    rows += [(prop, i, char, value) for i, ((char, prop), value) in enumerate(state.properties.items(), 1)]
    return spark.createDataFrame([(name, provider, *row) for row in rows], DEFINITION)


def provider_of(name: str, cubes: Mapping[str, Cube], definitions: DataFrame | None = None) -> str:
    """The cube that a name stands for: itself, or the provider of the saved query."""
    return name if name in cubes else _rows(name, cubes, definitions)[0]["provider"]


def _rows(name: str, cubes: Mapping[str, Cube], definitions: DataFrame | None) -> list:
    rows = [] if definitions is None else definitions.where(F.col("query") == name).orderBy("position").limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"the definition of {name!r} has more than {MAX_ROWS} rows")
    if not rows:
        known = list(cubes)
        if definitions is not None:
            known += [r[0] for r in definitions.select("query").distinct().orderBy("query").limit(NAMES_SHOWN).collect()]
        raise ValueError(f"unknown cube or query {name!r}, expected one of {', '.join(known[:NAMES_SHOWN])}")
    providers = {r["provider"] for r in rows}
    if len(providers) > 1 or not providers <= set(cubes):
        raise ValueError(f"query {name!r} needs one known cube, not {', '.join(sorted(map(str, providers)))}")
    return rows


def begin(
    name: str,
    cubes: Mapping[str, Cube],
    definitions: DataFrame | None = None,
    variables: Sequence[Mapping[str, str]] = (),
    hierarchy_variables: Sequence[Mapping[str, str]] = (),
    variant: str | None = None,
    variants: DataFrame | None = None,
) -> Cube:
    """Open a cube, or a saved query over one, by its technical name and fill its variables.

    ``definitions`` has the columns of ``DEFINITION``. Only the rows of the query that is opened are read, and only metadata: the facts are read by an action.
    An unknown name is an error that lists known ones, as is a definition of an unknown part. Where ``variants`` has a column ``QUERY``, only the variants of this query count.
    """
    state = cubes[name] if name in cubes else _compiled(cubes, _rows(name, cubes, definitions), name)
    if variants is not None and "QUERY" in variants.columns:
        variants = variants.where(F.col("QUERY") == name).drop("QUERY")
    return state.begin(variables, hierarchy_variables, variant, variants)


def _compiled(cubes: Mapping[str, Cube], rows: list, name: str) -> Cube:
    state = cubes[rows[0]["provider"]]
    unknown = {r["part"] for r in rows} - {HEAD, MEASURE, ROWS, COLUMNS, FILTER, *PROPERTIES}
    if unknown:
        raise ValueError(f"query {name!r} has unknown parts: {', '.join(sorted(unknown))}")
    of = lambda part: [r for r in rows if r["part"] == part]
    chosen = [r["name"] for r in of(MEASURE)]
    if chosen:
        measures = dict(zip(measure_names(state.measures), state.measures, strict=True))
        missing = [m for m in chosen if m not in measures]
        if missing:
            raise ValueError(f"query {name!r} needs unknown measures: {', '.join(missing)}")
        state = replace(state, measures=tuple(measures[m] for m in chosen))
    state = state.rows(*(r["name"] for r in of(ROWS)), op="SET")
    axis = tuple(dict.fromkeys(r["name"] for r in of(COLUMNS)))
    members = {c: [r["value"] for r in of(COLUMNS) if r["name"] == c and r["value"] is not None] for c in axis}
    state = state.columns(*axis, op="SET", members={c: m for c, m in members.items() if m})
    for char in dict.fromkeys(r["name"] for r in of(FILTER)):
        held = [r["value"] for r in of(FILTER) if r["name"] == char and r["value"] is not None]
        state = state.filter(char, *held, op="SET") if held else replace(state, members={**state.members, char: ()})
    for prop in PROPERTIES:
        for r in of(prop):
            state = state.set_property(r["name"], prop, r["value"])
    return state
