"""Selecting a part of a nested result by path, and flattening nested lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import child, tokens

VALUE = "_value"


def select_path(df: DataFrame, path: str = "") -> DataFrame:
    """The rows a path names.

    The first token is a column, later ones descend. A struct gives one row, a list one row per
    element, a scalar one column named after the leaf. Nothing to show gives ``ok = true``.
    """
    names = tokens(path)
    if not names:
        return df if df.columns else df.select(F.lit(True).alias("ok"))
    kind: T.DataType = child(df.schema, names[0], " among the columns").dataType
    out = df.select(F.col(f"`{names[0]}`").alias(VALUE))
    for name in names[1:]:
        if isinstance(kind, T.ArrayType):
            out, kind = out.select(F.explode(VALUE).alias(VALUE)), kind.elementType
        if not isinstance(kind, T.StructType):
            raise ValueError(f"cannot descend into {kind.simpleString()} with {name!r}")
        kind = child(kind, name).dataType
        out = out.select(F.col(VALUE).getField(name).alias(VALUE))
    if isinstance(kind, T.ArrayType):
        out, kind = out.select(F.explode(VALUE).alias(VALUE)), kind.elementType
    if not isinstance(kind, T.StructType):
        return out.select(F.col(VALUE).alias(names[-1]))
    if not kind.names:
        return out.select(F.lit(True).alias("ok"))
    return out.select(f"{VALUE}.*")


def _flat_name(name: str, taken: set[str]) -> str:
    """The leaf's own name, numbered when an earlier leaf has it."""
    out, n = name, 1
    while out in taken:
        out, n = f"{name}_{n}", n + 1
    taken.add(out)
    return out


def unnest_recursive(df: DataFrame, column: str) -> DataFrame:
    """A nested column to flat columns: lists become rows, structs become columns, at any depth.

    The other columns stay. Lists inside one another multiply rows; several lists beside each
    other in one struct would pair every element with every other, and are refused.
    """
    while True:
        kind = df.schema[column].dataType if column in df.columns else None
        if isinstance(kind, T.ArrayType):
            df = df.select(*[F.explode(c).alias(c) if c == column else F.col(c) for c in df.columns])
            continue
        nested = [f for f in df.schema if isinstance(f.dataType, T.StructType)]
        if not nested:
            lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
            if not lists:
                return df
            if len(lists) > 1:
                raise ValueError(f"lists side by side cannot be unnested together: {', '.join(lists)}")
            column = lists[0]
            continue
        taken: set[str] = set()
        columns = []
        for field in df.schema:
            if isinstance(field.dataType, T.StructType):
                columns += [F.col(field.name).getField(n).alias(_flat_name(n, taken)) for n in field.dataType.names]
            else:
                columns.append(F.col(field.name).alias(_flat_name(field.name, taken)))
        df = df.select(*columns)
