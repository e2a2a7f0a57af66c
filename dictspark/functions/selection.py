"""Select-options: rows of (field, sign, operator, low, high) compiled to one predicate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .globs import ESCAPE

# Signs and operators of a select-option row.
SIGNS = ("I", "E")
OPERATORS = ("EQ", "NE", "GT", "LT", "GE", "LE", "BT", "NB", "CP", "NP")


def option(field: str, low: str = "", high: str = "", sign: str = "", op: str = "") -> dict[str, str]:
    return {"FIELDNAME": field, "SIGN": sign, "OP": op, "LOW": low, "HIGH": high}


def normalized(row: Mapping[str, str]) -> tuple[str, str, str, str, str]:
    """(field, sign, op, low, high) with the defaults filled in."""
    name = row.get("FIELDNAME") or row.get("NAME")
    if not name:
        raise ValueError(f"selection without a field name: {dict(row)}")
    low, high = row.get("LOW") or "", row.get("HIGH") or ""
    sign = (row.get("SIGN") or "I").upper()
    op = (row.get("OP") or ("BT" if high else "EQ")).upper()
    if sign not in SIGNS:
        raise ValueError(f"sign {sign!r} of {name!r} is not one of {SIGNS}")
    if op not in OPERATORS:
        raise ValueError(f"operator {op!r} of {name!r} is not one of {OPERATORS}")
    return name, sign, op, low, high


def option_pattern(pattern: str) -> str:
    """LIKE pattern of a select-option pattern: ``*`` any run, ``+`` one character, ``#`` escapes."""
    out, escaped = [], False
    for ch in pattern:
        if not escaped and ch == "#":
            escaped = True
            continue
        wild = {"*": "%", "+": "_"}.get(ch) if not escaped else None
        out.append(wild or (ESCAPE + ch if ch in "%_" + ESCAPE else ch))
        escaped = False
    return "".join(out)


def _typed(value: str, kind: T.DataType) -> Column:
    """Literals take the column's type, so the comparison stays typed and can be pushed down."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) and len(value) == 8 and value.isdigit():
        value = f"{value[:4]}-{value[4:6]}-{value[6:]}"
    return F.lit(value).cast(kind)


def _one(column: Column, kind: T.DataType, op: str, low: str, high: str) -> Column:
    if op in ("CP", "NP"):
        like = column.cast("string").like(option_pattern(low))
        return like if op == "CP" else ~like
    lower = _typed(low, kind)
    if op in ("BT", "NB"):
        between = column.between(lower, _typed(high, kind))
        return between if op == "BT" else ~between
    return {
        "EQ": column == lower,
        "NE": column != lower,
        "GT": column > lower,
        "LT": column < lower,
        "GE": column >= lower,
        "LE": column <= lower,
    }[op]


def predicate(schema: T.StructType, options: Iterable[Mapping[str, str]], combine: str = "all") -> Column:
    """One predicate for a list of options.

    Per field the includes are ORed and the excludes subtracted. Fields are ANDed, or ORed with
    ``combine="any"``. Equal includes of a field become one IN list.
    """
    if combine not in ("all", "any"):
        raise ValueError("combine must be 'all' or 'any'")
    by_field: dict[str, list[tuple[str, str, str, str]]] = {}
    for row in options:
        name, *rest = normalized(row)
        by_field.setdefault(name, []).append(tuple(rest))
    parts = []
    for name, rows in by_field.items():
        if name not in schema.names:
            raise ValueError(f"unknown field {name!r}; the table has {', '.join(schema.names)}")
        parts.append(_field_predicate(F.col(name), schema[name].dataType, rows))
    if not parts:
        return F.lit(True)
    return reduce((lambda a, b: a & b) if combine == "all" else (lambda a, b: a | b), parts)


def _field_predicate(column: Column, kind: T.DataType, rows: Sequence[tuple[str, str, str, str]]) -> Column:
    equal = [_typed(low, kind) for sign, op, low, _ in rows if sign == "I" and op == "EQ"]
    includes = [_one(column, kind, op, low, high) for sign, op, low, high in rows if sign == "I" and op != "EQ"]
    if equal:
        includes.insert(0, column.isin(*equal))
    excludes = [_one(column, kind, op, low, high) for sign, op, low, high in rows if sign == "E"]
    out = reduce(lambda a, b: a | b, includes) if includes else F.lit(True)
    for excluded in excludes:
        # a row whose field is NULL matches no option, so an exclude leaves it in
        out = out & ~F.coalesce(excluded, F.lit(False))
    return out


def select_options(df: DataFrame, options: Iterable[Mapping[str, str]], combine: str = "all") -> DataFrame:
    return df.where(predicate(df.schema, options, combine))
