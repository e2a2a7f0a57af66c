"""Shaping columns into the typed argument structs of a batch of calls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameter directions.
IMPORT, EXPORT, CHANGING, TABLES = "import", "export", "changing", "tables"
MAX_PARAMETERS = 1000


@dataclass(frozen=True)
class Parameter:
    name: str
    type: T.DataType
    direction: str = IMPORT

    @property
    def settable(self) -> bool:
        return self.direction != EXPORT


def load_signature(signature: DataFrame) -> list[Parameter]:
    """Parameters from rows of (pos, name, type, direction), as bounded plan-time metadata."""
    rows = signature.orderBy("pos").limit(MAX_PARAMETERS + 1).collect()
    if len(rows) > MAX_PARAMETERS:
        raise ValueError(f"more than {MAX_PARAMETERS} parameters")
    return [Parameter(r["name"], T.DataType.fromDDL(r["type"]), r["direction"]) for r in rows]


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType,)):
        return "number"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return kind.typeName()


def _compatible(given: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(given, T.NullType):
        return True
    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        return all(f.name in wanted.names and _compatible(f.dataType, wanted[f.name].dataType) for f in given)
    if isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        return _compatible(given.elementType, wanted.elementType)
    return _family(given) == _family(wanted)


def _assign(df: DataFrame, assigned: Mapping[str, str], signature: Sequence[Parameter], strict: bool) -> DataFrame:
    values: list[Column] = []
    bad: list[Column] = []
    for parameter in signature:
        if not parameter.settable:
            continue
        if parameter.name not in assigned:
            values.append(F.lit(None).cast(parameter.type).alias(parameter.name))
            continue
        source = assigned[parameter.name]
        given = df.schema[source].dataType
        if strict and not _compatible(given, parameter.type):
            raise ValueError(f"parameter {parameter.name!r} is {parameter.type.simpleString()}, the value is {given.simpleString()}")
        value = F.col(source).try_cast(parameter.type)
        bad.append(F.when(F.col(source).isNotNull() & value.isNull(), F.lit(parameter.name)))
        values.append(value.alias(parameter.name))
    invalid = F.concat_ws(",", *bad) if bad else F.lit("")
    if strict:
        failed = F.raise_error(F.concat(F.lit("values do not fit: "), invalid)).cast("string")
        invalid = F.when(invalid != "", failed).otherwise(invalid)
    return df.select("*", F.struct(*values).alias("arguments"), invalid.alias("invalid"))


def shape_arguments(
    df: DataFrame,
    signature: DataFrame | Sequence[Parameter],
    mode: str = "named",
    columns: Sequence[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Add ``arguments`` (one struct of all settable parameters) and ``invalid`` (names that do not fit).

    Named columns must be parameters that can be set. Positional columns fill import, changing
    and table parameters in declaration order. A NULL, like an absent value, leaves a parameter
    at its initial value. Strict mode raises on a mismatch; lenient mode reports it per row.
    """
    signature = load_signature(signature) if isinstance(signature, DataFrame) else list(signature)
    columns = list(columns if columns is not None else df.columns)
    by_name = {p.name: p for p in signature}
    if mode == "named":
        for name in columns:
            if name not in by_name:
                raise ValueError(f"unknown parameter {name!r}, expected one of {', '.join(by_name)}")
            if not by_name[name].settable:
                raise ValueError(f"export parameter {name!r} cannot be set")
        assigned = {name: name for name in columns}
    elif mode == "positional":
        settable = [p.name for p in signature if p.settable]
        if len(columns) > len(settable):
            raise ValueError(f"too many arguments: {len(columns)} given, {len(settable)} can be set")
        assigned = dict(zip(settable, columns))
    else:
        raise ValueError("mode must be 'named' or 'positional'")
    return _assign(df, assigned, signature, strict)
