"""Rows as JSON documents, plain or with the type of every value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL names of the wrapped types and the keys of the wrapper.
TYPE_NAMES = {
    T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN",
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.BinaryType: "BLOB",
    T.StructType: "STRUCT",
    T.ArrayType: "LIST",
}
TYPE_KEY, VALUE_KEY = "$type", "$value"
KEEP_NULLS = {"ignoreNullFields": "false"}

_AS_TEXT = (T.DateType, T.TimestampNTZType, T.TimestampType, T.DecimalType)


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if type(kind) not in TYPE_NAMES:
        raise ValueError(f"{kind.simpleString()} has no JSON form")
    return TYPE_NAMES[type(kind)]


def _plain(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        body = F.struct(*[_plain(column.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(column.isNotNull(), body)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _plain(item, kind.elementType))
    return column.cast("string") if isinstance(kind, _AS_TEXT) else column


def _wrapped(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        body = F.struct(*[_wrapped(column.getField(f.name), f.dataType).alias(f.name) for f in kind])
        value = F.when(column.isNotNull(), body)
    elif isinstance(kind, T.ArrayType):
        value = F.transform(column, lambda item: _wrapped(item, kind.elementType))
    else:
        value = _plain(column, kind)
    return F.struct(F.lit(type_name(kind)).alias(TYPE_KEY), value.alias(VALUE_KEY))


def _wrapped_type(kind: T.DataType) -> T.StructType:
    if isinstance(kind, T.StructType):
        value: T.DataType = T.StructType([T.StructField(f.name, _wrapped_type(f.dataType)) for f in kind])
    elif isinstance(kind, T.ArrayType):
        value = T.ArrayType(_wrapped_type(kind.elementType))
    else:
        value = T.StringType() if isinstance(kind, _AS_TEXT) else kind
    return T.StructType([T.StructField(TYPE_KEY, T.StringType()), T.StructField(VALUE_KEY, value)])


def _unwrapped(column: Column, kind: T.DataType) -> Column:
    value = column.getField(VALUE_KEY)
    if isinstance(kind, T.StructType):
        body = F.struct(*[_unwrapped(value.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(value.isNotNull(), body)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _unwrapped(item, kind.elementType))
    return value.cast(kind) if isinstance(kind, _AS_TEXT) else value


def value_to_json(column: Column, kind: T.DataType, typed: bool = False) -> Column:
    """One nested value as a JSON document. Bytes are base64, dates and decimals are text."""
    return F.to_json(_wrapped(column, kind) if typed else _plain(column, kind), KEEP_NULLS)


def rows_to_json(df: DataFrame, typed: bool = False, name: str = "json", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as one JSON document; ``keep`` columns stay beside it."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(*keep, value_to_json(row, df.schema, typed).alias(name))


def rows_from_json(df: DataFrame, schema: T.StructType, name: str = "json") -> DataFrame:
    """Typed documents back to rows of ``schema``."""
    parsed = df.select(F.from_json(name, _wrapped_type(schema)).alias("_row"))
    body = F.col("_row").getField(VALUE_KEY)
    return parsed.select(*[_unwrapped(body.getField(f.name), f.dataType).alias(f.name) for f in schema])
