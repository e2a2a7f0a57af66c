"""The data dictionary: table entries, field rows, and searches over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as D
from ..functions.globs import matches
from ..functions.types import Field

# Classes a table search lists, the language of its texts, result columns.
TABLE_CLASSES = ("VIEW", "TRANSP", "POOL", "CLUSTER")
TEXT_LANGUAGE = "E"
FIELD_COLUMNS = ("pos", "is_key", "field", "text", "sap_type", "length", "decimals", "check_table", "ref_table", "ref_field", "language")

FIELD_ROW = "table_name string, pos int, is_key string, field string, text string, sap_type string, length int, decimals int, check_table string, ref_table string, ref_field string, language string"
MAX_FIELDS = 10_000


def fields_from_schema(schema: T.StructType, keys: Sequence[str] = (), lengths: Mapping[str, int] | None = None, money: int = 2) -> list[Field]:
    """Dictionary fields of a DataFrame schema, for sources that bring no dictionary."""
    lengths = lengths or {}
    out = []
    for column in schema:
        name, kind = column.name, column.dataType
        key = name in keys
        if isinstance(kind, T.LongType):
            field = Field(name, "NUMC", lengths.get(name, 10), key=key) if key else Field(name, "INT8", 8)
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            field = Field(name, "INT4", 4, key=key)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            field = Field(name, "DEC", lengths.get(name, 15), money, key=key)
        elif isinstance(kind, T.DecimalType):
            field = Field(name, "DEC", kind.precision, kind.scale, key=key)
        elif isinstance(kind, T.DateType):
            field = Field(name, "DATS", 8, key=key)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            field = Field(name, "UTCL", 27, 7, key=key)
        elif isinstance(kind, T.BinaryType):
            field = Field(name, "RAWSTRING", 0, key=key)
        elif name in lengths:
            field = Field(name, "CHAR", lengths[name], key=key)
        else:
            field = Field(name, "STRING", 0, key=key)
        out.append(field)
    return out


def field_rows(table: str, fields: Iterable[Field], language: str = TEXT_LANGUAGE) -> list[tuple]:
    return [
        (table, pos, "X" if f.key else "", f.name, f.text, f.type, f.length, f.decimals, f.check_table, f.ref_table, f.ref_field, language)
        for pos, f in enumerate(fields, 1)
    ]


def fields_frame(spark: SparkSession, tables: Mapping[str, Iterable[Field]]) -> DataFrame:
    rows = [row for table, fields in tables.items() for row in field_rows(table, fields)]
    return spark.createDataFrame(rows, FIELD_ROW)


def load_fields(fields: DataFrame, table: str, language: str = TEXT_LANGUAGE) -> list[Field]:
    """Field rows of one table, as plan-time metadata. The row count is bounded and checked."""
    rows = (
        fields.where((F.col("table_name") == table) & (F.col("language") == language)).orderBy("pos").limit(MAX_FIELDS + 1).collect()
    )
    if not rows:
        raise ValueError(f"table {table!r} is not in the dictionary")
    return _fields_of(rows)


def _fields_of(rows) -> list[Field]:
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields")
    return [
        Field(r["field"], r["sap_type"], r["length"], r["decimals"], r["is_key"] == "X", r["text"], r["check_table"], r["ref_table"], r["ref_field"])
        for r in rows
    ]


def as_fields(fields: DataFrame | Sequence[Field]) -> list[Field]:
    """Fields of one table, given as field rows or as a ready list."""
    if isinstance(fields, DataFrame):
        return _fields_of(fields.orderBy("pos").limit(MAX_FIELDS + 1).collect())
    return list(fields)


def show_tables(tables: DataFrame, tablename: str = "%", text: str = "%") -> DataFrame:
    """Search table entries (``table_name, text, class, language``) by name and text pattern."""
    return tables.where(
        (F.col("language") == TEXT_LANGUAGE)
        & F.col("class").isin(*TABLE_CLASSES)
        & matches("table_name", tablename)
        & matches("text", text)
    ).select("table_name", "text", "class")


def describe_fields(fields: DataFrame, table: str | None = None, language: str = TEXT_LANGUAGE) -> DataFrame:
    """Field rows of a table (of all tables when none is named) with the SQL type of each."""
    rows = fields.where(F.col("language") == language)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    return rows.select("table_name", *FIELD_COLUMNS, declared_type().alias("declared_type"))




def declared_type() -> Column:
    """SQL declaration of a field row's type, from ``sap_type``, ``length`` and ``decimals``."""
    kind, length, scale = F.col("sap_type"), F.col("length"), F.col("decimals")

    def decimal(precision: Column) -> Column:
        return F.format_string("DECIMAL(%d,%d)", precision, F.least(scale, precision))

    out = F.when(kind.isin(*D.DATE_TYPES), F.lit("DATE"))
    for name, spark in D.INTEGER_TYPES.items():
        out = out.when(kind == name, F.lit(spark.simpleString().upper()))
    return (
        out.when(kind.isin(*D.FLOAT_TYPES), F.lit("DOUBLE"))
        .when(kind.isin(*D.PACKED_TYPES), decimal(F.greatest(F.lit(1), F.least(length, F.lit(38)))))
        .when(kind.isin(*D.DECFLOAT16_TYPES), decimal(F.lit(16)))
        .when(kind.isin(*D.DECFLOAT34_TYPES), decimal(F.lit(34)))
        .when(kind.isin(*D.UTC_TYPES), F.lit("TIMESTAMP_NTZ"))
        .when(kind.isin(*D.RAW_TYPES), F.lit("BINARY"))
        .when(kind.isin(*D.DURATION_TYPES), F.lit("INT"))
        .when(kind.isin(*D.TEXT_TYPES, *D.TIME_TYPES, *D.OPAQUE_TYPES), F.lit("STRING"))
    )
