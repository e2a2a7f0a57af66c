"""The dictionary type system: names, Spark types and cell widths."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

# Dictionary type names, grouped by the way their cells are read.
CHAR_TYPES = ("CHAR", "CLNT", "CUKY", "LANG", "UNIT")
DIGIT_TYPES = ("NUMC", "ACCP")
STRING_TYPES = ("STRING", "STRG", "SSTR", "LCHR")
INTEGER_TYPES = {"INT1": T.ShortType(), "INT2": T.ShortType(), "PREC": T.ShortType(), "INT4": T.LongType(), "INT8": T.LongType()}
FLOAT_TYPES = ("FLTP",)
PACKED_TYPES = ("DEC", "CURR", "QUAN")
DECFLOAT16_TYPES = ("D16D", "D16N", "D16R", "D16S", "DECF16")
DECFLOAT34_TYPES = ("D34D", "D34N", "D34R", "D34S", "DECF34")
DATE_TYPES = ("DATS",)
TIME_TYPES = ("TIMS",)
UTC_TYPES = ("UTCLONG", "UTCL", "UTCS", "UTCM")
RAW_TYPES = ("RAW", "LRAW", "RAWSTRING", "RSTR")
DURATION_TYPES = ("DTDAY", "DTWEEK", "DTMONTH", "TSECOND", "TMINUTE", "CDAY")
OPAQUE_TYPES = ("XMLDATA", "ABAPOBJECT")
STRUCTURAL_TYPES = ("NODE",)

DECIMAL_TYPES = PACKED_TYPES + DECFLOAT16_TYPES + DECFLOAT34_TYPES
TEXT_TYPES = CHAR_TYPES + DIGIT_TYPES + STRING_TYPES
ALL_TYPES = (
    *TEXT_TYPES, *INTEGER_TYPES, *FLOAT_TYPES, *DECIMAL_TYPES, *DATE_TYPES, *TIME_TYPES,
    *UTC_TYPES, *RAW_TYPES, *DURATION_TYPES, *OPAQUE_TYPES,
)

# Characters a cell of the type needs when its length does not come from the dictionary.
CELL_WIDTHS = {
    "INT1": 4, "INT2": 6, "PREC": 6, "INT4": 20, "INT8": 20, "FLTP": 24, "DATS": 8, "TIMS": 6,
    "UTCLONG": 22, "UTCL": 22, "UTCS": 14, "UTCM": 12, "DTDAY": 11, "DTWEEK": 11, "DTMONTH": 11,
    "TSECOND": 11, "TMINUTE": 11, "CDAY": 11,
}


class UnknownTypeError(ValueError):
    """A dictionary type name outside the type map."""


@dataclass(frozen=True)
class Field:
    """One dictionary row describing one column of a table."""

    name: str
    type: str
    length: int = 0
    decimals: int = 0
    key: bool = False
    text: str = ""
    check_table: str = ""
    ref_table: str = ""
    ref_field: str = ""

    @property
    def is_data(self) -> bool:
        return self.type not in STRUCTURAL_TYPES


def data_fields(fields: Iterable[Field]) -> list[Field]:
    """The fields that hold cells; structural rows have none."""
    return [f for f in fields if f.is_data]


def decimal_type(field: Field) -> T.DecimalType:
    if field.type in DECFLOAT16_TYPES:
        precision = 16
    elif field.type in DECFLOAT34_TYPES:
        precision = 34
    else:
        precision = max(1, min(field.length, 38))
    return T.DecimalType(precision, min(field.decimals, precision))


def spark_type(field: Field, strict: bool = True) -> T.DataType:
    """Spark type of a column; an unknown name raises, or reads as text when not strict."""
    name = field.type
    if name in INTEGER_TYPES:
        return INTEGER_TYPES[name]
    if name in FLOAT_TYPES:
        return T.DoubleType()
    if name in DECIMAL_TYPES:
        return decimal_type(field)
    if name in DATE_TYPES:
        return T.DateType()
    if name in UTC_TYPES:
        return T.TimestampNTZType()
    if name in RAW_TYPES:
        return T.BinaryType()
    if name in DURATION_TYPES:
        return T.IntegerType()
    if name in TEXT_TYPES + TIME_TYPES + OPAQUE_TYPES or not strict:
        return T.StringType()
    raise UnknownTypeError(f"dictionary type {name!r} of field {field.name!r} is not known")


def schema_of(fields: Iterable[Field], strict: bool = True) -> T.StructType:
    """Typed schema of a dictionary table."""
    return T.StructType([T.StructField(f.name, spark_type(f, strict)) for f in data_fields(fields)])


def cell_width(field: Field) -> int:
    """Characters one cell takes in a fixed-width line."""
    name = field.type
    if name in CELL_WIDTHS:
        return CELL_WIDTHS[name]
    if name in DECIMAL_TYPES:
        kind = decimal_type(field)
        return kind.precision + 1 + (1 if kind.scale else 0)
    if name in RAW_TYPES:
        return 2 * field.length
    return field.length
