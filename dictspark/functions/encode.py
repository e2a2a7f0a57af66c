"""Typed value → text cell, as SQL text: the inverse of :mod:`decode`. NULL becomes the initial value."""

from __future__ import annotations

from . import types as D
from .sqltext import padding
from .types import Field

# Initial values of the types whose blank is not spaces.
INITIAL_DATE = "00000000"
INITIAL_TIME = "000000"
INITIAL_STAMP = "00000000000000"


def _number_text(value: str, field: Field) -> str:
    return f"CAST(CAST(coalesce({value}, 0) AS {D.spark_type(field).simpleString()}) AS STRING)"


def _packed(value: str, field: Field) -> str:
    """Right aligned, sign behind the digits, as packed numbers are printed."""
    digits = _number_text(value, field)
    # digits begin with a minus or a figure, and comparing texts takes less than looking for a beginning
    return f"lpad(if({digits} < '0', concat(substring({digits}, 2), '-'), concat({digits}, ' ')), {D.cell_width(field)}, {padding(' ', D.cell_width(field))})"


def _stamp(value: str, field: Field) -> str:
    iso = f"CAST(CAST({value} AS TIMESTAMP_NTZ) AS STRING)"
    digits = f"translate(substring({iso}, 1, 19), '-: ', '')"
    if field.type == "UTCS":
        return f"coalesce({digits}, '{INITIAL_STAMP}')"
    if field.type == "UTCM":
        return f"substring(coalesce({digits}, '{INITIAL_STAMP}'), 1, 12)"
    return f"coalesce(concat({digits}, ',', rpad(substring({iso}, 21, 6), 7, '0')), '{INITIAL_STAMP},0000000')"


def flag_text(flag: str) -> str:
    return f"if({flag}, 'X', '')"


def encode_cell(value: str, field: Field) -> str:
    """Text of one cell, unpadded for character types; the layout pads fixed-width lines."""
    name = field.type
    if name in D.DIGIT_TYPES:
        return f"lpad(coalesce(CAST({value} AS STRING), ''), {field.length}, {padding('0', field.length)})"
    if name in D.DATE_TYPES:
        return f"coalesce(replace(CAST(CAST({value} AS DATE) AS STRING), '-', ''), '{INITIAL_DATE}')"
    if name in D.TIME_TYPES:
        return f"coalesce(replace(CAST({value} AS STRING), ':', ''), '{INITIAL_TIME}')"
    if name in D.UTC_TYPES:
        return _stamp(value, field)
    if name in D.RAW_TYPES:
        digits = f"coalesce(hex({value}), '')"
        return f"rpad({digits}, {2 * field.length}, {padding('0', 2 * field.length)})" if field.length else digits
    if name in D.DECIMAL_TYPES:
        return _packed(value, field)
    if name in D.FLOAT_TYPES or name in D.INTEGER_TYPES or name in D.DURATION_TYPES:
        return f"lpad({_number_text(value, field)}, {D.cell_width(field)}, {padding(' ', D.cell_width(field))})"
    return f"coalesce(CAST({value} AS STRING), '')"
