"""Text cell → typed value, one SQL expression per dictionary type.

Every function takes the cell as SQL text (a quoted column name, or any expression) and returns
SQL text. A cell that is blank or holds the type's initial value decodes to NULL (to an empty
string for character types). An undecodable cell is NULL in lenient mode, an error in strict mode.
"""

from __future__ import annotations

from . import types as D
from .sqltext import failure, text
from .types import Field

# Shapes of date, time and timestamp cells.
DATE_SHAPE = "^[0-9]{8}"
TIME_SHAPE = "^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]"
ZEROS = "^0+([,.]0*)?$"


def before_nul(cell: str) -> str:
    """Text after a NUL is noise. Few cells have one, and looking for it takes less than cutting there."""
    return rf"if(contains({cell}, '\0'), substring_index({cell}, '\0', 1), {cell})"


def text_cell(cell: str) -> str:
    return f"rtrim({cell})"


def packed_cell(cell: str, kind: str) -> str:
    """Numbers; a trailing minus belongs in front.

    A blank cell does not reach a cast to decimal or double, where parsing it costs an exception. Both branches begin
    with the digits, so Catalyst computes them once a cell.
    """
    return packed_value(packed_digits(cell), kind)


def packed_digits(cell: str) -> str:
    return f"trim({before_nul(cell)})"


def packed_value(digits: str, kind: str) -> str:
    plain = f"if({digits} = '', NULL, {digits})" if kind.startswith(("decimal", "double")) else digits
    return f"try_cast(if(endswith({digits}, '-'), concat('-', rtrim(trim(TRAILING '-' FROM {digits}))), {plain}) AS {kind})"


def _day(digits: str) -> str:
    return f"concat_ws('-', substring({digits}, 1, 4), substring({digits}, 5, 2), substring({digits}, 7, 2))"


def date_cell(cell: str) -> str:
    digits = f"trim({cell})"
    return f"if({digits} RLIKE '{DATE_SHAPE}', try_cast({_day(digits)} AS DATE), NULL)"


def time_cell(cell: str, initial_is_null: bool = True) -> str:
    digits = f"trim({cell})"
    clock = f"concat_ws(':', substring({digits}, 1, 2), substring({digits}, 3, 2), substring({digits}, 5, 2))"
    valid = f"{digits} RLIKE '{TIME_SHAPE}'"
    if initial_is_null:
        valid += f" AND NOT {digits} RLIKE '{ZEROS}'"
    return f"if({valid}, {clock}, NULL)"


def utc_cell(cell: str) -> str:
    """``YYYYMMDD[HH[MM[SS[,fffffff]]]]``; digits past microseconds are cut."""
    digits = f"rtrim({before_nul(cell)})"
    clock = ", ".join(f"if(length({digits}) > {at}, substring({digits}, {at}, 2), '00')" for at in (9, 11, 13))
    fraction = f"rpad(translate(substring({digits}, 15, 8), ',.', ''), 6, '0')"
    iso = f"concat({_day(digits)}, ' ', concat_ws(':', {clock}), '.', {fraction})"
    return f"if({digits} RLIKE '{DATE_SHAPE}' AND NOT {digits} RLIKE '{ZEROS}', try_cast({iso} AS TIMESTAMP_NTZ), NULL)"


def raw_cell(cell: str) -> str:
    digits = f"rtrim({cell})"
    return f"if(length({digits}) > 0 AND length({digits}) % 2 = 0, unhex({digits}), NULL)"


def flag_cell(cell: str) -> str:
    """``X`` is true, blank is false, anything else is NULL."""
    return f"CASE rtrim({cell}) WHEN 'X' THEN true WHEN '' THEN false END"


def is_initial(cell: str, field: Field) -> str:
    """Whether a cell is blank or the initial value of its type: NULL without being an error."""
    blank = f"trim({before_nul(cell)}) = ''"
    if field.type in D.DATE_TYPES + D.TIME_TYPES + D.UTC_TYPES:
        return f"({blank} OR trim({cell}) RLIKE '{ZEROS}')"
    return f"({blank})"


def decode_cell(cell: str, field: Field, strict: bool = False, initial_time_is_null: bool = True) -> str:
    """Decode one text cell by its dictionary field."""
    name = field.type
    if name in D.OPAQUE_TYPES:
        return "''"
    if name in D.STRING_TYPES:
        return cell
    if name in D.TEXT_TYPES:
        return text_cell(cell)
    if name in D.DATE_TYPES:
        value = date_cell(cell)
    elif name in D.TIME_TYPES:
        value = time_cell(cell, initial_time_is_null)
    elif name in D.UTC_TYPES:
        value = utc_cell(cell)
    elif name in D.RAW_TYPES:
        value = raw_cell(cell)
    elif name in D.ALL_TYPES:
        value = packed_cell(cell, D.spark_type(field).simpleString())
    elif strict:
        raise D.UnknownTypeError(f"dictionary type {name!r} of field {field.name!r} is not known")
    else:
        return text_cell(cell)
    if strict:
        message = f"concat({text(f'field {field.name} ({name}) cannot hold: ')}, {cell})"
        failed = f"{cell} IS NOT NULL AND {value} IS NULL AND NOT {is_initial(cell, field)}"
        value = f"if({failed}, {failure(message, D.spark_type(field).simpleString())}, {value})"
    return value


def decode_alike(cells: str, field: Field, initial_time_is_null: bool = True) -> str:
    """Decode an array of text cells (SQL text) that share the type of ``field``, leniently: an array of their values.

    Code generated for hundreds of columns outgrows the caches of a core and runs several times slower a cell than that of a few. A function over
    an array is the same code for each of its cells.
    """
    name = field.type
    if name in D.STRING_TYPES:
        return cells
    if name in D.ALL_TYPES and name not in D.OPAQUE_TYPES + D.TEXT_TYPES + D.DATE_TYPES + D.TIME_TYPES + D.UTC_TYPES + D.RAW_TYPES:
        # a function has no common subexpressions, so the digits are a step of their own
        return f"transform(transform({cells}, c -> {packed_digits('c')}), c -> {packed_value('c', D.spark_type(field).simpleString())})"
    return f"transform({cells}, c -> {decode_cell('c', field, False, initial_time_is_null)})"
