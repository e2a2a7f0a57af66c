"""Line layouts of text extracts: how one row becomes one line and back."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.sqltext import failure, text
from ..functions.types import Field, cell_width

# Row sizes of the bucketed layouts, and the widest plain row.
BUCKETS = (128, 512, 2048, 8192, 30000)
PLAIN_ROW = 512
DEFAULT_DELIMITER = "~"

CHUNK = 20

#: How an escaped cell writes what would end it or its line. The sign itself comes last when reading: until then each one begins a pair.
ESCAPE = "\\"
ESCAPES = (("\n", "n"), ("\r", "r"), (None, "d"), (ESCAPE, "s"))


@dataclass(frozen=True)
class Layout:
    name: str
    delimited: bool = False
    bucketed: bool = False
    max_width: int | None = None


# The closed set of layouts.
LAYOUTS = {
    layout.name: layout
    for layout in (
        Layout("fixed", max_width=PLAIN_ROW),
        Layout("fixed_wide", bucketed=True, max_width=BUCKETS[-1]),
        Layout("delimited", delimited=True),
        Layout("delimited_wide", delimited=True, bucketed=True),
        Layout("long_string", delimited=True),
    )
}


def layout_named(name: str) -> Layout:
    if name not in LAYOUTS:
        raise ValueError(f"unsupported layout {name!r}, expected one of {', '.join(LAYOUTS)}")
    return LAYOUTS[name]


def row_width(fields: Sequence[Field]) -> int:
    return sum(cell_width(f) for f in fields)


def bucket_for(width: Column) -> Column:
    """Smallest bucket that holds a row of ``width`` characters; NULL when none does."""
    size = F.lit(None).cast("int")
    for bucket in reversed(BUCKETS):
        size = F.when(width <= bucket, F.lit(bucket)).otherwise(size)
    return size


def chunk_line(fields: Sequence[Field], line: str) -> tuple[list[str], list[str]]:
    """SQL text that cuts a fixed-width line in two steps: pieces of the line, cells of the pieces.

    Finding a character position means reading the line up to it. Cutting pieces of
    :data:`CHUNK` cells first keeps that short for the later cells of a wide line.
    """
    pieces, cells, start = [], [], 1
    for at in range(0, len(fields), CHUNK):
        widths = [cell_width(f) for f in fields[at : at + CHUNK]]
        piece = f"_piece_{len(pieces)}"
        pieces.append(f"substring({line}, {start}, {sum(widths)}) AS {piece}")
        cells += [f"substring({piece}, {first}, {width})" for first, width in zip(accumulate(widths, initial=1), widths)]
        start += sum(widths)
    return pieces, cells


def split_pattern(delimiter: str) -> str:
    return re.escape(delimiter)


def join_cells(cells: Sequence[str], fields: Sequence[Field], layout: Layout, delimiter: str = DEFAULT_DELIMITER) -> str:
    """SQL text of a line. A cell wider than its field is an error."""
    if layout.delimited:
        return f"concat_ws({text(delimiter)}, {', '.join(cells)})"
    width = row_width(fields)
    if layout.max_width and width > layout.max_width:
        raise ValueError(f"a row of {width} characters exceeds the {layout.max_width} of layout {layout.name!r}")
    return f"concat({', '.join(_pad(cell, field) for cell, field in zip(cells, fields))})"


def checked_line(line: str, fields: Sequence[Field], layout: Layout, delimiter: str = DEFAULT_DELIMITER) -> str:
    """The line, or an error when a cell contains the delimiter and could not be read back."""
    if not layout.delimited or not delimiter:
        return line
    # as many delimiters as split would find, counted by the bytes they take: no cell is copied
    taken = f"octet_length({line}) - octet_length(replace({line}, {text(delimiter)}, ''))"
    message = text(f"a cell contains the delimiter {delimiter!r}")
    return f"if({taken} <> {(len(fields) - 1) * len(delimiter.encode())}, {failure(message)}, {line})"


def escapes(layout: Layout, delimiter: str) -> list[tuple[str, str]]:
    """(text, how it is written) in the order of reading; for delimited layouts only, since escapes change widths."""
    if not layout.delimited:
        raise ValueError(f"cells of layout {layout.name!r} cannot be escaped")
    if set(delimiter) & {ESCAPE, *(sign for _, sign in ESCAPES)}:
        raise ValueError(f"the delimiter {delimiter!r} takes part in escapes")
    return [(delimiter if plain is None else plain, ESCAPE + sign) for plain, sign in ESCAPES]


def escaped_cell(cell: str, layout: Layout, delimiter: str = DEFAULT_DELIMITER) -> str:
    """SQL text of a cell without line breaks and delimiters."""
    for plain, written in reversed(escapes(layout, delimiter)):
        cell = f"replace({cell}, {text(plain)}, {text(written)})"
    return cell


def unescaped_cell(cell: str, layout: Layout, delimiter: str = DEFAULT_DELIMITER) -> str:
    """SQL text of what :func:`escaped_cell` was given."""
    for plain, written in escapes(layout, delimiter):
        cell = f"replace({cell}, {text(written)}, {text(plain)})"
    return cell


def _pad(cell: str, field: Field) -> str:
    width = cell_width(field)
    message = f"concat({text(f'field {field.name} is wider than {width}: ')}, {cell})"
    return f"if(length({cell}) > {width}, {failure(message)}, rpad({cell}, {width}, ' '))"
