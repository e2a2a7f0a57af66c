"""Text extracts: lines plus dictionary fields ↔ typed DataFrame."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decode import decode_alike, decode_cell
from ..functions.encode import encode_cell
from ..functions.sqltext import name
from ..functions.types import TEXT_TYPES, Field, data_fields
from ..session import compile_small
from .dictionary import as_fields
from .layouts import DEFAULT_DELIMITER, bucket_for, checked_line, chunk_line, escaped_cell, join_cells, layout_named, split_pattern, unescaped_cell

LINE = "line"
PARTS = "_parts"
ALIKE = "_alike_"
#: Fields from which on the cells of a type are decoded whole by the same code.
WIDE = 100


def alike(kinds: Sequence[Hashable]) -> list[list[int]]:
    """The positions of equal kinds, by first appearance."""
    groups: dict[Hashable, list[int]] = {}
    for i, kind in enumerate(kinds):
        groups.setdefault(kind, []).append(i)
    return list(groups.values())


def arrays(columns: Sequence[str], groups: Sequence[Sequence[int]]) -> list[str]:
    """The columns of each group as an array (SQL text)."""
    return [f"array({', '.join(columns[i] for i in group)}) AS {ALIKE}{g}" for g, group in enumerate(groups)]


def apart(array: str, result: str) -> str:
    """A function's result over an array of columns (SQL text). Catalyst would merge the projection of the array into this one, whose functions are
    not compiled, if it were named once."""
    return f"if(size({array}) = 0, NULL, {result})"


def grouped(groups: Sequence[Sequence[int]]) -> list[str]:
    """Where each position is among the arrays of its group (SQL text)."""
    places = {i: f"get({ALIKE}{g}, {k})" for g, group in enumerate(groups) for k, i in enumerate(group)}
    return [places[i] for i in sorted(places)]


def _located(lines: DataFrame, fields: Sequence[Field], layout: str, delimiter: str, line: str, begin: bool = False) -> tuple[DataFrame, list[str], list[str]]:
    """Lines with their parts, the columns to keep, and where each field's cell is (SQL text). ``begin``: what follows the fields is not split."""
    keep = [name(c) for c in lines.columns if c != line]
    if layout_named(layout).delimited:
        parts = F.split(F.col(line), split_pattern(delimiter), len(fields) + 1 if begin else -1)
        return lines.withColumn(PARTS, parts), keep, [f"get({PARTS}, {i})" for i in range(len(fields))]
    pieces, cells = chunk_line(fields, name(line))
    return lines.selectExpr(*keep, *pieces), keep, cells


def split_extract(
    lines: DataFrame,
    fields: DataFrame | Sequence[Field],
    layout: str = "fixed",
    delimiter: str = DEFAULT_DELIMITER,
    line: str = LINE,
) -> DataFrame:
    """Lines → one text column per field, other columns kept."""
    fields = data_fields(as_fields(fields))
    located, keep, cells = _located(lines, fields, layout, delimiter, line)
    return located.selectExpr(*keep, *[f"{cell} AS {name(f.name)}" for cell, f in zip(cells, fields)])


def decode_cells(cells: DataFrame, fields: DataFrame | Sequence[Field], strict: bool = False, initial_time_is_null: bool = True) -> DataFrame:
    """Text columns → typed columns by the dictionary; columns without a field are kept."""
    compile_small(cells.sparkSession)
    known = {f.name: f for f in data_fields(as_fields(fields))}

    def decoded(column: str) -> str:
        if column not in known:
            return name(column)
        return f"{decode_cell(name(column), known[column], strict, initial_time_is_null)} AS {name(column)}"

    return cells.selectExpr(*[decoded(c) for c in cells.columns])


def decode_extract(
    lines: DataFrame,
    fields: DataFrame | Sequence[Field],
    layout: str = "fixed",
    delimiter: str = DEFAULT_DELIMITER,
    strict: bool = False,
    initial_time_is_null: bool = True,
    line: str = LINE,
    escape: bool = False,
    whole: bool = False,
    begin: bool = False,
) -> DataFrame:
    """Lines → typed DataFrame. One narrow projection: no shuffle, no Python. ``escape`` reads cells as written with it.

    With ``begin`` the fields are the first of a longer line, whose rest is left alone.
    ``whole`` is for uses of all columns of a wide delimited table: the cells of a type are decoded together, which is faster, but a column is not decoded without them.
    """
    compile_small(lines.sparkSession)
    fields = data_fields(as_fields(fields))
    shape = layout_named(layout)
    if not shape.delimited and not escape:
        return decode_cells(split_extract(lines, fields, layout, delimiter, line), fields, strict, initial_time_is_null)
    located, keep, cells = _located(lines, fields, layout, delimiter, line, begin)
    if escape:
        cells = [unescaped_cell(cell, shape, delimiter) if f.type in TEXT_TYPES else cell for cell, f in zip(cells, fields)]
    if whole and not strict and len(fields) >= WIDE:
        groups = alike([(f.type, f.length, f.decimals) for f in fields])
        decoded = [apart(f"{ALIKE}{g}", decode_alike(f"{ALIKE}{g}", fields[group[0]], initial_time_is_null)) for g, group in enumerate(groups)]
        together = located.selectExpr(*keep, *arrays(cells, groups)).selectExpr(*keep, *[f"{a} AS {ALIKE}{g}" for g, a in enumerate(decoded)])
        return together.selectExpr(*keep, *[f"{place} AS {name(f.name)}" for place, f in zip(grouped(groups), fields)])
    typed = [f"{decode_cell(cell, f, strict, initial_time_is_null)} AS {name(f.name)}" for cell, f in zip(cells, fields)]
    return located.selectExpr(*keep, *typed)


def encode_extract(
    df: DataFrame,
    fields: DataFrame | Sequence[Field],
    layout: str = "fixed",
    delimiter: str = DEFAULT_DELIMITER,
    keep: Sequence[str] = (),
    line: str = LINE,
    escape: bool = False,
) -> DataFrame:
    """Typed DataFrame → lines; bucketed layouts add the chosen ``bucket``, NULL for a row above the largest.

    ``escape`` writes delimiters and line breaks inside text cells as pairs, so that any text can be read back.
    """
    compile_small(df.sparkSession)
    fields = data_fields(as_fields(fields))
    shape = layout_named(layout)
    kept = [name(k) for k in keep]
    encoded = [encode_cell(name(f.name), f) for f in fields]
    if escape:
        encoded = [escaped_cell(cell, shape, delimiter) if f.type in TEXT_TYPES else cell for cell, f in zip(encoded, fields)]
    cells = df.selectExpr(*kept, *[f"{cell} AS _{i}" for i, cell in enumerate(encoded)])
    joined = join_cells([f"_{i}" for i in range(len(fields))], fields, shape, delimiter)
    lines = cells.selectExpr(*kept, f"{joined} AS {name(line)}")
    out = lines.selectExpr(*kept, f"{checked_line(name(line), fields, shape, delimiter)} AS {name(line)}")
    if shape.bucketed:
        out = out.withColumn("bucket", bucket_for(F.length(line)))
    return out


def computed_once(lines: DataFrame, line: str = LINE) -> DataFrame:
    """The same lines, which are taken as they are by what follows.

    A join drops rows without a key, and Catalyst moves that filter below all projections: each key would be decoded from a line encoded for it
    alone. Filters are not moved below a generator.
    """
    kept = [name(c) for c in lines.columns if c != line]
    return lines.select(*kept, F.explode(F.array(F.col(name(line)))).alias(line)).select(*[name(c) for c in lines.columns])


def number_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Digit columns as numbers to join on. A blank becomes NULL, which matches nothing: an inner join drops such rows before its shuffle."""
    numbers = {c: f"try_cast({name(c)} AS BIGINT) AS {name(c)}" for c in columns}
    return df.selectExpr(*[numbers.get(c, name(c)) for c in df.columns])
