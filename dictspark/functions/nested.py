"""Expressions over nested values: pointers, list edits, rows ↔ columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tokens(path: str) -> list[str]:
    """Path tokens: split on ``/``, empty ones dropped, ``~1`` is ``/`` and ``~0`` is ``~``."""
    return [t.replace("~1", "/").replace("~0", "~") for t in path.split("/") if t]


def child(kind: T.StructType, name: str, where: str = "") -> T.StructField:
    """A field of a struct type; an unknown name is an error that lists the known ones."""
    if name not in kind.names:
        raise ValueError(f"field {name!r} not found{where}, expected one of {', '.join(kind.names)}")
    return kind[name]


def _position(token: str) -> int:
    if not token.isdigit():
        raise ValueError(f"{token!r} is not a list position")
    return int(token)


def get_at(column: Column, kind: T.DataType, pointer: str) -> Column:
    """The value a pointer names: struct fields by name, list elements by zero-based position.

    An unknown field fails while planning; a position outside the list fails at run time.
    """
    for token in tokens(pointer):
        if isinstance(kind, T.StructType):
            column, kind = column.getField(token), child(kind, token).dataType
        elif isinstance(kind, T.ArrayType):
            position = _position(token)
            inside = position < F.size(column)
            missing = F.raise_error(F.lit(f"position {position} is out of bounds")).cast(kind.elementType)
            column, kind = F.when(inside, F.get(column, F.lit(position))).when(column.isNotNull(), missing), kind.elementType
        else:
            raise ValueError(f"cannot descend into {kind.simpleString()} with {token!r}")
    return column


def set_at(column: Column, kind: T.DataType, pointer: str, value: Column) -> Column:
    """A copy of a nested value with one place replaced, cast to the type of that place."""
    path = tokens(pointer)
    if not path:
        return value.cast(kind)
    head, rest = path[0], "/".join(t.replace("~", "~0").replace("/", "~1") for t in path[1:])
    if isinstance(kind, T.StructType):
        return column.withField(head, set_at(column.getField(head), child(kind, head).dataType, rest, value))
    if isinstance(kind, T.ArrayType):
        position = _position(head)
        edited = F.transform(column, lambda item, i: F.when(i == position, set_at(item, kind.elementType, rest, value)).otherwise(item))
        missing = F.raise_error(F.lit(f"position {position} is out of bounds")).cast(kind)
        return F.when(position < F.size(column), edited).when(column.isNotNull(), missing)
    raise ValueError(f"cannot descend into {kind.simpleString()} with {head!r}")


def list_append(column: Column, kind: T.ArrayType, value: Column) -> Column:
    """The list with one more element, cast to the element type."""
    return F.array_append(column, value.cast(kind.elementType))


def list_remove_value(column: Column, kind: T.ArrayType, value: Column) -> Column:
    """The list without every element equal to ``value``."""
    target = value.cast(kind.elementType)
    return F.filter(column, lambda item: ~item.eqNullSafe(target))


def list_remove_at(column: Column, position: int) -> Column:
    """The list without the element at a zero-based position."""
    return F.filter(column, lambda item, i: i != position)


def zip_columns(column: Column, kind: T.StructType) -> Column:
    """A struct of lists → a list of structs; every child must be a list."""
    plain = [f.name for f in kind if not isinstance(f.dataType, T.ArrayType)]
    if plain:
        raise ValueError(f"not a list: {', '.join(plain)}")
    row = T.StructType([T.StructField(f.name, f.dataType.elementType) for f in kind])
    return F.arrays_zip(*[column.getField(f.name) for f in kind]).cast(T.ArrayType(row))


def unzip_rows(column: Column, kind: T.ArrayType) -> Column:
    """A list of structs → a struct of lists."""

    def column_of(name: str) -> Column:
        return F.transform(column, lambda row: row.getField(name)).alias(name)

    return F.struct(*[column_of(name) for name in kind.elementType.names])


def unsupported(names: Iterable[str], supported: Iterable[str], droppable: Iterable[str]) -> list[str]:
    """Names that are both unsupported and allowed to go, compared without case."""
    known = {n.upper() for n in supported}
    allowed = {n.upper() for n in droppable}
    return [n for n in names if n.upper() not in known and n.upper() in allowed]


def drop_unsupported(column: Column, kind: T.StructType, supported: Sequence[str], droppable: Sequence[str]) -> Column:
    """A struct without its unsupported droppable fields; everything else stays, to fail loudly later."""
    gone = unsupported(kind.names, supported, droppable)
    return column.dropFields(*gone) if gone else column
