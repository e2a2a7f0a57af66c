"""Quoting for expressions written as SQL text.

Cells are decoded and encoded by SQL text rather than Column calls: a wide table then costs the
driver one parse per column, not dozens of calls into the JVM.
"""

from __future__ import annotations


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"


#: Signs of a padding literal at most; Spark repeats it, and cuts it for the rest sign by sign.
PADDING = 8


def padding(sign: str, width: int) -> str:
    """What a cell is padded with: Spark copies a padding as often as it fits, so one of many signs is copied once and not sign by sign."""
    return text(sign * min(width, PADDING))


def failure(message: str, kind: str = "string") -> str:
    """An expression that raises with a message (itself SQL text)."""
    return f"CAST(raise_error({message}) AS {kind})"
