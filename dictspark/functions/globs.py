"""Name patterns: ``*`` and ``%`` for any run, ``?`` for one character, ``_`` literal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ESCAPE = "\\"


def like_pattern(glob: str) -> str:
    """LIKE pattern of a glob, with the wildcards of LIKE that the glob means literally escaped."""
    out = []
    for ch in glob:
        if ch in "*%":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in ("_", ESCAPE):
            out.append(ESCAPE + ch)
        else:
            out.append(ch)
    return "".join(out)


def is_glob(name: str) -> bool:
    return any(ch in "*?%" for ch in name)


def matches(column: str | Column, glob: str) -> Column:
    """Whether a column matches a glob; a match-all pattern costs nothing."""
    column = F.col(column) if isinstance(column, str) else column
    if glob.strip("*%") == "" and glob:
        return F.lit(True)
    return column.like(like_pattern(glob))
