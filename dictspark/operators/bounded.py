"""Keep nested groups bounded when one key holds a large share of the rows.

A group is gathered in parts, and the part of a row depends on the row alone: on its position where it has one, else on its
hash. No count, join or switch decides on it, so the shape of a result does not change with the size of its input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = "part"
#: Rows of a part, by position.
GROUP_ROWS = 10_000
NULL_MARK = "-"


def row_text(columns: Sequence[Column]) -> Column:
    """Unambiguous text of a row for hashing: every value with its length, NULL as a mark."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts])


def hex_slice(digest: Column, start: int = 1, digits: int = 15) -> Column:
    """A slice of a hex digest as a non-negative integer, the same in every engine."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def part_at(position: Column, size: int = GROUP_ROWS) -> Column:
    """The part of a row by its position: ``size`` neighbours share one, parts keep the order. Rows without position are in part 0."""
    return F.coalesce(F.floor(position / F.lit(size)).cast("bigint"), F.lit(0).cast("bigint"))


def part_by(columns: Sequence[Column], parts: int | Column) -> Column:
    """The part of a row without position: one of so many, by the hash of ``columns``."""
    if isinstance(parts, int):
        if parts < 1:
            raise ValueError("a group has one part at least")
        parts = F.lit(parts)
    return F.pmod(hex_slice(F.md5(row_text(columns))), parts).cast("bigint")
