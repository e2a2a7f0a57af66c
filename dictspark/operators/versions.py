"""Picking one row per key by rank, without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Object versions, the preferred one first.
VERSION_ORDER = ("A", "D")


def one_per_key(df: DataFrame, keys: Sequence[str], rank: Sequence[Column], smallest: bool = True) -> DataFrame:
    """The row with the smallest (or largest) rank of each key.

    ``min_by`` combines on the map side: a hot key reduces to one row per input partition
    before the shuffle, where a window would sort all of it in one task.
    """
    row = F.struct(*df.columns)
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)])
    pick = F.min_by(row, order) if smallest else F.max_by(row, order)
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(pick.alias("_row")).select("_row.*")


def prefer_active(df: DataFrame, keys: Sequence[str], version: str = "version", tie: Sequence[str] = ()) -> DataFrame:
    """The active version of each object, else the delivered one."""
    place = F.lit(len(VERSION_ORDER))
    for i, name in reversed(list(enumerate(VERSION_ORDER))):
        place = F.when(F.col(version) == name, F.lit(i)).otherwise(place)
    return one_per_key(df, keys, [place, *[F.col(t) for t in tie]])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last image of each key."""
    return one_per_key(df, keys, [F.col(o) for o in order], smallest=False)
