"""Quality of text extracts: blank, initial, undecodable and implausible cells per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import types as D
from ..functions.decode import decode_cell, is_initial
from ..functions.sqltext import name, text
from ..functions.types import Field, data_fields
from ..sources.dictionary import as_fields

# Dates outside this range are suspicious.
PLAUSIBLE = ("1900-01-01", "2100-01-01")


def quality_profile(cells: DataFrame, fields: DataFrame | Sequence[Field], plausible: tuple[str, str] = PLAUSIBLE) -> DataFrame:
    """(field, cells, blanks, initials, undecodable, implausible) for every column of a split extract.

    One aggregation over one scan; the columns are turned into rows after it.
    """
    profiles = []
    for field in data_fields(as_fields(fields)):
        cell = name(field.name)
        value, initial = decode_cell(cell, field), is_initial(cell, field)
        implausible = "false"
        if field.type in D.DATE_TYPES + D.UTC_TYPES:
            implausible = f"CAST({value} AS DATE) NOT BETWEEN DATE '{plausible[0]}' AND DATE '{plausible[1]}'"
        profiles.append(
            f"struct({text(field.name)} AS field, count({cell}) AS cells, count_if(trim({cell}) = '') AS blanks, "
            f"count_if({initial} AND trim({cell}) <> '') AS initials, count_if({value} IS NULL AND NOT {initial}) AS undecodable, "
            f"count_if({implausible}) AS implausible)"
        )
    return cells.agg(F.expr(f"array({', '.join(profiles)})").alias("profiles")).select(F.inline("profiles"))
