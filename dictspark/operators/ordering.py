"""A global row number without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PARTITION_BITS = 33


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Rows numbered from 1 in ``order``.

    A range sort places the rows, and each row's place (partition and offset) is written before
    it is used twice, so a lost executor cannot change it. Only the row counts of the partitions
    go through a single-task window.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    partition = F.shiftright("_place", PARTITION_BITS)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_place") - F.shiftleft(F.col("_partition"), PARTITION_BITS)
    joined = placed.join(offsets, partition == F.col("_partition"))
    return joined.withColumn(name, F.col("_offset") + inside + 1).drop("_place", "_partition", "_offset")
