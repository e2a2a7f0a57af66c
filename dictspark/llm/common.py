"""Helpers shared by the operators: scratch tables, Arrow batches of bounded size, prefix sums in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dictspark.session import cut_lineage

# Rows of one batch are handled in slices of about this many bytes of text.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write to the folder of ``spark.checkpoint.dir`` and go on from the written rows."""
    return cut_lineage(df)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, also not in other letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(value: Column) -> Column:
    """``value``, computed once in its projection: filters on the rows stay above it.

    Spark moves a filter below a projection by putting expressions in the place of names. Where a long expression was built in
    steps that name their input several times, that repeats it over and over. A column that is not deterministic stops it.
    Filters on other columns stay above, too, so rows that aren't wanted are best filtered before.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def held_out(doc_id: Column | str) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2, F.lit(False))


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts (column number ``text``) add up to about ``limit`` bytes; one longer text is a part."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start, len(sizes) - start)


def scan(
    values: Column,
    initial: Column,
    advance: Callable[[Column, Column], Column],
    step: Callable[[Column, Column], Column],
    combine: Callable[[Column, Column], Column] | None,
    result: str,
) -> Column:
    """``step(value, state)`` of every element, the state being ``initial`` advanced by all elements before it.

    ``result`` is the type of the steps; ``values`` should be a column, since it is named several times. States are longs; ``combine`` must be what ``advance`` does with a whole block (a sum for sums, the greater for maxima).
    Without it, blocks are folded one after the other, for states that do not combine.
    A plain fold appends to a growing array, which copies it each time and is quadratic. Here the array is cut into
    blocks as long as the root of its length: states are folded within blocks and over blocks.
    """
    initial = initial.cast("long")
    empty = F.array().cast(f"array<{result}>")
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values)))).cast("int")
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(values, b * block + 1, block))
    totals = F.transform(blocks, lambda part: F.aggregate(part, initial, advance))
    if combine is None:
        bases = F.aggregate(blocks, F.array(initial), lambda acc, part: F.concat(acc, F.array(F.aggregate(part, F.element_at(acc, -1), advance).cast("long"))))
    else:
        bases = F.aggregate(totals, F.array(initial), lambda acc, t: F.concat(acc, F.array(combine(F.element_at(acc, -1), t))))

    def fold(part: Column, base: Column) -> Column:
        done = F.aggregate(
            part,
            F.struct(base.alias("at"), empty.alias("out")),
            lambda acc, v: F.struct(advance(acc["at"], v).cast("long").alias("at"), F.concat(acc["out"], F.array(step(v, acc["at"]))).alias("out")),
        )
        return done["out"]

    return F.flatten(F.zip_with(blocks, F.slice(bases, 1, F.size(blocks)), fold))
