"""Comparing the members of buckets: large buckets are cut into chunks whose pairs are tasks of their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Members of a chunk of a large bucket, about. It sets how the work is dealt out, never what is found.
CHUNK = 1024
#: Large buckets whose keys (16 bytes each) may be broadcast; above that they are joined.
BROADCAST_KEYS = 1_000_000


def dealt(rows: DataFrame, keys: list[str], member: str, chunk: int = CHUNK) -> DataFrame:
    """Rows with ``c`` (own chunk), ``ci`` and ``cj`` (the pair of chunks to compare), gathered and sorted by keys and pair.

    A bucket of n rows has about n / chunk chunks, dealt by the hash of ``member``. Each pair of chunks, also of a chunk with
    itself, becomes a group of its own, so no task holds more than two chunks of a bucket, whatever the bucket's size.
    """
    large = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk).select(*keys, F.ceil(F.col("n") / chunk).cast("int").alias("n_chunks")))
    if large.count() <= BROADCAST_KEYS:
        large = F.broadcast(large)
    n = F.coalesce("n_chunks", F.lit(1))
    split = rows.join(large, keys, "left").withColumn("c", F.pmod(F.xxhash64(member), n).cast("int"))
    split = split.withColumn("d", F.explode(F.sequence(F.lit(0), n - 1))).withColumns({"ci": F.least("c", "d"), "cj": F.greatest("c", "d")}).drop("n_chunks", "d")
    by = [*keys, "ci", "cj"]
    return split.repartition(*by).sortWithinPartitions(*by, "c")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups of sorted rows, each with the positions where its groups start and the end."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        if rest[0] is not batch and _same(rest[0], 0, batch, batch.num_rows - 1, keys):
            continue  # one group goes on
        whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
        starts = _starts(whole, keys)
        if len(starts) > 1:
            yield whole.slice(0, starts[-1]), starts
        rest = [whole.slice(starts[-1])]
    if rest:
        whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
        yield whole, np.append(_starts(whole, keys), whole.num_rows)


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        values = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class Forest:
    """Sets of numbered members, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            keep = x != y
            if not keep.any():
                return
            a, b, x, y = a[keep], b[keep], x[keep], y[keep]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (further := parent[parent]).tolist() != parent.tolist():
                parent = further
            self.label = parent[self.label]


def forest_edges(n: int, chunk: np.ndarray, near: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``near`` links, at most one less than there are members.

    ``near(left, right)`` yields pairs of positions, in parts. For two chunks, only the links between their own connected
    sets are returned; those within a chunk come from the task that compares the chunk with itself.
    """
    own = Forest(n)
    ids = np.unique(chunk)
    for c in ids:
        at = np.flatnonzero(chunk == c)
        for a, b in near(at, at):
            own.join(a, b)
    if len(ids) < 2:
        at = np.flatnonzero(own.label != np.arange(n))
        return own.label[at], at
    both = Forest(n)
    both.label = own.label.copy()
    for a, b in near(np.flatnonzero(chunk == ids[0]), np.flatnonzero(chunk == ids[1])):
        both.join(a, b)
    roots = np.unique(own.label)
    moved = roots[both.label[roots] != roots]
    return both.label[moved], moved
