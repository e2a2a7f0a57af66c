"""Embedding near-duplicates by Euclidean p-stable hashing of normalised vectors and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import dealt, forest_edges, groups
from .common import cut
from .components import components

#: Width of a projection's cells, for vectors of length 1.
CELL = 1.6
#: Share of pairs at the very threshold that may share no bucket; closer pairs are missed less often.
MISSED = 0.0005
#: Unrelated vectors of a label that a vector is expected to meet in a bucket.
MET = 128
#: Rows compared with a whole group at once.
ROWS = 256


def collision(distance: float, cell: float = CELL) -> float:
    """Probability that a projection puts two vectors at this distance in one cell."""
    r = cell / max(distance, 1e-12)
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, cosine: float) -> tuple[int, int]:
    """Projections of a bucket and number of tables: buckets fine enough for n vectors at right angles, tables enough for the threshold."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(n, 1) / MET) / -math.log(far)))
    hit = near**k
    return k, max(1, math.ceil(math.log(MISSED) / math.log1p(-hit))) if hit < 1 else 1


def _normalised(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])  # exact, against overflow and underflow of squares
    return x


def _keys(batches: Iterator[pa.RecordBatch], k: int, tables: int, seed: int) -> Iterator[pa.RecordBatch]:
    """For each vector the keys of its buckets in all tables, as one array."""
    planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        ids, vectors = batch.column("id"), batch.column("embedding")
        sizes = np.diff(vectors.offsets.to_numpy())
        for dim in np.unique(sizes).tolist():
            if dim not in planes:
                rng = np.random.default_rng([seed, dim])
                planes[dim] = rng.normal(size=(dim, k * tables)), rng.uniform(0, CELL, k * tables)
            rows = np.flatnonzero(sizes == dim)
            for i in range(0, len(rows), 4096):
                at = rows[i : i + 4096]
                own = vectors.take(pa.array(at))
                x = _normalised(own.flatten().to_numpy(zero_copy_only=False), dim)
                x /= np.linalg.norm(x, axis=1)[:, None]
                cells = np.floor((x @ planes[dim][0] + planes[dim][1]) / CELL).astype(np.int64).reshape(len(at), tables, k)
                keys = np.zeros((len(at), tables), np.uint64)
                for j in range(k):
                    keys = (keys ^ cells[:, :, j].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    keys ^= keys >> np.uint64(29)
                flat = pa.array(keys.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * tables), flat)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), lists], names=["id", "keys"])


_GROUP = ["label", "dim", "bucket", "ci", "cj"]


def _compare(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows ``(a, b, links)``: links of a forest between classes, or, where b is null, how many vectors class a was newly linked to."""
    for batch, starts in groups(batches, _GROUP):
        sizes = np.diff(starts)
        paired = batch.column("ci").to_numpy() != batch.column("cj").to_numpy()
        for g in np.flatnonzero(sizes > 1):
            part = batch.slice(starts[g], sizes[g])
            ids, count, chunk = (part.column(c).to_numpy() for c in ("id", "n", "c"))
            table = part.column("bucket_table").to_numpy()[0]
            keys = part.column("keys").flatten().to_numpy().reshape(len(ids), -1)[:, :table]
            x = _normalised(part.column("embedding").flatten().to_numpy(zero_copy_only=False), int(part.column("dim")[0].as_py()))
            length = np.linalg.norm(x, axis=1)
            links = np.zeros(len(ids), np.int64)
            both = chunk.min() != chunk.max()

            def near(left: np.ndarray, right: np.ndarray, x=x, length=length, keys=keys, links=links, both=both) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                cross = left is not right
                for i in range(0, len(left), ROWS):
                    own = left[i : i + ROWS]
                    close = x[own] @ x[right].T / (length[own, None] * length[right][None, :]) >= cosine
                    r, s = np.nonzero(close)
                    a, b = own[r], right[s]
                    if cross or not both:  # counted by one task, and only in the first table that brings them together
                        new = (a != b) & ~(keys[a] == keys[b]).any(1)
                        np.add.at(links, a[new], count[b[new]])
                        if cross:
                            np.add.at(links, b[new], count[a[new]])
                    yield a, b

            if paired[starts[g]] and not both:
                continue  # the other chunk has no row in this bucket
            a, b = forest_edges(len(ids), chunk, near)
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[a], ids[at]])), pa.array(np.concatenate([ids[b], ids[at]]), mask=np.arange(len(a) + len(at)) >= len(a)), pa.array(np.concatenate([np.zeros(len(a), np.int64), links[at]]))],
                names=["a", "b", "links"],
            )


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: components that are not null and finite, and one that is not zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", seed: int = 17) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of one label (not null) and length link if their cosine, in double precision, is ``cosine`` or more: ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest id that links reach, and ``kept`` marks its row. Null, zero and
    non-finite vectors link with nothing, as do those without label or id alone; rows with a null id count as vectors and can connect others, their
    ``kept`` is false and their component null if no member has an id. Rows that repeat an id and vector link with one another.

    Equal vectors of a label are one class from the start. Normalised classes are hashed by quantised random projections into the
    buckets of several tables; all pairs of a bucket are compared exactly, in chunks, and only counts and a spanning forest leave a task.
    A pair is counted in the first table that brings it together. The numbers of projections and tables follow from
    the number of classes of the largest label, so that a pair at the threshold itself is missed with probability MISSED.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    good = F.col("label").isNotNull() & usable(F.col("embedding"))
    classes = rows.where(good).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables = plan_tables(largest, cosine)
    keyed = classes.select("id", "embedding").mapInArrow(partial(_keys, k=k, tables=tables, seed=seed), "id long, keys array<long>")
    hashed = cut(classes.join(keyed, "id").select("id", "label", "dim", "n", "embedding", "keys"))
    placed = hashed.select("*", F.posexplode("keys").alias("bucket_table", "key")).withColumn("bucket", F.xxhash64("bucket_table", "key")).drop("key")
    found = cut(dealt(placed, _GROUP[:3], "id").mapInArrow(partial(_compare, cosine=cosine), "a long, b long, links long"))
    roots = components(found.where("b IS NOT NULL"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = classes.select("id", "label", "embedding", "n", "first_id").join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    joined = cut(joined.select("id", "label", "embedding", "first_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("root")))
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = joined.join(least, "root").select("label", "embedding", "n_links", "component_id")
    linked = rows.where(good).join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
