"""Exact top-k search by inner product: distances bounded by segment statistics, coarse to fine, exact ones for what is left.

A vector is cut into segments, of which mean and deviation are kept, each times the root of the segment's length. Such statistics have
the vector's own length, and the distance of two vectors is at least that of their statistics. With ``|x - q|^2 = |x|^2 + |q|^2 - 2 x.q``
a lower bound of the distance is an upper bound of the inner product: the product of the statistics. More segments bound closer.

Candidates are sorted along a curve through their coarse statistics and cut into groups of bounded size. A query first meets its own group,
whose best give it a threshold; then only those groups whose box of statistics allows a better one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Segments of each resolution, coarse to fine.
LEVELS = (4, 8, 16)
#: Candidates of a group (about), queries that meet a group in one task, and groups that queries are held against at once.
GROUP_ROWS, QUERY_ROWS, BOXES = 4096, 1024, 1024
#: Means that the curve runs through, and bits of each.
CURVE_SEGMENTS, CURVE_BITS = 8, 4
#: Rounding of a bound, as a share of both lengths.
SLACK = 1e-9
_LONG = np.iinfo(np.int64)


# --- statistics and bounds ---------------------------------------------------------------------------------------------


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means, then deviations, of the segments of each row, times the root of their lengths; as many segments as there are dimensions at most."""
    dim = x.shape[1]
    edges = np.unique(np.linspace(0, dim, min(segments, dim) + 1).astype(int))
    sizes = np.diff(edges)
    if not dim:
        return np.zeros((len(x), 0))
    mean = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    apart = np.add.reduceat(np.square(x - np.repeat(mean, sizes, axis=1)), edges[:-1], axis=1)
    return np.hstack([mean * np.sqrt(sizes), np.sqrt(apart)])


def curve(x: np.ndarray) -> np.ndarray:
    """A place on a Z-shaped curve through the segment means, relative to the vector's length: the means' leading bits first."""
    dim = x.shape[1]
    if not dim:
        return np.zeros(len(x), np.int64)
    length = np.maximum(np.linalg.norm(x, axis=1), np.finfo(float).tiny)[:, None]
    means = statistics(x, CURVE_SEGMENTS)
    means = means[:, : means.shape[1] // 2] / length * np.sqrt(dim)
    cells = np.clip((means + 2) * (1 << CURVE_BITS) / 4, 0, (1 << CURVE_BITS) - 1).astype(np.int64)
    out = np.zeros(len(x), np.int64)
    for bit in range(CURVE_BITS - 1, -1, -1):
        for j in range(cells.shape[1]):
            out = out << 1 | cells[:, j] >> bit & 1
    return out


def box_bound(low: np.ndarray, high: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The largest product of each query's statistics (rows) with any in each box (columns)."""
    return np.minimum(query, 0) @ low.T + np.maximum(query, 0) @ high.T


class Group:
    """Candidates with their statistics of every resolution."""

    def __init__(self, x: np.ndarray):
        self.whole = x
        self.x = x.astype(np.float64)
        self.levels = [statistics(self.x, m) for m in LEVELS]
        self.length = float(np.linalg.norm(self.x, axis=1).max()) if len(x) else 0.0

    def exact(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products, beyond 64 bits the nearest long."""
        if self.length * float(np.linalg.norm(query.astype(np.float64))) < 1 << 52:
            return (self.x[at] @ query.astype(np.float64)).astype(np.int64)
        return np.array([min(max(int(s), _LONG.min), _LONG.max) for s in self.whole[at].astype(object) @ query.astype(object)], np.int64)

    def best(self, query: np.ndarray, levels: list[np.ndarray], k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of all candidates that score ``least`` or more and are, ties included, among the ``k`` best."""
        slack = SLACK * self.length * float(np.linalg.norm(query.astype(np.float64)))
        bound = self.levels[0] @ levels[0]
        alive = np.flatnonzero(bound >= least - slack)
        if len(alive) > 4 * k:  # the most promising raise the threshold
            first = alive[np.argpartition(-bound[alive], 2 * k)[: 2 * k]]
            least = max(least, np.partition(self.exact(first, query), -k)[-k])
            alive = alive[bound[alive] >= least - slack]
        for own, other in zip(self.levels[1:], levels[1:], strict=True):
            alive = alive[own[alive] @ other >= least - slack]
        scores = self.exact(alive, query)
        if len(scores) > k:
            least = max(least, np.partition(scores, -k)[-k])
        held = scores >= least
        return alive[held], scores[held]


# --- tasks -------------------------------------------------------------------------------------------------------------

_FOUND = "dim int, g int, class long, score long, vec_id long, row long, low array<double>, high array<double>"
_FOUND_ARROW = pa.schema([("dim", pa.int32()), ("g", pa.int32()), ("class", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The curve's place of every vector."""
    for batch in batches:
        vectors = batch.column(batch.schema.get_field_index("x"))
        sizes = np.diff(vectors.offsets.to_numpy())
        out = np.zeros(len(sizes), np.int64)
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            out[at] = curve(vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim).astype(np.float64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(out)], names=[*batch.schema.names, "dim", "z"])


def _search(candidates: pa.Table, queries: pa.Table, least: np.ndarray, k: int) -> dict[str, list]:
    """The ``k`` best members of the candidates' classes for every query, by score, then id, then row."""
    dim = candidates.column("dim")[0].as_py()
    group = Group(_matrix(candidates.column("x"), dim))
    ids, rows = (candidates.column(c).combine_chunks() for c in ("ids", "rows"))
    wanted = _matrix(queries.column("x"), dim)
    levels = [statistics(wanted.astype(np.float64), m) for m in LEVELS]
    out: dict[str, list] = {name: [] for name in _FOUND_ARROW.names}
    for i, name in enumerate(queries.column("class").to_pylist()):
        at, scores = group.best(wanted[i], [own[i] for own in levels], k, least[i])
        own = pa.array(at)
        members = sorted((-s, d, r) for s, ds, rs in zip(scores.tolist(), ids.take(own).to_pylist(), rows.take(own).to_pylist(), strict=True) for d, r in zip(ds, rs, strict=True))
        for s, d, r in members[:k]:
            for column, value in zip(_FOUND_ARROW.names, (dim, None, name, -s, d, r, None, None), strict=True):
                out[column].append(value)
    return out


def _own_group(group: pa.Table, k: int) -> pa.Table:
    """What the queries of a group find in it, and a row with the box of its statistics."""
    queries = group.filter(group.column("query"))
    dim, g = (group.column(c)[0].as_py() for c in ("dim", "g"))
    out = _search(group, queries, np.full(len(queries), -np.inf), k)
    own = statistics(_matrix(group.column("x"), dim).astype(np.float64), LEVELS[-1])
    for column, value in zip(_FOUND_ARROW.names, (dim, g, None, None, None, None, own.min(0).tolist(), own.max(0).tolist()), strict=True):
        out[column].append(value)
    return pa.table(out, schema=_FOUND_ARROW)


def _least(queries: pa.Table) -> np.ndarray:
    return queries.column("least").to_numpy().astype(np.float64)


def _routes(queries: pa.Table, boxes: pa.Table) -> pa.Table:
    """The groups, but for its own, that may hold something better for each query."""
    schema = pa.schema([("class", pa.int64()), ("dim", pa.int32()), ("g", pa.int32())])
    if not len(queries) or not len(boxes):
        return schema.empty_table()
    dim = queries.column("dim")[0].as_py()
    x = _matrix(queries.column("x"), dim).astype(np.float64)
    width = len(boxes.column("low")[0])
    low, high = _matrix(boxes.column("low"), width), _matrix(boxes.column("high"), width)
    # no vector of a box is longer than its farthest corner
    slack = SLACK * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(np.maximum(np.abs(low), np.abs(high)), axis=1)[None, :]
    open_ = box_bound(low, high, statistics(x, LEVELS[-1])) >= _least(queries)[:, None] - slack
    g = boxes.column("g").to_numpy()
    open_ &= queries.column("g").to_numpy()[:, None] != g[None, :]
    i, j = np.nonzero(open_)
    return pa.table([queries.column("class").to_numpy()[i], np.full(len(i), dim, np.int32), g[j]], schema=schema)


def _visit(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    if not len(candidates) or not len(queries):
        return _FOUND_ARROW.empty_table()
    return pa.table(_search(candidates, queries, _least(queries), k), schema=_FOUND_ARROW)


# --- the operator ------------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Vectors whose components are neither null nor infinite nor NaN."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    return F.coalesce(F.forall(numbers, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def whole(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * c)`` of every component, as longs (beyond 64 bits the nearest)."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (a condition on ``vectors``) the ``k`` other rows of highest inner product.

    Components become whole numbers (``whole``), so scores are exact; of equal ones the smaller id wins. All rows but the
    query's own are candidates, also those that repeat its id or vector; there are fewer than ``k`` results if there are fewer rows. Rows that repeat a query's id
    each have their own results. Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part; vectors of another length are no candidates. Scores beyond 64 bits are the nearest long. Other columns may have any
    names; an empty table gives no rows.

    Equal vectors are one class: of each, the k + 1 smallest ids are all that can ever be among a query's k best, and equal queries are asked once for k + 1.
    Classes form groups of about ``group_rows``. Groups and queries meet in tasks that hold one group and ``QUERY_ROWS`` queries.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("x"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("x"))).withColumn("x", whole(F.col("x"), scale))
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    n = k + 1
    asked = rows.where("query").select("x").distinct().withColumn("query", F.lit(True))
    place = F.row_number().over(Window.partitionBy("x").orderBy("vec_id", "row"))
    few = rows.drop("query").withColumn("place", place).where(F.col("place") <= n)
    members = F.array_sort(F.collect_list(F.struct("vec_id", "row")))
    classes = few.groupBy("x").agg(members.alias("m")).select("x", F.col("m.vec_id").alias("ids"), F.col("m.row").alias("rows"))
    classes = classes.join(asked, "x", "left").withColumns({"query": F.coalesce("query", F.lit(False)), "class": F.monotonically_increasing_id()})
    classes = cut(classes)
    n_classes = classes.count()
    fields = "x array<bigint>, ids array<bigint>, rows array<bigint>, query boolean, class long, dim int, z long"
    ordered = classes.mapInArrow(_placed, fields).repartitionByRange(max(1, -(-n_classes // group_rows)), "dim", "z", "class")
    groups = cut(ordered.drop("z").withColumn("g", F.spark_partition_id()))

    found = cut(groups.groupBy("dim", "g").applyInArrow(lambda group: _own_group(group, n), _FOUND))
    boxes = found.where("class IS NULL").select("dim", "g", "low", "high")
    found = found.where("class IS NOT NULL").select("class", "score", "vec_id", "row")
    # the n-th best so far, or nothing yet
    least = found.groupBy("class").agg(F.when(F.count(F.lit(1)) >= n, F.min("score").cast("double")).otherwise(float("-inf")).alias("least"))
    queries = cut(groups.where("query").select("class", "x", "dim", "g").join(least, "class"))
    n_parts = max(1, -(-queries.count() // QUERY_ROWS))
    n_boxes = max(1, -(-boxes.count() // BOXES))

    # every query against every box, in blocks of both
    part = F.pmod(F.xxhash64("class"), F.lit(n_parts)).cast("int").alias("part")
    left = queries.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(n_boxes - 1))).alias("block"))
    right = boxes.select("*", F.pmod(F.col("g"), F.lit(n_boxes)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))
    keys = ["dim", "block", "part"]
    routes = cut(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda own, other: _routes(own, other), "class long, dim int, g int"))

    # a group that many queries visit is copied for every QUERY_ROWS of them
    shares = routes.groupBy("dim", "g").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts"))
    left = groups.join(shares, ["dim", "g"]).select("dim", "g", "x", "ids", "rows", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = routes.join(shares, ["dim", "g"]).join(queries.select("class", "x", "least"), "class")
    right = right.select("dim", "g", "class", "x", "least", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part"))
    keys = ["dim", "g", "part"]
    visits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda one, many: _visit(one, many, n), _FOUND)
    found = found.unionByName(visits.select("class", "score", "vec_id", "row"))

    order = [F.col("score").desc(), "vec_id", "row"]
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("class").orderBy(*order))).where(F.col("place") <= n).drop("place")
    own = rows.where("query").select("x", F.col("vec_id").alias("query_id"), F.col("row").alias("query_row")).join(queries.select("class", "x"), "x").drop("x")
    pairs = own.join(best, "class").where("row <> query_row")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
