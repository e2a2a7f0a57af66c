"""Embedding whitening: leading eigenvectors of the covariance by Jacobi-Davidson, without ever forming the covariance.

The covariance is only known by its products with a few vectors, each a Spark job over the centred vectors. The driver holds
a search space of at most ``SPACE`` times as many vectors as components are wanted, nothing that grows with the rows. Its Ritz pairs are improved by corrections
from projected equations, which MINRES solves for all pairs that have not converged at once, so that a step of it is one job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Entries x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors of the search space for each component wanted, and how many of them a restart keeps.
SPACE, KEPT = 3, 2
#: Steps of MINRES for a correction.
INNER = 6
#: A residual that counts as none, in roundings of the largest eigenvalue for each root of the dimension.
ROUNDINGS = 64
MAX_ROUNDS = 100
#: Eigenvalues below this share of the largest belong to directions without variance.
FLAT = 1e-12
#: Entries beyond are not representable.
LARGEST = float(1 << 50)

Product = Callable[[np.ndarray], np.ndarray]


# --- eigenpairs --------------------------------------------------------------------------------------------------------


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Columns that span what ``block`` adds to the bases; columns that add nothing go."""
    for _ in range(2):
        for base in bases:
            block = block - base @ (base.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-10]
    return block


def corrections(product: Product, values: np.ndarray, vectors: np.ndarray, residuals: np.ndarray, locked: np.ndarray, steps: int = INNER) -> np.ndarray:
    """Approximate solutions t of ``(1 - QQ')(V - value)(1 - QQ') t = -residual``, one column for each pair, by MINRES.

    Q is the pair's own vector and the locked ones. The columns are separate problems that share their products with V.
    """

    def project(block: np.ndarray) -> np.ndarray:
        for _ in range(2):
            block = block - vectors * (vectors * block).sum(0)
            block = block - locked @ (locked.T @ block)
        return block

    def operate(block: np.ndarray) -> np.ndarray:
        block = project(block)
        return project(product(block) - block * values)

    tiny = np.finfo(float).tiny
    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    v = v / np.maximum(beta, tiny)
    eta, start = beta.copy(), beta.copy()
    before, w_before, w, x = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    beta = np.zeros(v.shape[1])
    c_before = c = np.ones(v.shape[1])
    s_before = s = np.zeros(v.shape[1])
    for _ in range(steps):
        u = operate(v)
        alpha = (v * u).sum(0)
        u = u - alpha * v - beta * before
        following = np.linalg.norm(u, axis=0)
        # the new column of the tridiagonal matrix, turned by the last two rotations and one that clears its last entry
        far = s_before * beta
        near = s * alpha + c * c_before * beta
        diagonal = c * alpha - s * c_before * beta
        length = np.maximum(np.hypot(diagonal, following), tiny)
        c_before, s_before, c, s = c, s, diagonal / length, following / length
        w_before, w = w, (v - near * w - far * w_before) / length
        x = x + c * eta * w
        eta = -s * eta
        before, v, beta = v, u / np.maximum(following, tiny), following
        if (np.abs(eta) <= 1e-3 * start).all() or (following <= tiny).all():
            break
    return project(x)


def eigenpairs(product: Product, dim: int, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix given by its products with blocks of vectors, falling, and their vectors as columns.

    Every round takes the Ritz pairs of the search space, locks the leading ones whose residual is no more than rounding, and adds
    corrections for those that follow. It ends when all are locked; rounding that doesn't fall any further after that many rounds is an error.
    """
    k = min(k, dim)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = _orthonormal(rng.normal(size=(dim, min(dim, k + 4))))
    image = product(basis)
    for _ in range(MAX_ROUNDS):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        wanted = k - len(values)
        ritz, imaged = basis @ y[:, :wanted], image @ y[:, :wanted]
        residuals = imaged - ritz * theta[:wanted]
        residuals -= locked @ (locked.T @ residuals)
        size = np.linalg.norm(residuals, axis=0)
        largest = max([*values[:1], *np.abs(theta[:1]), np.finfo(float).tiny])
        bound = ROUNDINGS * np.finfo(float).eps * np.sqrt(dim) * largest
        done = 0
        while done < len(size) and size[done] <= bound:
            done += 1
        locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, theta[:done])
        if len(values) == k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        basis, image = basis @ y[:, done:], image @ y[:, done:]
        open_ = slice(done, wanted)
        if basis.shape[1] + wanted - done > max(SPACE * k, k + 8):
            basis, image = basis[:, : KEPT * k], image[:, : KEPT * k]
        fresh = corrections(product, theta[open_], ritz[:, open_], residuals[:, open_], locked)
        fresh = _orthonormal(fresh, locked, basis)
        if not fresh.shape[1]:  # nothing to add: an unlucky start
            fresh = _orthonormal(rng.normal(size=(dim, 1)), locked, basis)
        if fresh.shape[1]:
            basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"{k - len(values)} of {k} eigenvectors did not converge in {MAX_ROUNDS} rounds")


# --- sums over the vectors ---------------------------------------------------------------------------------------------


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _partial(batches: Iterator[pa.RecordBatch], dim: int, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sum of ``of(vectors)`` over all batches of a task, as ``(i, j, v)``."""
    total = np.zeros(shape)
    for batch in batches:
        total += of(_matrix(batch.column(0), dim))
    i, j = np.indices(shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])


def summed(vectors: DataFrame, dim: int, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The matrix that ``of`` gives for blocks of the vectors, added up over all. Tasks add up their own rows, Spark the tasks' sums; the driver gets one matrix."""
    rows = vectors.mapInArrow(partial(_partial, dim=dim, shape=shape, of=of), "i long, j long, v double")
    found = rows.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape)
    if found.num_rows:
        out[found.column("i").to_numpy(), found.column("j").to_numpy()] = found.column("v").to_numpy()
    return out


# --- the operator ------------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """What is needed to whiten a vector: ``n`` fitted vectors with ``sums`` by dimension, eigenvalues (falling) and vectors (columns), the covariance's trace, and how far the fitted vectors' whitened covariance is from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def whitener(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def usable(vector):
    """Vectors without null, non-finite or unrepresentable entries."""
    small = F.forall(F.transform(vector, lambda c: c.cast("double")), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(small, F.lit(False)) & (F.size(vector) > 0)


def entries(vector):
    """Entries as whole numbers: ``floor(SCALE * c) + SHIFT``, as longs."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT).cast("long"))


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exactly: as longs, or Python's numbers where these don't suffice."""
    reach = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if n * reach + max(map(abs, sums)) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[pa.RecordBatch]:
    """Vectors less their mean, divided only after the exact difference."""
    for batch in batches:
        x = _matrix(batch.column(0), len(sums))
        out = (_differences(x, n, sums) / n).astype(np.float64)
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(sums))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=["c"])


def fit(vectors: DataFrame, x: str, components: int = 16, seed: int = 5) -> Whitening | None:
    """Whitening of the distinct vectors of whole numbers in column ``x``, all of one length; None for no vectors.

    The vectors, less their mean, are written once; every product of the covariance reads them. Directions without variance get no component.
    """
    distinct = cut(vectors.select(F.col(x).alias("x")).distinct())
    n = distinct.count()
    if not n:
        return None
    # exact sums of longs by dimension; a row is one pass over its entries
    rows = distinct.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r.s) for r in sorted(rows, key=lambda r: r.i)]
    dim = len(sums)
    centred = cut(distinct.mapInArrow(partial(_centred, n=n, sums=sums), "c array<double>"))
    trace = summed(centred, dim, (1, 1), _squares)[0, 0] / n

    def product(block: np.ndarray) -> np.ndarray:
        return summed(centred, dim, block.shape, partial(_times, block=block)) / n

    k = min(components, dim, n - 1)
    if not trace > 0 or not k:
        return Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), trace, 0.0)
    values, found = eigenpairs(product, dim, k, seed)
    held = values > FLAT * values[0]
    out = Whitening(n, sums, values[held], found[:, held], trace, 0.0)
    second = summed(centred, dim, (held.sum() + 1, held.sum()), partial(_moments, whitener=out.whitener())) / n
    covariance = second[1:] - np.outer(second[0], second[0])
    out.identity_error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return out


def _squares(c: np.ndarray) -> np.ndarray:
    return np.array([[np.square(c).sum()]])


def _times(c: np.ndarray, block: np.ndarray) -> np.ndarray:
    return c.T @ (c @ block)


def _moments(c: np.ndarray, whitener: np.ndarray) -> np.ndarray:
    z = c @ whitener
    return np.vstack([z.sum(0), z.T @ z])


_OUT = "vec_id long, n long, deviation decimal(38,0), whitened array<double>"


def _whiten(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    whitener = model.whitener()
    k, dim = whitener.shape[1], len(model.sums)
    for batch in batches:
        x = _matrix(batch.column("x"), dim)
        apart = _differences(x, model.n, model.sums)
        if len(x) and dim * int(np.abs(apart).max()) ** 2 >= 1 << 63:
            apart = apart.astype(object)
        deviation = (apart * apart).sum(1) if len(x) else np.zeros(0, np.int64)
        z = (apart / model.n).astype(np.float64) @ whitener
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(np.full(len(x), model.n, np.int64)), pa.array([int(d) for d in deviation], pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))],
            names=["vec_id", "n", "deviation", "whitened"],
        )


def whiten(vectors: DataFrame, components: int = 16, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 5) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` for every vector: its ``components`` leading whitened coordinates.

    Entries become whole numbers (``entries``). The covariance is that of the distinct vectors, ``n`` of them. ``whitened`` holds the centred vector's
    coordinates along the unit eigenvectors by falling eigenvalue, over its root; ``explained`` the eigenvalues' shares of the
    trace; ``deviation`` is the sum over dimensions of ``(n * x - S)^2``, exactly; ``identity_error`` the largest entry of the whitened distinct vectors' covariance less the identity.

    Vectors that are null, empty or hold null, non-finite or entries of 2^50 and more take no part and give no row. There are fewer components than asked for if the
    vectors have fewer dimensions or vary in fewer; vectors without any variance have empty arrays. Rows that repeat an id or a vector
    each give a row, null ids as well. Vectors of different lengths are separate populations, each with its own fit, for at most 100 lengths. Other
    columns are not read; an empty table gives no rows.
    """
    rows = vectors.where(usable(F.col(embedding))).select(F.col(vec_id).cast("long").alias("vec_id"), entries(F.col(embedding)).alias("x"))
    rows = cut(rows)
    lengths = [r[0] for r in rows.select(F.size("x").alias("d")).distinct().orderBy("d").limit(101).collect()]
    if len(lengths) > 100:
        raise ValueError("vectors of more than 100 lengths")
    out = None
    for dim in lengths:
        own = rows.where(F.size("x") == dim) if len(lengths) > 1 else rows
        model = fit(own, "x", components, seed)
        done = own.mapInArrow(partial(_whiten, model=model), _OUT)
        shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
        done = done.withColumns({"explained": shares, "identity_error": F.lit(model.identity_error)})
        out = done if out is None else out.unionByName(done)
    if out is None:
        none = rows.limit(0).selectExpr("vec_id", "0L AS n", "CAST(0 AS decimal(38,0)) AS deviation", "CAST(array() AS array<double>) AS whitened")
        out = none.withColumns({"explained": F.col("whitened"), "identity_error": F.lit(0.0)})
    return out


def by_component(whitened: DataFrame) -> DataFrame:
    """``whiten``'s rows one by one: ``vec_id, component, n, deviation, whitened, explained, identity_error``, components numbered from 1."""
    each = F.posexplode(F.arrays_zip(F.col("whitened").alias("w"), F.col("explained").alias("e"))).alias("at", "pair")
    rows = whitened.select("vec_id", "n", "deviation", "identity_error", each)
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("pair.w").alias("whitened"), F.col("pair.e").alias("explained"), "identity_error")
