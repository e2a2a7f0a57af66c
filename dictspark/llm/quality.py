"""Quality: random-indexing word vectors pooled per document, under a two-layer network with a calibrated temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices

#: Hashed words, and hashed shapes of words (case, signs, repetition), each with a vector.
WORD_BITS, SHAPE_BITS = 14, 10
DIMENSIONS, NONZERO = 32, 6
#: Neighbours on each side that a word's vector is gathered from.
WINDOW = 2
BLOCK_BYTES = 1 << 18
#: Rows of the vector table that leave a task together.
STRIPE = 1 << 9
#: Bound of the labelled rows to learn from, for each class.
MAX_ROWS = 6000
HIDDEN = 32

_N = (1 << WORD_BITS) + (1 << SHAPE_BITS)
_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SIGN = ~(_SPACE | _UPPER | _LOWER | _DIGIT | np.array([b >= 128 for b in range(256)]))
#: What a byte adds to its word's hash (without signs and case), and to that of its signs.
_LETTER = np.array([0 if _SPACE[b] or _SIGN[b] else b + 33 if _UPPER[b] else b + 1 for b in range(256)], np.uint64)
_SIGN_HASH = np.where(_SIGN, (np.arange(256, dtype=np.uint64) + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93), np.uint64(0))
#: Two counts in one number each: capitals and small letters, digits and all bytes that are no signs.
_CASES = _UPPER.astype(np.int64) + (_LOWER.astype(np.int64) << 32)
_OTHERS = _DIGIT.astype(np.int64) + ((~(_SPACE | _SIGN)).astype(np.int64) << 32)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def index_vectors() -> np.ndarray:
    """Sparse random vectors of 1, -1 and 0: what a neighbour adds to a word's vector."""
    rng = np.random.default_rng(29)
    out = np.zeros((_N, DIMENSIONS), np.float32)
    places = np.argsort(rng.random((_N, DIMENSIONS)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.float32), (_N, NONZERO)), 1)
    return out


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of non-space bytes: the word's row, the shape's row, and the text it is in.

    Words are compared without signs and letter case. A shape tells case, signs, digits, length and whether the word repeats one of the two before.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    raw = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    space = _SPACE[raw]
    starts = ~space
    starts[1:] &= space[:-1]
    at = np.flatnonzero(starts)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none
    owner = np.searchsorted(np.cumsum(sizes), at, "right")
    index = np.maximum(np.cumsum(starts) - 1, 0)
    place = np.clip(np.arange(len(raw)) - at[index], 0, 63)
    word = np.add.reduceat(_LETTER[raw] * _POWERS[place], at)
    signs = np.add.reduceat(_SIGN_HASH[raw], at)
    cases, counts = np.add.reduceat(_CASES[raw], at), np.add.reduceat(_OTHERS[raw], at)
    upper, lower, digits, others = cases & 0xFFFFFFFF, cases >> 32, counts & 0xFFFFFFFF, counts >> 32
    first = _UPPER[raw[at]]
    case = np.where(upper > 1, np.where(lower > 0, 3, 4), np.where(first, 2, 1)) * (upper + lower > 0)
    again = np.zeros(len(at), np.int64)
    for back in (1, 2):
        if len(at) > back:
            same = (word[back:] == word[:-back]) & (owner[back:] == owner[:-back])
            again[back:] |= np.where(same, back, 0)
    kind = case + 5 * np.minimum(digits, 2) + 15 * again + 60 * np.minimum(np.log2(others + 1).astype(np.int64), 7)
    mixed = (signs ^ (kind.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    shape = (mixed >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
    word = ((word * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    return word, shape + (1 << WORD_BITS), owner


def _blocks(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Whole texts as bytes in lists of bounded size, with the number of each one's text; a long text is cut at spaces."""
    held: list[bytes] = []
    owner: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        raw, at = (t or "").encode("utf-8", "surrogatepass"), 0
        while at < len(raw):
            end = min(at + BLOCK_BYTES, len(raw))
            if end < len(raw):
                gap = raw.find(b" ", end)
                end = gap if gap >= 0 else len(raw)
            if held and size + end - at > BLOCK_BYTES:
                yield held, np.array(owner)
                held, owner, size = [], [], 0
            held.append(raw[at:end])
            owner.append(i)
            size, at = size + end - at, end
    if held:
        yield held, np.array(owner)


# --- word vectors: counted over all documents --------------------------------------------------------------------------


def _neighbours(index: np.ndarray, word: np.ndarray, shape: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per word, its own shape and the words and shapes up to ``WINDOW`` places away in its text; sums of a few small numbers, so bytes hold them."""
    at = np.arange(len(word)) + WINDOW * (1 + np.cumsum(np.diff(owner, prepend=owner[0]) > 0))
    padded = np.zeros((at[-1] + WINDOW + 1, DIMENSIONS), np.int8)  # texts stand apart by as many zero rows as a window reaches
    padded[at] = index[word] + index[shape]
    n = len(padded) - 2 * WINDOW
    around = sum(padded[WINDOW + k : WINDOW + k + n] for k in range(-WINDOW, WINDOW + 1) if k)
    return around[at - WINDOW] + index[shape]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What neighbours add to each row's vector, in stripes of rows; one set of stripes for each task."""
    index, sums, counts = index_vectors().astype(np.int8), np.zeros((_N, DIMENSIONS), np.int64), np.zeros(_N, np.int64)
    for batch in batches:
        for part in slices(batch, 0):
            for texts, _ in _blocks(part.column(0).to_pylist()):
                word, shape, owner = tokens(texts)
                if not len(word):
                    continue
                near = _neighbours(index, word, shape, owner)
                for rows in (word, shape):
                    order = np.argsort(rows.astype(np.uint16), kind="stable")
                    at = np.flatnonzero(np.diff(rows[order], prepend=-1))
                    own = rows[order[at]]
                    sums[own] += np.add.reduceat(near[order], at, axis=0, dtype=np.int64)
                    counts[own] += np.diff(at, append=len(order))
    stripes = [np.column_stack([sums[i : i + STRIPE], counts[i : i + STRIPE]]).ravel() for i in range(0, _N, STRIPE)]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(stripes), dtype=np.int32)), pa.array([s.tobytes() for s in stripes], pa.binary())], names=["stripe", "sums"])


def _add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for stripe, sums in zip(batch["stripe"], batch["sums"], strict=True):
            own = np.frombuffer(sums, np.int64)
            total[stripe] = total[stripe] + own if stripe in total else own
    yield pd.DataFrame({"stripe": list(total), "sums": [s.tobytes() for s in total.values()]})


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """A vector for each hashed word and shape, from its neighbours in all documents.

    Each task adds up its own documents; stripes of the table are then added by Spark. The table's size does not depend on the input.
    """
    sums = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_gather, "stripe int, sums binary")
    rows = sums.repartition("stripe").mapInPandas(_add, "stripe int, sums binary").collect()
    table = np.zeros((_N, DIMENSIONS + 1))
    for row in rows:
        own = np.frombuffer(row.sums, np.int64).reshape(-1, DIMENSIONS + 1)
        table[row.stripe * STRIPE : row.stripe * STRIPE + len(own)] += own
    count = table[:, -1]
    mean = table[:, :-1] / np.maximum(count, 1)[:, None]
    if count.any():
        mean = mean - (table[:, :-1].sum(0) / count.sum())[None, :]  # what all words have in common tells nothing
    length = np.linalg.norm(mean, axis=1)
    return np.where(count[:, None] > 0, mean / np.maximum(length, 1e-9)[:, None], index_vectors() / np.sqrt(NONZERO)).astype(np.float32)


def pooled(vectors: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """Per text: mean word vector, mean shape vector, their spread, and its length; zeros without words."""
    words, shapes = vectors[: 1 << WORD_BITS], np.column_stack([vectors[1 << WORD_BITS :], index_vectors()[1 << WORD_BITS :]])
    total = np.zeros((len(texts), 3 * DIMENSIONS), np.float64)
    n = np.zeros(len(texts))
    for part, owner in _blocks(texts):
        word, shape, place = tokens(part)
        if not len(word):
            continue
        starts = np.flatnonzero(np.diff(place, prepend=-1))
        x, y = words[word], shapes[shape - (1 << WORD_BITS)]
        for start, end in zip(starts, np.append(starts[1:], len(word)), strict=True):
            at = owner[place[start]]
            total[at, :DIMENSIONS] += x[start:end].sum(0, dtype=np.float64)
            total[at, DIMENSIONS:] += y[start:end].sum(0, dtype=np.float64)
            n[at] += end - start
    return np.column_stack([total / np.maximum(n, 1)[:, None], np.log1p(n)])


# --- the network ---------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    shift: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.logits(pooled(self.vectors, texts)) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def score(self, text: Column) -> Column:
        """The probability of label 1, from the whole text."""

        def batch(texts: pd.Series) -> pd.Series:
            return pd.Series(self.scores(texts.tolist()))

        return F.pandas_udf(batch, "double")(text.cast("string"))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, prior: float, seed: int = 7, epochs: int = 60) -> Model:
    """Fit by Adam on weighted rows; a fifth is kept back for the temperature, the divisor of the logits that makes them most likely."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(3 * DIMENSIONS + 1), np.ones(3 * DIMENSIONS + 1))
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    if not len(y) or y.min() == y.max():
        share = float(y[0]) if len(y) else 0.5
        layers[2][:] = 0
        return Model(vectors, mean, scale, layers, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    held = rng.random(len(y)) < 0.2
    balance = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    z = (x - mean) / scale
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in layers]
    rows, step = np.flatnonzero(~held), 0
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(rows), max(1, len(rows) // 64)):
            w1, b1, w2, b2 = layers
            own = z[part] + rng.normal(0, 0.05, (len(part), z.shape[1]))
            hidden = np.maximum(own @ w1 + b1, 0)
            delta = balance[part] * (_sigmoid(hidden @ w2 + b2) - y[part]) / len(part)
            back = np.outer(delta, w2) * (hidden > 0)
            gradients = [own.T @ back + 1e-4 * w1, back.sum(0), hidden.T @ delta + 1e-4 * w2, delta.sum(keepdims=True)]
            step += 1
            rate = 0.003 * (1 - epoch / epochs)
            for p, g, (m, v) in zip(layers, gradients, moments, strict=True):
                m[:] = 0.9 * m + 0.1 * g
                v[:] = 0.999 * v + 0.001 * g * g
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, layers, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else rows
    logits = model.logits(x[check])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [float((balance[check] * np.logaddexp(0, np.where(y[check] == 1, -1, 1) * logits / t)).sum()) for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Model:
    """Gather word vectors from all documents, and learn from at most ``max_rows`` labelled ones of each class outside the held-out quarter, those of smallest id hash.

    Null labels and ids are left out. Without labelled rows, or with one class only, every score is that class's share (one half without labels).
    """
    vectors = word_vectors(docs, text)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = known.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(max_rows).unionByName(known.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(max_rows))

    @F.pandas_udf("array<double>")
    def pool(texts: pd.Series) -> pd.Series:
        return pd.Series(list(pooled(vectors, texts.tolist())))

    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(few), "id")
    rows = texts.select("id", "y", pool("text").alias("x")).orderBy("id", "y", F.xxhash64("x")).collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), 3 * DIMENSIONS + 1)
    total = counts.get(0, 0) + counts.get(1, 0)
    return train(vectors, x, np.array([r.y for r in rows], float), counts.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text.

    Nothing but the text is an input of the score; a null text is scored as an empty one, by the network's answer to zero vectors. Null ids and repeated rows
    are scored as they are; other columns are not read.
    """
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), model.score(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
