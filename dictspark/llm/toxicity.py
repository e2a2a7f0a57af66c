"""Toxicity by subword bags: character n-gram vectors, averaged per passage, under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out

#: Orders of the n-grams in bytes, a space before and after a word included.
ORDERS = (3, 4, 5)
BUCKET_BITS = 17
DIMENSIONS = 16
#: Words of a passage. A document is as toxic as its most toxic passage, so a long text does not dilute a short insult.
PASSAGE_WORDS = 12
#: Longer texts are read in blocks of about so many bytes, cut at a space; passages begin anew in each.
BLOCK_BYTES = 1 << 18
#: Bounds of the labelled rows to learn from, by class.
MAX_TOXIC, MAX_CLEAN = 1400, 5000
#: Passages to learn from: of one toxic document, and of all clean ones together, in equal shares. The others of a longer document are left
#: out at random.
TOXIC_PASSAGES, CLEAN_PASSAGES = 120, 62_000
EPOCHS = 12

_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], np.uint32)
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
#: Digits and signs that stand for a letter inside a word.
_STAND_IN = np.arange(256, dtype=np.uint8)
for _sign, _letter in zip(b"013457@$", b"oieastas", strict=True):
    _STAND_IN[_sign] = _letter
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def _blocks(text: str) -> Iterator[bytes]:
    raw = text.lower().encode("utf-8", "surrogatepass")
    at = 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        if end < len(raw):
            gap = raw.find(b" ", end)
            end = gap if gap >= 0 else len(raw)
        yield raw[at:end]
        at = end


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with stand-ins read as letters, and which of them are in a word. A word that repeats the one before is left out."""
    letter = _LETTER[raw]
    before, after = np.roll(letter, 1), np.roll(letter, -1)
    swap = (_STAND_IN[raw] != raw) & np.where(_DIGIT[raw], before | after, before & after)
    raw = np.where(swap, _STAND_IN[raw], raw)
    word = letter | _DIGIT[raw] | swap
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    at = np.flatnonzero(starts)
    if len(at) > 1:
        index = np.cumsum(starts) - 1
        place = np.minimum(np.arange(len(raw)) - at[np.maximum(index, 0)], 63)
        sums = np.add.reduceat(np.where(word, (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[np.maximum(place, 0)], np.uint64(0)), at)
        again = np.zeros(len(at), bool)
        again[1:] = sums[1:] == sums[:-1]
        if again.any():
            word = word & ~again[np.maximum(index, 0)]
    return np.where(word, raw, 32).astype(np.uint32), word


def subwords(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets, the passage of each, and the block of each passage."""
    sizes = np.array([len(b) + 2 for b in blocks])
    text, word = _words(np.frombuffer(b"".join(b" " + b + b" " for b in blocks), np.uint8))
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    at = np.flatnonzero(starts)
    block_of_word = np.searchsorted(np.cumsum(sizes), at, "right")
    first = np.searchsorted(block_of_word, np.arange(len(blocks)))
    opens = (np.arange(len(at)) - first[block_of_word]) % PASSAGE_WORDS == 0
    passage_of_word = (np.cumsum(opens) - 1).astype(np.int32)
    index = np.cumsum(starts, dtype=np.int32) - 1
    found, owners = [], []
    inside = np.ones(len(text), bool)
    hashed = np.zeros(len(text), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        shift = order - 1
        if shift:
            hashed, inside = hashed[:-1], inside[:-1]
        hashed = hashed + text[shift:] * _MULTIPLIERS[shift]
        if order > 2:
            inside = inside & word[shift - 1 : len(word) - 1]
        if order in ORDERS:
            keep = np.flatnonzero(inside)
            mixed = (hashed[keep] ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
            found.append((mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
            owners.append(passage_of_word[index[keep + 1]])
    return np.concatenate(found), np.concatenate(owners), block_of_word[opens]


def _passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`subwords`, with the text in place of the block."""
    blocks, owner = [], []
    for i, t in enumerate(texts):
        for b in _blocks(t or ""):
            blocks.append(b)
            owner.append(i)
    if not blocks:
        none = np.zeros(0, np.int32)
        return none, none, none
    ids, passage, block = subwords(blocks)
    return ids, passage, np.array(owner)[block]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a block's size together."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > BLOCK_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if len(texts) > at:
        yield at, len(texts)


@dataclass
class Model:
    """The trained weights: ``weight`` is each bucket's vector under the softmax, the toxic class less the other."""

    weight: np.ndarray
    bias: float
    slope: float
    intercept: float
    empty: float

    def _margins(self, ids: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
        counts = np.maximum(np.bincount(passage, minlength=n), 1)
        return np.bincount(passage, weights=self.weight[ids], minlength=n) / counts + self.bias

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The margin of each text's most toxic passage; minus infinity without words."""
        top = np.full(len(texts), -np.inf)
        for at, to in _slices(texts):
            ids, passage, owner = _passages(texts[at:to])
            if len(owner):
                np.maximum.at(top[at:to], owner, self._margins(ids, passage, len(owner)))
        return top

    def scores(self, texts: list[str | None]) -> np.ndarray:
        top = self.margins(texts)
        return np.where(np.isfinite(top), _sigmoid(self.slope * np.where(np.isfinite(top), top, 0) + self.intercept), self.empty)

    def score(self, text: Column) -> Column:
        """The probability that a text is toxic, from all of its passages."""

        def batch(texts: pd.Series) -> pd.Series:
            return pd.Series(self.scores(texts.tolist()))

        return F.pandas_udf(batch, "double")(text.cast("string"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the margin, by Newton's method with a little shrinkage."""
    scale = max(float(np.std(margin)), 1e-6)
    x = np.column_stack([margin / scale, np.ones_like(margin)])
    beta = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - label)) + 0.1 * beta * [1, 0]
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([0.1, 1e-6])
        beta = beta - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(beta[0] / scale), float(beta[1])


def _misspelt(text: str, rng: np.random.Generator) -> str:
    """Every other word, about, with a letter doubled, dropped, swapped with the next or changed."""
    words = text.split(" ")
    for i in np.flatnonzero(rng.random(len(words)) < 0.5).tolist():
        w = words[i]
        if len(w) > 3:
            at, how = int(rng.integers(1, len(w) - 1)), int(rng.integers(4))
            words[i] = w[:at] + (w[at] + w[at:], w[at + 1 :], w[at + 1] + w[at] + w[at + 2 :], chr(97 + int(rng.integers(26))) + w[at + 1 :])[how]
    return " ".join(words)


class _Bags:
    """The training passages: buckets in one array, passage after passage, document after document."""

    def __init__(self, texts: list[str | None], most: np.ndarray, rng: np.random.Generator):
        ids, counts, owners = [], [], []
        for at, to in _slices(texts):
            own, passage, owner = _passages(texts[at:to])
            keep = np.ones(len(owner), bool)
            for d in np.flatnonzero(np.bincount(owner, minlength=to - at) > most[at:to]):
                mine = np.flatnonzero(owner == d)
                keep[rng.permutation(mine)[most[at + d] :]] = False
            order = np.argsort(passage, kind="stable")
            order = order[keep[passage[order]]]
            ids.append(own[order])
            counts.append(np.bincount(passage, minlength=len(owner))[keep])
            owners.append(owner[keep] + at)
        none = np.zeros(0, np.int32)
        self.counts, self.owner = np.concatenate([none, *counts]), np.concatenate([none, *owners])
        self.ids, filled = np.zeros(sum(map(len, ids)), np.int32), 0
        while ids:  # without a second copy of all
            part = ids.pop(0)
            self.ids[filled : filled + len(part)] = part
            filled += len(part)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.per_doc = np.maximum(np.diff(self.first), 1)

    def margins(self, weight: np.ndarray, bias: float) -> np.ndarray:
        out = np.zeros(len(self.owner))
        for at in range(0, len(out), 10_000):
            lengths = self.counts[at : at + 10_000]
            own = weight[self.ids[self.starts[at] : self.starts[at + len(lengths)]]]
            out[at : at + len(lengths)] = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=own, minlength=len(lengths))
        return out / np.maximum(self.counts, 1) + bias

    def top(self, margin: np.ndarray) -> np.ndarray:
        top = np.full(len(self.first) - 1, -np.inf)
        np.maximum.at(top, self.owner, margin)
        return top


def train(
    texts: list[str | None], labels: list[int], prior: float, seed: int = 11, toxic_passages: int = TOXIC_PASSAGES, clean_passages: int = CLEAN_PASSAGES
) -> Model:
    """Fit vectors and softmax jointly; ``prior`` is the share of toxic rows among all labelled ones.

    A passage has no label of its own. In the first epochs the passages of a document share its label, later the passage
    of highest margin stands for a toxic document; in a clean one all passages are clean, the one of highest margin counting most. A
    fifth of the rows is kept back to turn margins into probabilities. The other toxic rows and as many clean ones are also shown
    misspelt.
    """
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(y[0]) if len(y) else 0.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), share)
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for c in (0, 1):
        rows = rng.permutation(np.flatnonzero(y == c))
        held[rows[: len(rows) // 5]] = True
    checked, check_y = [texts[i] for i in np.flatnonzero(held)], y[held]
    spelt = np.concatenate([np.flatnonzero(~held & (y == 1)), np.flatnonzero(~held & (y == 0))[: int((~held & (y == 1)).sum())]])
    texts = [*(texts[i] for i in np.flatnonzero(~held)), *(_misspelt(texts[i] or "", rng) for i in spelt)]
    y = np.concatenate([y[~held], y[spelt]])
    clean_share = max(1, clean_passages // max(1, int((y == 0).sum())))
    bags = _Bags(texts, np.where(y == 1, toxic_passages, clean_share), rng)

    vectors = rng.normal(0, 0.05, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias, rate = 0.0, 0.25
    seen_vectors, seen_softmax = np.zeros(1 << BUCKET_BITS, np.float32), np.zeros_like(softmax)
    balance = np.where(y == 1, (y == 0).mean(), (y == 1).mean()) * 2
    owner = bags.owner
    for epoch in range(EPOCHS):
        share = 1 / bags.per_doc[owner]
        if epoch >= 3:
            margin = bags.margins(vectors @ (softmax[:, 1] - softmax[:, 0]), bias)
            share = np.where(margin >= bags.top(margin)[owner], 1.0, np.where(y[owner] == 1, 0.0, share))
        share = share * balance[owner]
        docs = rng.permutation(len(y))
        for part in np.array_split(docs, max(1, len(docs) // 128)):
            own = np.concatenate([np.arange(bags.first[d], bags.first[d + 1]) for d in part])
            own = own[share[own] > 0]
            if not len(own):
                continue
            lengths = bags.counts[own]
            take = np.repeat(bags.starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            local, grams = np.repeat(np.arange(len(own)), lengths), bags.ids[take]
            difference = softmax[:, 1] - softmax[:, 0]
            mean = np.maximum(lengths, 1)
            z = np.bincount(local, weights=(vectors @ difference)[grams], minlength=len(own)) / mean + bias
            delta = share[own] * (_sigmoid(z) - y[owner[own]]) / share[own].sum()
            pull = np.bincount(grams, weights=(delta / mean)[local], minlength=len(vectors)).astype(np.float32)
            touched = np.flatnonzero(pull)
            rows, pull = vectors[touched], pull[touched]
            toxic = rows.T @ pull
            to_softmax = np.column_stack([-toxic, toxic])
            seen_vectors[touched] += pull**2 * float(difference @ difference) / DIMENSIONS
            seen_softmax += to_softmax**2
            vectors[touched] -= (rate * pull / (np.sqrt(seen_vectors[touched]) + 1e-8))[:, None] * difference
            softmax -= 0.1 * to_softmax / (np.sqrt(seen_softmax) + 1e-8)
            bias -= 0.5 * float(delta.sum())
    weight = vectors @ (softmax[:, 1] - softmax[:, 0])
    model = Model(weight.astype(np.float32), bias, 1.0, 0.0, prior)
    if not len(check_y) or check_y.min() == check_y.max():
        checked, check_y = texts, y
    top = model.margins(checked)
    use = np.isfinite(top)
    share = check_y[use].mean()
    slope, model.intercept = _platt(top[use], check_y[use], np.where(check_y[use] == 1, prior / share, (1 - prior) / (1 - share)))
    model.slope = max(slope, 0.0)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    toxic_passages: int = TOXIC_PASSAGES,
    clean_passages: int = CLEAN_PASSAGES,
) -> Model:
    """Learn from at most ``max_toxic`` and ``max_clean`` labelled documents outside the held-out quarter, those of smallest id hash,
    and in training from at most ``toxic_passages`` of a toxic one and ``clean_passages`` of all clean ones together, in equal shares.

    The label is the only thing read of ``labels`` besides the id; null labels and ids are left out, and the share of toxic rows is
    taken from all others. Without labelled rows, or with one class only, every score is about that class's share (0 without labels).
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = None
    for y, most in ((1, max_toxic), (0, max_clean)):
        own = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        few = own if few is None else few.unionByName(own)
    # `few` has at most max_toxic + max_clean rows of two numbers
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(few), "id").orderBy("id", "y", F.xxhash64("text")).collect()
    total = counts.get(0, 0) + counts.get(1, 0)
    return train([r.text for r in rows], [r.y for r in rows], counts.get(1, 0) / total if total else 0.0, toxic_passages=toxic_passages, clean_passages=clean_passages)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text.

    Nothing but the text is an input of the score. A null or empty text, or one without a letter or digit, gets the share of toxic rows
    among the labelled. Null ids and repeated rows are scored as they are; other columns are not read.
    """
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), model.score(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
