"""Near-duplicates by SimHash and the generalised pigeonhole principle."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import dealt, forest_edges, groups
from .common import cut, fresh
from .components import components

BITS = 64
SEED = 42
BLOCK_BYTES = 1 << 20
#: Cost of a shuffled signature and of a compared pair, in microseconds; only their ratio matters.
ROW_COST, PAIR_COST = 1.0, 0.004
#: Groups up to this size are compared by shifting whole batches, larger ones one by one.
SMALL = 64

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = at + BLOCK_BYTES
        if end < len(text):
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=False)]
    return np.array(found, np.uint64)


def fingerprint(text: str | None, width: int) -> int:
    """The SimHash of a text's word shingles as an unsigned number; 0 without words.

    A-Z are lower-cased, words end at ASCII white space, repeated shingles count again. A text of fewer words than ``width``
    is one shingle. A bit is set if more than half of the XXH64 values have it.
    """
    total, counts, rest = 0, np.zeros(BITS, np.int64), []
    for block in _word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = rest + block
        if len(words) >= width:
            hashes = _hashes(words, width)
            for i in range(0, len(hashes), 1 << 15):
                part = hashes[i : i + (1 << 15)]
                counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashes)
            rest = words[len(words) - width + 1 :]
        else:
            rest = words
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(rest), SEED) if rest else 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint_of(text: Column, width: int) -> Column:
    """:func:`fingerprint` of a column as a signed long."""

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(batch, "long")(text.cast("string"))


def fingerprints(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row. A null text has no words."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint_of(F.col(text), width).alias("fp"))


# --- the plan: which bits form a part, and how many differing bits a part is probed with ---------------------------


def _bit_rows(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = 0, np.zeros((BITS, BITS))
    for batch in batches:
        fp = batch.column(0).to_numpy()
        for i in range(0, len(fp), 1 << 15):
            bits = _bit_rows(fp[i : i + (1 << 15)]).astype(np.float32)
            n, sums = n + len(bits), sums + bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "sums"])


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set: 64 x 64 numbers, whatever the input."""
    rows = fps.select("fp").mapInArrow(_bit_sums, "n long, sums array<double>")
    rows = rows.select("n", F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()
    sums = np.zeros(BITS * BITS)
    for row in rows:
        sums[row["at"]] = row["x"]
    return (int(rows[0]["n"]) if rows else 0), sums.reshape(BITS, BITS)


def _correlated_parts(n: int, sums: np.ndarray, m: int) -> list[list[int]]:
    """Bits in m parts of nearly equal width; a part grows by the bit most correlated with it."""
    p = np.diag(sums) / max(n, 1)
    cov = sums / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    strength = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, parts = set(range(BITS)), []
    for i in range(m):
        width = (BITS - sum(map(len, parts))) // (m - i)
        left = sorted(free)
        part = [left[int(np.argmax(strength[np.ix_(left, left)].sum(1)))]]
        free.discard(part[0])
        while len(part) < width:
            left = sorted(free)
            part.append(left[int(np.argmax(strength[np.ix_(left, part)].sum(1)))])
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def _within(agree: np.ndarray) -> np.ndarray:
    """Probability that 0, 1, 2 ... bits at most differ, for bits that agree with the given probabilities."""
    chance = np.array([1.0])
    for p in agree:
        chance = np.append(chance * p, 0) + np.append(0, chance * (1 - p))
    return np.cumsum(chance)


def plan_parts(n: int, sums: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Parts as (bits, threshold): fingerprints within ``distance`` agree in some part up to its threshold.

    If each part i differed in more than t_i bits, all would differ in sum(t_i + 1) bits at least; so the sum of
    t_i + 1 is distance + 1, and t_i = -1 leaves a part out. Dynamic programming finds the thresholds of least cost, the
    cost of a part being its probes and the candidates that they are expected to meet; this is done for each number of
    parts, and the cheapest plan is taken.
    """
    p = np.diag(sums) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    best = None
    for m in range(1, distance + 2):
        parts = _correlated_parts(n, sums, m)
        table = {0: (0.0, [])}  # sum of t_i + 1 so far: cost, thresholds
        for bits in parts:
            within, after = _within(agree[bits]), {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, min(distance - used, len(bits)) + 1):
                    probes = sum(math.comb(len(bits), k) for k in range(1, t + 1))
                    more = 0.0 if t < 0 else ROW_COST * (1 + probes) + PAIR_COST * n * float(within[t])
                    now = cost + more
                    if used + t + 1 not in after or now < after[used + t + 1][0]:
                        after[used + t + 1] = (now, [*chosen, t])
            table = after
        cost, chosen = table[distance + 1]
        if best is None or cost < best[0]:
            best = (cost, [(bits, t) for bits, t in zip(parts, chosen, strict=True) if t >= 0])
    return best[1]


# --- candidates and links --------------------------------------------------------------------------------------------


def _masks(width: int, t: int) -> np.ndarray:
    """All numbers of ``width`` bits with 1 to t bits set."""
    layers, found = [np.array([0], np.int64)], []
    tops = [np.array([-1])]
    for _ in range(t):
        base, top = layers[-1], tops[-1]
        pairs = [(b | (1 << k), k) for b, h in zip(base.tolist(), top.tolist(), strict=True) for k in range(h + 1, width)]
        layers.append(np.array([x for x, _ in pairs], np.int64))
        tops.append(np.array([k for _, k in pairs]))
        found.append(layers[-1])
    return np.concatenate(found) if found else np.array([], np.int64)


def _signature_batches(batches: Iterator[pa.RecordBatch], parts: list) -> Iterator[pa.RecordBatch]:
    masks = [_masks(len(bits), t) for bits, t in parts]
    step = max(1, (1 << 17) // max(1, max(map(len, masks))))
    for batch in batches:
        all_fp = batch.column(0).to_numpy()
        for i in range(0, len(all_fp), step):
            fp = all_fp[i : i + step]
            bits = _bit_rows(np.ascontiguousarray(fp)).astype(np.int64)
            for k, (own, _) in enumerate(parts):
                value = bits[:, own] @ (1 << np.arange(len(own), dtype=np.int64))
                near = (value[:, None] ^ masks[k][None, :]).ravel()
                values = np.concatenate([value, near])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), k, np.int32)), pa.array(values), pa.array(np.concatenate([fp, np.repeat(fp, len(masks[k]))])), pa.array(np.arange(len(values)) >= len(value))],
                    names=["part", "value", "fp", "probe"],
                )


_PAIR_KEYS = ["part", "value", "ci", "cj"]


def _shifted_pairs(fp: np.ndarray, probe: np.ndarray, group: np.ndarray, largest: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = [], []
    for lag in range(1, largest):
        at = np.flatnonzero((group[lag:] == group[:-lag]) & ~(probe[lag:] & probe[:-lag]))
        at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        a.append(fp[at])
        b.append(fp[at + lag])
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _link_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch, starts in groups(batches, _PAIR_KEYS):
        sizes = np.diff(starts)
        fp = batch.column("fp").to_numpy().view(np.uint64)
        probe = batch.column("probe").to_numpy(zero_copy_only=False)
        chunk = batch.column("c").to_numpy()
        paired = batch.column("ci").to_numpy() != batch.column("cj").to_numpy()
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes) & ~paired
        at = np.flatnonzero(small)
        if len(at):
            group = np.repeat(np.arange(len(sizes)), sizes)[at]
            a, b = _shifted_pairs(fp[at], probe[at], group, int(sizes[sizes <= SMALL].max()), distance)
            unlike = a != b
            yield out(a[unlike], b[unlike])
        for g in np.flatnonzero((sizes > SMALL) | paired[starts[:-1]]):
            rows = slice(starts[g], starts[g + 1])
            x, p, c = fp[rows], probe[rows], chunk[rows]

            def near(left: np.ndarray, right: np.ndarray, x=x, p=p) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for one, two in ((left, right), (right, left)) if left is not right else ((left, right),):
                    one = one[~p[one]]  # an indexed fingerprint against all
                    for i in range(0, len(one), 256):
                        r, s = np.nonzero(np.bitwise_count(x[one[i : i + 256], None] ^ x[two][None, :]) <= distance)
                        yield one[i + r], two[s]

            a, b = forest_edges(len(x), c, near)
            unlike = x[a] != x[b]
            yield out(x[a][unlike], x[b][unlike])


def fingerprint_links(fps: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: links that connect all distinct fingerprints within ``distance`` bits, and no others.

    Within a bucket, a link that others already imply may be missing; which fingerprints are connected is exact.
    """
    n, sums = bit_statistics(fps)
    parts = plan_parts(n, sums, distance)
    rows = fps.select("fp").mapInArrow(partial(_signature_batches, parts=parts), "part int, value long, fp long, probe boolean")
    return dealt(rows, ["part", "value"], "fp").mapInArrow(partial(_link_batches, distance=distance), "a long, b long")


def _components_of(marked: DataFrame, distance: int) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint of ``(doc_id, fp)``."""
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(fingerprint_links(classes, distance))
    linked = cut(classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    return linked.join(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, where documents whose fingerprints differ in at most ``distance`` bits link.

    ``component_id`` is the smallest id that links reach. Copies fall together as one fingerprint before anything is
    compared. A null text has no words and fingerprint 0, as an empty one; those link like any others. Rows with a null id
    are kept and can link others; ``component_id`` is null where no member has an id. Repeated rows each give a row. Other columns are
    not read. An empty table gives no rows.
    """
    marked = cut(fingerprints(docs, width, doc_id, text))
    return marked.join(_components_of(marked, distance), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, width: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each group the one with the smallest id stays, with all its columns.

    Where an id repeats with different texts, each of its groups keeps its own row. Of rows of one group that repeat its smallest id one
    stays, and one row of a group in which no row has an id.
    """
    marked = cut(fingerprints(docs, width, doc_id, text))
    found = cut(_components_of(marked, distance))
    first = F.col("doc_id") == F.col("component_id")
    named = marked.join(found, "fp").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.when(first, 1)).alias("n_first"), F.count(F.lit(1)).alias("n"))
    keep = cut(named.where("n_first > 0").select("doc_id", "n"))

    def of(ids: DataFrame) -> DataFrame:
        # The kept ids grow with the input, so the join is a shuffle at every size; it builds on the ids and sorts no texts.
        return docs.join(ids.select(F.col("doc_id").alias(doc_id)).hint("shuffle_hash"), doc_id, "left_semi").select(*docs.columns)

    stay = of(keep.where("n = 1"))
    fp, root, least = (fresh(docs, name) for name in ("fp", "root", "component_id"))
    if keep.where("n > 1").limit(1).count():
        # The id alone doesn't say which row it is, so the row's own fingerprint does.
        rows = of(keep.where("n > 1")).withColumn(fp, fingerprint_of(F.col(text), width))
        rows = rows.join(found.select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(least)), fp)
        stay = stay.unionByName(rows.where(F.col(doc_id).cast("long") == F.col(least)).dropDuplicates([root]).select(*docs.columns))
    if marked.where("doc_id IS NULL").limit(1).count():
        nameless = docs.where(F.col(doc_id).isNull()).withColumn(fp, fingerprint_of(F.col(text), width))
        nameless = nameless.join(found.where("component_id IS NULL").select(F.col("fp").alias(fp), F.col("root").alias(root)), fp)
        stay = stay.unionByName(nameless.dropDuplicates([root]).select(*docs.columns))
    return stay
