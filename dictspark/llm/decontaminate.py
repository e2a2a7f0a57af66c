"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity.

Everything is Spark expressions. A document's shingles are hashed once and joined with those of the benchmark; only places are gathered.
Every window of an item's size that holds enough shared shingles to be similar gets a SimHash, meets the items whose
fingerprint is within the radius by blocks of bits, and is compared with them shingle by shingle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

WIDTH = 5
SIMILARITY = 0.8
#: 8 blocks, each probed within 2 bits: to be missed, all would have to differ in 3 bits, 24 together.
RADIUS, BLOCKS = 23, 8
#: Rows up to which the benchmark's tables (10 rows of about 40 bytes for each shingle), or the places where windows begin, may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Parts that a shingle's documents are dealt into when joined by shuffle, since some shingles are in very many.
SALTS = 16


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.array_remove(F.split(spaced, " "), "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, repeats included; none for fewer words."""
    at = F.sequence(F.lit(0), F.size(words) - width)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, hashed).otherwise(F.array().cast("array<long>"))


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, the value being computed once however often it is named."""
    return F.transform(F.array(value), lambda x: of(x))[0]


def simhash_sql(hashes: str) -> str:
    """SQL for the bits that more than half of the hashes in an array (a name) have. Counters share a long: four of 16 bits, or two of 32 for more hashes than these count.

    As text, since it has more parts than are built quickly one by one.
    """

    def majority(lane: int) -> str:
        lanes, bits = _signed(sum(1 << at for at in range(0, 64, lane))), []
        for shift in range(lane):
            counts = f"aggregate({hashes}, 0L, (acc, x) -> acc + (shiftrightunsigned(x, {shift}) & {lanes}L))"
            held = [f"CASE WHEN (shiftrightunsigned(p, {at}) & {(1 << lane) - 1}L) * 2 > size({hashes}) THEN {_signed(1 << (shift + at))}L ELSE 0L END" for at in range(0, 64, lane)]
            bits.append(f"transform(array({counts}), p -> {' | '.join(held)})[0]")
        return " | ".join(bits)

    return f"CASE WHEN size({hashes}) < {1 << 16} THEN {majority(16)} ELSE {majority(32)} END"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Items with their width (5, or all words of a shorter item), number of words, shingle hashes and SimHash."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("width", F.least(F.size("words"), F.lit(WIDTH)))
    hashes = F.array().cast("array<long>")
    for width in range(WIDTH, 0, -1):
        hashes = F.when(F.col("width") == width, shingles_of(F.col("words"), width)).otherwise(hashes)
    rows = rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "width", F.size("words").alias("n_words"), hashes.alias("hashes"))
    return rows.withColumn("item_simhash", F.expr(simhash_sql("hashes")))


def _block(fingerprint: Column, block: int, blocks: int) -> Column:
    width = 64 // blocks
    return F.shiftrightunsigned(fingerprint, block * width).bitwiseAND(F.lit((1 << width) - 1))


def _masks(bits: int, width: int) -> list[int]:
    """Numbers of ``width`` bits with ``bits`` of them set at most."""
    return [sum(1 << b for b in own) for k in range(bits + 1) for own in combinations(range(width), k)]


def _probes(fingerprint: Column, within: int, blocks: int) -> Column:
    """``(block, value)`` of all values within so many bits of the fingerprint's own, for each block of bits."""
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(within, 64 // blocks)])

    def of(block: int) -> Column:
        return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), _block(fingerprint, block, blocks).bitwiseXOR(m).alias("value")))

    return F.flatten(F.array(*[of(b) for b in range(blocks)]))


def _counts(hashes: Column) -> Column:
    """Repeats told apart: the k-th copy of a hash becomes the pair (hash, k), so that sets of pairs compare as bags."""
    ordered = F.array_sort(hashes)
    first = lambda h: F.call_function("array_position", ordered, h).cast("int")
    return F.transform(ordered, lambda h, i: F.struct(h.alias("h"), (i - first(h)).alias("k")))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger shingle counts."""
    shared = F.size(F.array_intersect(_counts(a), _counts(b)))
    return shared / (F.size(a) + F.size(b) - shared)


_RANGES = "array<struct<low:int,high:int>>"


def _ranges(at: Column, n: Column, need: Column) -> Column:
    """The starts of all windows of ``n`` places that hold ``need`` of the sorted places ``at`` or more, as ranges without overlap.

    A window holds ``need`` places from the k-th on if it begins there or before and ends at or after the last of them. Starts
    up to the place before the k-th are in earlier ranges.
    """

    def of(k: Column) -> Column:
        low = F.get(at, k + need - 1) - n + 1
        return F.struct(F.when(k > 0, F.greatest(low, F.get(at, k - 1) + 1)).otherwise(low).alias("low"), F.get(at, k).alias("high"))

    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(at) - need), of), lambda r: r["low"] <= r["high"])
    return F.when(F.size(at) >= need, found).otherwise(F.array().cast(_RANGES))


def _clipped(ranges: Column, low: Column, high: Column) -> Column:
    cut_ = F.transform(ranges, lambda r: F.struct(F.greatest(r["low"], low).alias("low"), F.least(r["high"], high).alias("high")))
    return F.filter(cut_, lambda r: r["low"] <= r["high"])


def window_starts(at: Column, n: Column, size: Column, similarity: float) -> Column:
    """Ranges of the starts of windows of ``n`` shingles, in a document of ``size``, that may be alike by ``similarity``; ``at`` are the sorted places of shared shingles.

    Bags of n and m shingles that share x are alike by x / (n + m - x). A whole window has m = n, so that x must be 2 n s / (1 + s) at least; one that
    the document's ends clip is shorter, and x must still be n s at least.
    """
    whole, part = (F.greatest(F.ceil(n * share - 1e-6), F.lit(1)).cast("int") for share in (2 * similarity / (1 + similarity), similarity))
    zero, last = F.lit(0), size - n
    few = _ranges(at, n, part)
    ends = F.concat(_clipped(few, 1 - n, F.lit(-1)), _clipped(few, F.greatest(zero, last + 1), size - 1))
    return F.concat(_clipped(_ranges(at, n, whole), zero, last), ends)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    row_id: str | None = None,
) -> DataFrame:
    """``doc_id, item_id, start, n_words, similarity``: for every contaminated document and item its most similar window.

    A window has as many shingles as an item (fewer at the ends of a document) and may begin anywhere. Its
    SimHash must lie within ``radius`` bits of that of an item of this size, which
    blocks of bits guarantee to find, and the counts of shingles must be alike by ``similarity`` or more. Shingles have five words; an
    item of fewer words is one shingle. Of equally similar windows the first is given. Documents with a null id appear with it, rows that
    repeat an id and a match appear once, items without words match nothing, null texts have no words. With ``row_id`` (a column of
    ``docs``) rows are told apart by it and it is returned, too. Empty tables give no rows. Other columns are not read.

    Two passes over the documents. In the first the places of shingles that an item has, too, are gathered by document and item; windows that
    hold too few of them for the similarity can't match, all others are looked at (``window_starts``), in the few documents that have any. The
    benchmark's shingles, and the starts, are broadcast if they are at most BROADCAST_ROWS, counted before; else they are joined by
    shuffle, a frequent shingle in SALTS parts. Places are known by a 64-bit hash of the row: rows that share it
    only look at more windows.
    """
    if 64 % blocks:
        raise ValueError(f"64 bits can't be cut into {blocks} blocks")
    items = cut(_items(benchmark, item_id, item_text))
    within = math.ceil((radius + 1) / blocks) - 1
    sized = items.select("item", "width", "n_words", F.size("hashes").alias("n"), F.explode(F.array_distinct("hashes")).alias("hash"))
    seeds = cut(sized)
    small = seeds.count() <= BROADCAST_ROWS
    bounded = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    row = F.col(row_id) if row_id else F.lit(None).cast("long")
    texts = docs.select(F.col(doc_id).alias("doc_id"), row.alias("row_id"), F.col(text).cast("string").alias("text"))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "row_id", "text"))
    places = None
    widths = sorted(r.width for r in items.select("width").distinct().collect())  # 5 values at most
    for width in widths:
        own = seeds.where(F.col("width") == width)
        # the outer form: the other makes Spark hash all shingles in a filter beforehand
        hashed = texts.select("key", words_of(F.col("text")).alias("words")).select("key", shingles_of(F.col("words"), width).alias("shingles"))
        placed = hashed.select("key", F.size("shingles").alias("size"), F.posexplode_outer("shingles").alias("pos", "hash"))
        on = ["hash"]
        if not small:
            own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            placed = placed.withColumn("salt", F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int"))
            on = ["hash", "salt"]
        hits = placed.join(bounded(own), on).select("key", "width", "n_words", "n", "item", "size", "pos")
        places = hits if places is None else places.unionByName(hits)
    if places is None:
        out = texts.limit(0).select("doc_id", "row_id", F.lit(None).cast(benchmark.schema[item_id].dataType).alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0.0).alias("similarity"))
        return out if row_id else out.drop("row_id")
    gathered = places.groupBy("key", "width", "n_words", "n", "item", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    begun = gathered.withColumn("ranges", window_starts(F.col("at"), F.col("n"), F.col("size"), similarity)).where(F.size("ranges") > 0)
    # items of one size share their windows
    begun = cut(begun.groupBy("key", "width", "n_words", "n", "size").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ranges")))).alias("ranges")))
    few = (begun.agg(F.sum(F.size("ranges"))).first()[0] or 0) <= BROADCAST_ROWS

    found = None
    for width in widths:
        own = begun.where(F.col("width") == width)
        held = texts.join(F.broadcast(own) if few else own, "key").withColumn("words", words_of(F.col("text")))
        held = held.withColumn("shingles", shingles_of(F.col("words"), width))
        starts = F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["low"], r["high"]))))
        bounds = F.array_distinct(F.transform(starts, lambda s: F.struct(F.greatest(s, F.lit(0)).alias("start"), F.least(s + F.col("n"), F.col("size")).alias("stop"))))
        held = held.select("doc_id", "row_id", "width", "n_words", "shingles", bounds.alias("bounds"))
        # of the shingles only those from the first to the last window are kept
        first, stop = F.array_min(F.transform("bounds", lambda w: w["start"])), F.array_max(F.transform("bounds", lambda w: w["stop"]))
        held = held.withColumns({"first": first, "region": F.slice("shingles", first + 1, stop - first)})

        window = "slice(region, w.start - first + 1, w.stop - w.start)"
        marked = F.expr(f"transform(bounds, w -> transform(array({window}), h -> named_struct('start', w.start, 'stop', w.stop, 'simhash', {simhash_sql('h')}))[0])")
        windows = held.select("doc_id", "row_id", "width", "n_words", "first", "region", marked.alias("windows"))
        found = windows if found is None else found.unionByName(windows)
    found = cut(found)  # the plan starts anew from the documents that have windows
    found = found.select("*", F.explode("windows").alias("w")).select("*", "w.start", "w.stop", "w.simhash").drop("w", "windows")
    own_blocks = F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("simhash"), b, blocks).alias("value")) for b in range(blocks)])
    met = found.select("*", F.explode(own_blocks).alias("own")).select("*", "own.block", "own.value").drop("own")
    probes = items.select("item", "width", "n_words", "item_simhash", F.explode(_probes(F.col("item_simhash"), within, blocks)).alias("probe"))
    probes = probes.select("item", "width", "n_words", "item_simhash", "probe.block", "probe.value")
    met = met.join(bounded(probes), ["width", "n_words", "block", "value"])
    differ = F.col("simhash").bitwiseXOR(F.col("item_simhash"))
    # a pair that meets in several blocks counts in the first
    first = F.coalesce(*[F.when(F.bit_count(_block(differ, b, blocks)) <= within, F.lit(b)) for b in range(blocks)])
    met = met.where((F.bit_count(differ) <= radius) & (F.col("block") == first))
    compared = met.join(bounded(items.select("item", "item_id", "hashes")), "item")
    window = F.slice("region", F.col("start") - F.col("first") + 1, F.col("stop") - F.col("start"))
    compared = compared.withColumn("similarity", _once(window, lambda h: weighted_similarity(h, F.col("hashes")))).where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("item_id", "start", "n_words", "similarity"), F.struct(F.col("similarity"), (-F.col("start")).alias("place"))).alias("best")
    grouped = compared.groupBy("doc_id", "row_id", "item").agg(best)
    return grouped.select("doc_id", *(["row_id"] if row_id else []), "best.item_id", "best.start", "best.n_words", "best.similarity")


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that match no item, with all their columns. Rows are told apart by the MD5 of their text: one whose text matches goes, whatever its id."""
    key = fresh(docs, "text_key")
    marked = docs.withColumn(key, F.md5(F.col(text).cast("string")))
    found = cut(matches(marked, benchmark, doc_id=doc_id, text=text, row_id=key, **options).select(F.col("row_id").alias(key)).distinct())
    return marked.join(found, key, "left_anti").select(*docs.columns)
