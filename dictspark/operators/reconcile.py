"""Comparing two tables: multiset difference, keyed difference, digests of parts, order-free fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bounded import hex_slice, row_text


def _sided(a: DataFrame, b: DataFrame) -> DataFrame:
    if a.columns != b.columns:
        raise ValueError(f"the tables differ in columns: {a.columns} and {b.columns}")
    left = a.withColumns({"_a": F.lit(1), "_b": F.lit(0)})
    right = b.withColumns({"_a": F.lit(0), "_b": F.lit(1)})
    return left.unionByName(right)


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both directions of the multiset difference with ``side`` and ``n``.

    One aggregation answers both directions: rows cancel on the map side and one shuffle
    carries each distinct row once, where two EXCEPT ALL would shuffle both tables twice.
    """
    rows = _sided(a, b).groupBy(*a.columns).agg((F.sum("_a") - F.sum("_b")).alias("_d")).where("_d <> 0")
    side = F.when(F.col("_d") > 0, F.lit("extra")).otherwise(F.lit("missing"))
    return rows.select(*a.columns, side.alias("side"), F.abs("_d").alias("n"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``extra`` rows of a, ``missing`` rows of b, ``different`` rows matched by key.

    ``different`` counts keys held once on each side with unequal values; keys held more than
    once on a side cannot be paired and are counted as ``ambiguous``.
    """
    rows = _sided(a, b).groupBy(*a.columns).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    surplus = F.greatest(F.col("na") - F.col("nb"), F.lit(0))
    deficit = F.greatest(F.col("nb") - F.col("na"), F.lit(0))
    by_key = rows.groupBy(*keys).agg(
        F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum(surplus).alias("extra"), F.sum(deficit).alias("missing")
    )
    paired = (F.col("na") == 1) & (F.col("nb") == 1)
    return by_key.agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.count_if(paired & (F.col("extra") == 1)).alias("different"),
        F.count_if((F.col("na") > 1) | (F.col("nb") > 1)).alias("ambiguous"),
    )


def differing_columns(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held once on each side whose other columns differ, with the names of those columns."""
    others = [c for c in a.columns if c not in keys]
    image = F.struct(*others)
    paired = (
        _sided(a, b)
        .groupBy(*keys)
        .agg(
            F.sum("_a").alias("na"),
            F.sum("_b").alias("nb"),
            F.max(F.when(F.col("_a") == 1, image)).alias("a"),
            F.max(F.when(F.col("_b") == 1, image)).alias("b"),
        )
        .where("na = 1 AND nb = 1")
    )
    names = F.concat_ws(",", *[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in others])
    return paired.select(*keys, names.alias("columns")).where(F.col("columns") != "")


PARTS = 65_536


def unequal_parts(a: DataFrame, b: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """The parts of two tables, dealt by the hash of ``keys``, that do not hold the same rows: ``part``.

    Of each side and part a count and two sums of row hashes are compared, NULL being told from any value and place. Partial
    sums combine on the map side, so the shuffle carries at most one row a part and task, whatever the size of the tables.
    Unequal parts of equal count and sums would take a collision in two independent 64-bit hashes at once.
    """
    if parts < 1:
        raise ValueError("a table has one part at least")
    cells = [F.col(c) for c in a.columns]
    nulls = [c.isNull() for c in cells]
    part = _part(keys, parts).alias("part")
    sides = _sided(a, b).select(part, (F.col("_a") - F.col("_b")).alias("sign"), F.xxhash64(*cells, *nulls).alias("h"), F.xxhash64(F.lit(1), *nulls, *cells).alias("g"))
    sums = [F.sum(F.col("sign")).alias("n"), *[F.sum(F.col("sign") * F.col(c).cast("decimal(20,0)")).alias(c) for c in ("h", "g")]]
    return sides.groupBy("part").agg(*sums).where("n <> 0 OR h <> 0 OR g <> 0").select("part")


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(parts))


def narrow(a: DataFrame, b: DataFrame, keys: Sequence[str], parts: int = PARTS) -> tuple[DataFrame, DataFrame]:
    """Both tables without the parts that are equal on both sides, for comparing large tables with few changes.

    The tables are read twice, but only rows of unequal parts are shuffled. :func:`except_all`, :func:`differing_columns` and the
    changes between snapshots with unique keys are the same as those of the whole tables; keys that are repeated alike on both sides
    stand in equal parts, so the ``ambiguous`` of :func:`reconcile` counts those of unequal parts only. The list of unequal parts
    holds at most ``parts`` numbers; it is written once, so both sides take the same, and joined as its measured size allows.
    """
    unequal = cut_lineage(unequal_parts(a, b, keys, parts))
    kept = [df.withColumn("_part", _part(keys, parts)).join(unequal.withColumnRenamed("part", "_part"), "_part", "left_semi").select(*df.columns) for df in (a, b)]
    return kept[0], kept[1]


def _hashed(columns: Sequence[Column], algorithm: str) -> Column:
    if algorithm == "xxhash64":
        return F.xxhash64(*columns)
    if algorithm == "md5":
        return F.md5(row_text(columns))
    raise ValueError("algorithm must be 'xxhash64' or 'md5'")


def _digest(hashed: Column, algorithm: str) -> list[Column]:
    """Aggregates that neither order nor partitioning changes."""
    if algorithm == "xxhash64":
        return [F.sum(hashed.cast("decimal(20,0)")).cast("string").alias("digest"), F.bit_xor(hashed).cast("string").alias("digest2")]
    parts = [hex_slice(hashed, start).cast("decimal(19,0)") for start in (1, 16)]
    return [F.sum(part).cast("string").alias(name) for part, name in zip(parts, ("digest", "digest2"))]


def fingerprint(df: DataFrame, by: Sequence[str] = (), algorithm: str = "xxhash64") -> DataFrame:
    """Row count and digest of a table, or of each group of ``by``.

    Row hashes are summed, so a group is never listed or sorted: partial sums combine on the
    map side and a group of any size costs one row per input partition in the shuffle.
    ``md5`` digests can be recomputed by other engines; ``xxhash64`` is faster.
    """
    rest = [F.col(c) for c in df.columns if c not in by]
    rows = df.select(*by, _hashed(rest, algorithm).alias("_hash"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_digest(F.col("_hash"), algorithm))
