"""Typed table scans with projection, filter, limit and bounded parallelism."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import Field, data_fields
from .dictionary import as_fields
from .extract import LINE, decode_extract
from .files import table_bytes
from .layouts import DEFAULT_DELIMITER

KEPT = "_line"
LINES_PER_TASK = 1000
#: Bytes of files that one task of a scan with ``threads`` reads at most, about.
TASK_BYTES = 256_000_000


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Unknown columns are an error while planning, naming what exists."""
    _require(df.columns, columns)


def _require(known: Sequence[str], columns: Sequence[str]) -> None:
    unknown = [c for c in columns if c not in known]
    if unknown:
        raise ValueError(f"unknown column(s) {', '.join(unknown)}; the table has {', '.join(known)}")


def shape_scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    filter: str | Column | None = None,
    max_rows: int = 0,
    threads: int = 0,
    sorted_by_key: Sequence[str] = (),
) -> DataFrame:
    """Apply the scan options to a typed DataFrame.

    The filter sees every column of the table; the projection follows it, so Catalyst pushes
    both into the file scan. ``threads`` merges input splits without a shuffle into so many tasks, or into
    as many as it takes for none of them to read more than :data:`TASK_BYTES`.
    """
    if max_rows < 0 or threads < 0:
        raise ValueError("max_rows and threads must not be negative")
    if threads:
        df = df.coalesce(max(threads, -(-table_bytes(df) // TASK_BYTES)))
    if filter is not None:
        df = df.where(F.expr(filter) if isinstance(filter, str) else filter)
    if sorted_by_key:
        require_columns(df, sorted_by_key)
        df = df.orderBy(*sorted_by_key)
    if max_rows:
        df = df.limit(max_rows)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*columns)
    return df


def _first_files(lines: DataFrame, max_rows: int) -> DataFrame:
    """The lines of the first files that hold ``max_rows`` of them, found by counting 1, 4, 16, ... files up to that number.

    A limit inside a plan is taken of every split before it is taken of all, so every split of a large table would be
    read and write ``max_rows`` lines. Folders with partition columns, and names that read as globs, are left whole.
    """
    files = sorted(unquote(f) for f in lines.inputFiles())
    if lines.columns != [LINE] or any(set(f) & set("*?[]{}\\") for f in files):
        return lines
    taken = 1
    while taken < len(files):
        some = lines.sparkSession.read.text(files[:taken]).withColumnRenamed("value", LINE)
        if some.limit(max_rows).count() == max_rows:
            return some
        taken *= 4
    return lines


def _first_lines(lines: DataFrame, decode_keys: Callable[[DataFrame], DataFrame], max_rows: int, sorted_by_key: Sequence[str]) -> DataFrame:
    """The lines a limit keeps, chosen before any cell but the keys is decoded, or one behind them cut out."""
    # a limit leaves one partition; many lines are decoded by all cores
    tasks = lines.sparkSession.sparkContext.defaultParallelism if max_rows > LINES_PER_TASK else 1
    if sorted_by_key:
        keyed = decode_keys(lines.withColumn(KEPT, F.col(LINE)))
        # a projection would be moved below the limit, which then sorts and shuffles all lines; it stays above the exchange of those that are kept
        kept = keyed.select(KEPT, *sorted_by_key).orderBy(*sorted_by_key).limit(max_rows)
        return kept.repartition(tasks).select(F.col(KEPT).alias(LINE))
    first = _first_files(lines, max_rows).limit(max_rows)
    return first.repartition(tasks) if tasks > 1 else first


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    filter: str | Column | None = None,
    max_rows: int = 0,
    threads: int = 0,
    sorted_by_key: Sequence[str] = (),
    layout: str | None = None,
    fields: DataFrame | Sequence[Field] | None = None,
    delimiter: str = DEFAULT_DELIMITER,
    strict: bool = False,
    whole: bool = False,
) -> DataFrame:
    """One dictionary table: parquet files, or text lines when a ``layout`` is given. ``whole`` as in :func:`decode_extract`."""
    if layout is None:
        return shape_scan(spark.read.parquet(path), columns, filter, max_rows, threads, sorted_by_key)
    if fields is None:
        raise ValueError("a text extract needs its dictionary fields")
    known = as_fields(fields)

    def decode(lines: DataFrame) -> DataFrame:
        return decode_extract(lines, known, layout, delimiter, strict, whole=whole)

    def decode_keys(lines: DataFrame) -> DataFrame:
        cells = data_fields(known)
        names = [f.name for f in cells]
        _require(names, sorted_by_key)
        last = max(names.index(c) for c in sorted_by_key)
        return decode_extract(lines, cells[: last + 1], layout, delimiter, strict, begin=True)

    lines = spark.read.text(path).withColumnRenamed("value", LINE)
    if max_rows > 0 and filter is None:
        lines = _first_lines(lines, decode_keys, max_rows, sorted_by_key)
        return shape_scan(decode(lines), columns, threads=threads, sorted_by_key=sorted_by_key)
    return shape_scan(decode(lines), columns, filter, max_rows, threads, sorted_by_key)
