"""Replication in batches: full snapshots, deltas with a pointer per subscriber, applying changes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.selection import select_options
from ..sources.reader import require_columns, shape_scan
from .reconcile import _sided
from .versions import latest, one_per_key

# Change modes, cursor states, results of closing a cursor, default read parallelism.
UPSERT, DELETE = "U", "D"
MODE = "change_mode"
OPEN, SHUT, DROPPED = "OPEN", "CLOSED", "DROPPED"
CLOSED, NOT_FOUND = "CLOSED", "NOT_FOUND"
FULL_THREADS = 5

REGISTRY = (
    "seq bigint, context string, object string, subscriber_type string, subscriber_name string, subscriber_process string, "
    "queue_name string, subscription_id string, prev_pointer string, pointer string, status string, columns string, filters string"
)
SUBSCRIBER = ("context", "object", "subscriber_name", "subscriber_process")


@dataclass(frozen=True)
class Source:
    """A replicated object: its rows, keys, and the timestamp column that orders its changes."""

    context: str
    name: str
    df: DataFrame
    keys: tuple[str, ...]
    change_column: str = ""

    @property
    def supports_delta(self) -> bool:
        return bool(self.change_column)

    @property
    def change(self) -> Column:
        return F.col(self.change_column)


def _selected(df: DataFrame, columns: Sequence[str] | None, filters: Sequence[Mapping[str, str]]) -> DataFrame:
    if filters:
        df = select_options(df, filters)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*columns)
    return df


def read_full(source: Source, columns: Sequence[str] | None = None, filters: Sequence[Mapping[str, str]] = (), threads: int = 0) -> DataFrame:
    """A complete one-shot read. Spark sizes the parallelism unless ``threads`` bounds it."""
    return _selected(shape_scan(source.df, threads=threads), columns, filters)


def preview(source: Source, max_rows: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The first rows by key, without a subscription."""
    return shape_scan(source.df, columns, max_rows=max_rows, sorted_by_key=source.keys)


def last_modified(source: Source) -> DataFrame:
    """``last_modified`` as DECIMAL(21,7) ``YYYYMMDDHHMMSS.fffffff``, comparable to a pointer."""
    if not source.supports_delta:
        raise ValueError(f"{source.name!r} does not track changes")
    stamp = F.max(source.change)
    return source.df.agg(F.lit(source.name).alias("object"), pointer_number(stamp).alias("last_modified"))


def pointer_text(stamp: Column) -> Column:
    return stamp.cast("timestamp_ntz").cast("string")


def pointer_number(stamp: Column) -> Column:
    text = pointer_text(stamp)
    return F.concat(F.translate(F.substring(text, 1, 19), "-: ", ""), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0")).cast("decimal(21,7)")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], emit_deletes: bool = False) -> DataFrame:
    """Changes from one snapshot to the next: after-images ``U`` and, if asked, ``D`` for rows gone.

    Both snapshots meet in one aggregation per key. A key that a snapshot repeats has no one image and is an error.
    """
    others = [c for c in old.columns if c not in keys]
    image = F.struct(*others)
    sides = _sided(old, new.select(*old.columns)).groupBy(*keys).agg(
        F.max(F.when(F.col("_a") == 1, image)).alias("a"),
        F.max(F.when(F.col("_b") == 1, image)).alias("b"),
        F.greatest(F.count(F.when(F.col("_a") == 1, 1)), F.count(F.when(F.col("_b") == 1, 1))).alias("_rows"),
    )
    changed = F.col("b").isNotNull() & ~F.col("a").eqNullSafe(F.col("b"))
    gone = F.col("b").isNull()
    repeated = F.raise_error(F.concat(F.lit("a snapshot repeats the key "), F.to_json(F.struct(*keys))))
    mode = F.when(F.col("_rows") > 1, repeated).when(changed, F.lit(UPSERT)).when(gone & F.lit(emit_deletes), F.lit(DELETE))
    rows = sides.select(*keys, F.coalesce("b", "a").alias("row"), mode.alias(MODE)).where(F.col(MODE).isNotNull())
    return rows.select(*keys, *[F.col(f"row.{c}").alias(c) for c in others], MODE).select(*old.columns, MODE)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The target after the last change of each key: images replaced or added, deletes removed."""
    if order:
        changes = latest(changes, keys, order)
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    images = changes.where(F.col(MODE) != DELETE) if MODE in changes.columns else changes
    return kept.unionByName(images.select(*target.columns))


@dataclass
class Replicator:
    """Subscriptions and their pointers, kept as appended rows in a shared folder.

    A pointer is the timestamp of the last change delivered; a delta is everything from the previous to the
    current one, both included. One subscriber process must not run twice at the same time.
    """

    spark: SparkSession
    store: str
    subscriber_name: str = "dictspark"
    _path: str = field(init=False)

    def __post_init__(self) -> None:
        self._path = f"{self.store.rstrip('/')}/registry"
        self.spark.createDataFrame([], REGISTRY).write.mode("append").parquet(self._path)

    # --- registry ------------------------------------------------------------------------------

    def _log(self) -> DataFrame:
        return self.spark.read.schema(REGISTRY).parquet(self._path)

    def _current(self) -> DataFrame:
        return one_per_key(self._log(), SUBSCRIBER, [F.col("seq")], smallest=False)

    def _state(self, context: str, name: str, process: str) -> dict | None:
        """The last registry row of one subscriber: a single control record."""
        mine = (
            (F.col("context") == context)
            & (F.col("object") == name)
            & (F.col("subscriber_name") == self.subscriber_name)
            & (F.col("subscriber_process") == process)
        )
        row = self._log().where(mine).orderBy(F.desc("seq")).first()
        return row.asDict() if row else None

    def _append(self, state: dict) -> None:
        state = {**state, "seq": (state.get("seq") or 0) + 1}
        self.spark.createDataFrame([state], REGISTRY).coalesce(1).write.mode("append").parquet(self._path)

    # --- reads ---------------------------------------------------------------------------------

    def read_delta(
        self,
        source: Source,
        process: str,
        columns: Sequence[str] | None = None,
        filters: Sequence[Mapping[str, str]] = (),
        recover: bool = False,
        change_mode: bool = False,
    ) -> DataFrame:
        """Changes since the subscriber's last read; the whole object on the first, rows without a stamp included.

        A delta begins with the stamp the last one ended with: rows of that stamp may have come later, so those
        that were there before are delivered again. Rows are after-images, to be applied by key; with
        ``change_mode`` they carry the mode ``U``. The pointer never moves back. ``recover`` delivers the
        last range again with the selection it was opened with and leaves the pointer alone.
        """
        if not source.supports_delta:
            raise ValueError(f"{source.name!r} does not support deltas")
        state = self._state(source.context, source.name, process)
        if state and state["status"] == DROPPED:
            state = {"seq": state["seq"]}
        live = state if state and state.get("subscription_id") else None
        if recover:
            if columns is not None or filters:
                raise ValueError("recover uses the selection of the original read")
            if live is None:
                raise ValueError(f"{process!r} has nothing to recover from {source.name!r}")
            return self._range(source, live, change_mode)
        before = live["pointer"] if live else None
        newest = source.df.agg(pointer_text(F.greatest(F.max(source.change).cast("timestamp_ntz"), F.lit(before).cast("timestamp_ntz"))).alias("p")).first()["p"]
        opened = {
            "seq": (state or {}).get("seq"),
            "context": source.context,
            "object": source.name,
            "subscriber_type": "SPARK",
            "subscriber_name": self.subscriber_name,
            "subscriber_process": process,
            "queue_name": f"{source.context}~{source.name}",
            "subscription_id": live["subscription_id"] if live else uuid.uuid4().hex,
            "prev_pointer": before,
            "pointer": newest,
            "status": OPEN,
            "columns": json.dumps(list(columns)) if columns is not None else None,
            "filters": json.dumps([dict(f) for f in filters]),
        }
        require_columns(source.df, columns or [])
        self._append(opened)
        return self._range(source, opened, change_mode)

    @staticmethod
    def _range(source: Source, state: dict, change_mode: bool = False) -> DataFrame:
        rows = source.df
        if state["prev_pointer"]:
            rows = rows.where(source.change.between(*[F.lit(state[p]).cast("timestamp_ntz") for p in ("prev_pointer", "pointer")]))
        columns = json.loads(state["columns"]) if state["columns"] else None
        rows = _selected(rows, columns, json.loads(state["filters"]))
        return rows.withColumn(MODE, F.lit(UPSERT)) if change_mode else rows

    # --- administration ------------------------------------------------------------------------

    def subscriptions(
        self, context: str | None = None, name: str | None = None, subscriber_name: str | None = None, process: str | None = None
    ) -> DataFrame:
        """Live subscriptions, of one object or subscriber if asked."""
        found = self._current().where(F.col("status") != DROPPED)
        wanted = {"context": context, "object": name, "subscriber_name": subscriber_name, "subscriber_process": process}
        for column, value in wanted.items():
            if value is not None:
                found = found.where(F.col(column) == value)
        return found.select("context", "object", "subscriber_type", "subscriber_name", "subscriber_process", "queue_name", "subscription_id")

    def cursors(self) -> DataFrame:
        """Cursors with their state and pointer as DECIMAL(21,7)."""
        pointer = pointer_number(F.col("pointer").cast("timestamp_ntz"))
        return self._current().where(F.col("status") != DROPPED).select(
            "context", "object", F.col("subscriber_process").alias("subscriber_proc"), "status", F.lit(True).alias("is_delta_extension"), pointer.alias("pointer")
        )

    def close_cursor(self, context: str, process: str, name: str) -> str:
        """Close, keeping the pointer: the next read goes on from it. Closing twice is no error."""
        state = self._state(context, name, process)
        if state is None or state["status"] == DROPPED:
            return NOT_FOUND
        if state["status"] == OPEN:
            self._append({**state, "status": SHUT})
        return CLOSED

    def drop(self, context: str, process: str, name: str) -> bool:
        """Forget a subscription: the next read delivers the whole object again."""
        state = self._state(context, name, process)
        if state is None or state["status"] == DROPPED:
            return False
        self._append({**state, "status": DROPPED})
        return True
