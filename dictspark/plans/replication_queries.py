"""Snapshots, deltas, change application and streams over orders and events."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import functions as F

from ..functions.selection import option
from ..operators.reconcile import narrow
from ..operators.replication import DELETE, MODE, UPSERT, Replicator, Source, apply_changes, last_modified, preview, read_full, snapshot_diff
from ..operators.versions import latest
from ..session import work_dir
from ..sources.files import write_table
from ..streaming.delta import append_to, change_stream, layer_to, once, read_batches, read_replica, run_delta
from ..streaming.replica import Replica
from .inputs import events, orders
from .registry import ORACLES, query, table
from .relational_queries import PAIR, snapshot_pair

CONTEXT, PROCESS = "BW", "NIGHTLY"
FIRST_DAYS = "2024-01-16"
IMAGE = "event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value"
# a delta starts with the stamp that the last one ended with, since rows of that stamp may have come later
NEW = f"SELECT {IMAGE} FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{FIRST_DAYS}')"


def event_images(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))


def event_source(spark, sf_dir, first: bool = False) -> Source:
    """The change log, whole or as it was before the increments arrived."""
    rows = event_images(spark, sf_dir)
    if first:
        rows = rows.where(F.col("ts") < F.lit(FIRST_DAYS).cast("timestamp_ntz"))
    return Source(CONTEXT, "EVENTS$F", rows, ("event_id",), "ts")


def replicator(spark) -> Replicator:
    return Replicator(spark, work_dir(spark, "subscriptions"))


@query("snapshot_full", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(1 AS INTEGER) AS snapshot FROM orders")
def snapshot_full(spark, sf_dir):
    """Every row and column of the object is read and written."""
    source = Source(CONTEXT, "ORDERS$P", orders(spark, sf_dir), ("o_orderkey",))
    written = write_table(read_full(source).withColumn("snapshot", F.lit(1)), work_dir(spark, "snapshot"), partition_by=("snapshot",))
    return written.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "snapshot")


@query("snapshot_selected", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 10 AND 500")
def snapshot_selected(spark, sf_dir):
    """A snapshot by select-options, which is what they are for."""
    source = Source(CONTEXT, "ORDERS$P", orders(spark, sf_dir), ("o_orderkey",))
    return read_full(source, ["o_orderkey", "o_custkey"], [option("o_custkey", "10", "500", "I", "BT")])


@query("snapshot_preview", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def snapshot_preview(spark, sf_dir):
    return preview(Source(CONTEXT, "ORDERS$P", orders(spark, sf_dir), ("o_orderkey",)), 10, ["o_orderkey", "o_custkey"])


@query("delta_init", f"SELECT {IMAGE} FROM events WHERE ts < TIMESTAMP '{FIRST_DAYS}'")
def delta_init(spark, sf_dir):
    return replicator(spark).read_delta(event_source(spark, sf_dir, first=True), PROCESS)


@query("delta_increment", f"SELECT *, 'U' AS change_mode FROM ({NEW})")
def delta_increment(spark, sf_dir):
    subscriber = replicator(spark)
    subscriber.read_delta(event_source(spark, sf_dir, first=True), PROCESS)
    return subscriber.read_delta(event_source(spark, sf_dir), PROCESS, change_mode=True)


@query("delta_init_unstamped", f"SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events")
def delta_init_unstamped(spark, sf_dir):
    """The first read is the whole object, rows without a change stamp included."""
    rows = event_images(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 3 != 0, F.col("ts")))
    return replicator(spark).read_delta(Source(CONTEXT, "EVENTS$F", rows, ("event_id",), "ts"), PROCESS)


@query("delta_late_ties", f"SELECT {IMAGE} FROM events WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)")
def delta_late_ties(spark, sf_dir):
    """Stamps are days here: rows of the pointer's own day that come after the first read are delivered."""
    rows = event_images(spark, sf_dir)
    stamped = rows.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    last = stamped.agg(F.max(F.struct("day", "event_id")).alias("e")).first()["e"]
    early = stamped.where((F.col("day") < F.lit(last["day"])) | (F.col("event_id") == last["event_id"]))
    subscriber = replicator(spark)
    subscriber.read_delta(Source(CONTEXT, "EVENTS$F", early, ("event_id",), "day"), PROCESS)
    return subscriber.read_delta(Source(CONTEXT, "EVENTS$F", stamped, ("event_id",), "day"), PROCESS).select(*rows.columns)


@query("delta_recover", f"SELECT event_id, value FROM ({NEW}) WHERE event_type = 'click'")
def delta_recover(spark, sf_dir):
    subscriber, source = replicator(spark), event_source(spark, sf_dir)
    subscriber.read_delta(event_source(spark, sf_dir, first=True), PROCESS)
    subscriber.read_delta(source, PROCESS, ["event_id", "value"], [option("event_type", "click")])
    return subscriber.read_delta(source, PROCESS, recover=True)


@query("delta_latest_image", f"SELECT {IMAGE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def delta_latest_image(spark, sf_dir):
    return latest(event_images(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query(
    "delta_change_mode",
    f"{PAIR} SELECT b.*, 'U' AS change_mode FROM b LEFT JOIN a USING (o_orderkey) WHERE a.o_custkey IS NULL OR a.o_custkey IS DISTINCT FROM b.o_custkey "
    "OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice",
)
def delta_change_mode(spark, sf_dir):
    return snapshot_diff(*snapshot_pair(spark, sf_dir), ["o_orderkey"])


@query("delta_change_mode_narrowed", ORACLES["delta_change_mode"])
def delta_change_mode_narrowed(spark, sf_dir):
    """Snapshots of which only the parts that differ meet in a shuffle."""
    return snapshot_diff(*narrow(*snapshot_pair(spark, sf_dir), ["o_orderkey"]), ["o_orderkey"])


@query("delta_apply", f"{PAIR} SELECT * FROM b")
def delta_apply(spark, sf_dir):
    old, new = snapshot_pair(spark, sf_dir)
    return apply_changes(old, snapshot_diff(old, new, ["o_orderkey"], emit_deletes=True), ["o_orderkey"])


@query("delta_apply_keeps_deleted", f"{PAIR} SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)")
def delta_apply_keeps_deleted(spark, sf_dir):
    old, new = snapshot_pair(spark, sf_dir)
    return apply_changes(old, snapshot_diff(old, new, ["o_orderkey"]), ["o_orderkey"])


POINTER = "CAST(strftime(max(ts), '%Y%m%d%H%M%S.%f') AS DECIMAL(21,7))"


@query(
    "delta_subscriptions",
    "SELECT 'EVENTS$F' AS object, p AS subscriber_process, n FROM (VALUES ('NIGHTLY'), ('WEEKLY')) t(p) CROSS JOIN (SELECT count(*) AS n FROM events)",
)
def delta_subscriptions(spark, sf_dir):
    subscriber, source = replicator(spark), event_source(spark, sf_dir)
    delivered = [
        subscriber.read_delta(source, process).agg(F.lit(process).alias("subscriber_process"), F.count(F.lit(1)).alias("n"))
        for process in ("NIGHTLY", "WEEKLY", "ONCE")
    ]
    subscriber.drop(CONTEXT, "ONCE", source.name)
    counts = delivered[0].unionByName(delivered[1]).unionByName(delivered[2])
    listed = subscriber.subscriptions(CONTEXT, source.name).select("object", "subscriber_process")
    return listed.join(counts, "subscriber_process").select("object", "subscriber_process", "n")


@query(
    "delta_cursors",
    f"SELECT 'NIGHTLY' AS subscriber_proc, 'OPEN' AS status, true AS is_delta_extension, {POINTER} AS pointer FROM events "
    f"UNION ALL SELECT 'WEEKLY', 'CLOSED', true, {POINTER} FROM events WHERE ts < TIMESTAMP '{FIRST_DAYS}'",
)
def delta_cursors(spark, sf_dir):
    subscriber = replicator(spark)
    subscriber.read_delta(event_source(spark, sf_dir), "NIGHTLY")
    subscriber.read_delta(event_source(spark, sf_dir, first=True), "WEEKLY")
    subscriber.close_cursor(CONTEXT, "WEEKLY", "EVENTS$F")
    return subscriber.cursors().select("subscriber_proc", "status", "is_delta_extension", "pointer")


@query("delta_last_modified", f"SELECT 'EVENTS$F' AS object, {POINTER} AS last_modified FROM events")
def delta_last_modified(spark, sf_dir):
    return last_modified(event_source(spark, sf_dir))


@query("delta_close_resume", NEW)
def delta_close_resume(spark, sf_dir):
    subscriber = replicator(spark)
    subscriber.read_delta(event_source(spark, sf_dir, first=True), PROCESS)
    subscriber.close_cursor(CONTEXT, PROCESS, "EVENTS$F")
    return subscriber.read_delta(event_source(spark, sf_dir), PROCESS)


@query("delta_drop_reinit", f"SELECT {IMAGE} FROM events")
def delta_drop_reinit(spark, sf_dir):
    subscriber = replicator(spark)
    subscriber.read_delta(event_source(spark, sf_dir, first=True), PROCESS)
    subscriber.drop(CONTEXT, PROCESS, "EVENTS$F")
    return subscriber.read_delta(event_source(spark, sf_dir), PROCESS)


# --- streams -----------------------------------------------------------------------------------


def event_stream(spark, sf_dir):
    # as a pattern, the path may be one file or a folder of files
    return change_stream(spark, f"{sf_dir}/{{events.parquet}}", table(spark, sf_dir, "events").schema)


@query("delta_stream", "SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY event_type")
def delta_stream(spark, sf_dir):
    """Two runs of one subscriber: the snapshot, then nothing, since no file is new."""
    stream = event_stream(spark, sf_dir)
    path, checkpoint = work_dir(spark, "stream"), work_dir(spark, "checkpoint")
    run_delta(stream, checkpoint, append_to(path))
    run_delta(event_stream(spark, sf_dir), checkpoint, append_to(path))
    delivered = read_batches(spark, path, stream.schema)
    return delivered.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))


@query("delta_apply_stream", f"SELECT {IMAGE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def delta_apply_stream(spark, sf_dir):
    stream = event_stream(spark, sf_dir)
    path = work_dir(spark, "replica")
    keys, order = ["user_id"], ["ts", "event_id"]
    run_delta(stream, work_dir(spark, "checkpoint"), layer_to(path, keys, order))
    return read_replica(spark, path, stream.schema, keys, order).select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))


def increments(spark, sf_dir, rows, edges: list[str]) -> Iterator[str]:
    """Files of a change log as they come: up to each edge in turn, then the rest, every increment beginning with the day the last one ended with."""
    feed = work_dir(spark, "feed")
    bounds = [None, *edges, None]
    for since, until in zip(bounds, bounds[1:]):
        part = rows
        if since:
            part = part.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
        if until:
            part = part.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        part.write.mode("append").parquet(feed)
        yield feed


@query("delta_stream_once", f"SELECT {IMAGE} FROM events")
def delta_stream_once(spark, sf_dir):
    """Three increments whose ends overlap by a day, each read by a restarted subscriber: every image is delivered once."""
    rows = event_images(spark, sf_dir)
    path, checkpoint = work_dir(spark, "stream"), work_dir(spark, "checkpoint")
    for feed in increments(spark, sf_dir, rows, [FIRST_DAYS, "2024-01-23"]):
        run_delta(once(change_stream(spark, feed, rows.schema), "ts"), checkpoint, append_to(path))
    return read_batches(spark, path, rows.schema).select(*rows.columns)


GONE = "purchase"


@query(
    "delta_replica_levels",
    f"SELECT {IMAGE} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> '{GONE}'",
)
def delta_replica_levels(spark, sf_dir):
    """Five batches with deletions, merged by twos: the replica holds the last image of each user that was not deleted by it."""
    rows = event_images(spark, sf_dir).withColumn(MODE, F.when(F.col("event_type") == GONE, DELETE).otherwise(UPSERT))
    replica = Replica(spark, work_dir(spark, "replica"), rows.schema, ("user_id",), ("ts", "event_id"), fanout=2)
    checkpoint = work_dir(spark, "checkpoint")
    for feed in increments(spark, sf_dir, rows, ["2024-01-08", FIRST_DAYS, "2024-01-20", "2024-01-25"]):
        run_delta(change_stream(spark, feed, rows.schema), checkpoint, replica.layer_to())
    return replica.read().drop(MODE)
