"""Replication as a stream: files in, idempotent batches out, one checkpoint per subscriber."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.replication import DELETE, MODE
from ..operators.versions import latest

BATCH = "batch_id"
_EVENT = "_event_time"
OnBatch = Callable[[DataFrame, int], None]


def change_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files of after-images as a stream; a changed row arrives in a new file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_delta(stream: DataFrame, checkpoint: str, on_batch: OnBatch) -> None:
    """Deliver everything new since the checkpoint, then stop.

    The checkpoint belongs to one subscriber: the first run is its snapshot, later runs deliver
    new files only, and a batch that failed is delivered again with the same id.
    """
    query = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def once(stream: DataFrame, stamp: str, lateness: str | None = None) -> DataFrame:
    """Every image once, however often its source delivers it: a delta that begins with the stamp the last one ended with
    repeats the rows of that stamp, and only those that came late are new.

    Two rows are one image if all their columns are equal, NULL included. The images seen are kept in the state store of the
    checkpoint, dealt by their hash (choose the RocksDB provider, so that they live on disk). Without ``lateness`` they are kept for
    good and nothing is ever lost. With ``lateness`` (such as ``"2 days"``) they are forgotten when the newest stamp is that far
    ahead, and a stamped row that comes later than that is refused by the watermark: for sources that promise not to send any,
    and only after the first snapshot, whose files hold old stamps in any order. Rows without a stamp are remembered for good.
    """
    if lateness is None:
        return stream.dropDuplicates()
    stamped = stream.where(F.col(stamp).isNotNull()).withColumn(_EVENT, F.col(stamp).cast("timestamp")).withWatermark(_EVENT, lateness)
    unstamped = stream.where(F.col(stamp).isNull()).dropDuplicates()
    return stamped.dropDuplicatesWithinWatermark(stream.columns).drop(_EVENT).unionByName(unstamped)


def append_to(path: str) -> OnBatch:
    """Keep each batch in its own folder, replaced as a whole when it is delivered again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def layer_to(path: str, keys: Sequence[str], order: Sequence[str]) -> OnBatch:
    """Keep the last image per key of each batch as a layer of a replica.

    A batch writes its own changes only; it never rewrites the replica, so a read opens all layers. For streams
    of many batches see :class:`dictspark.streaming.replica.Replica`, which merges them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch, keys, order).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All delivered batches with their ``batch_id``."""
    return spark.read.schema(StructType([*schema.fields, StructField(BATCH, LongType())])).parquet(path)


def read_replica(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The replica: the last image per key over its layers, deleted rows left out."""
    columns = list(schema.names)
    layers = read_batches(spark, path, schema)
    merged = latest(layers, keys, [*order, BATCH])
    if MODE in columns:
        merged = merged.where(F.col(MODE) != DELETE)
    return merged.select(*columns)


def compact(spark: SparkSession, path: str, target: str, schema: StructType, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Merge the layers into one table at ``target``; the layers stay as they are."""
    read_replica(spark, path, schema, keys, order).write.mode("errorifexists").parquet(target)
    return spark.read.schema(schema).parquet(target)
