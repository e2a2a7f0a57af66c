"""A replica as levels of layers under a manifest, for streams that run for years.

Every batch adds one small layer. As soon as ``fanout`` layers share a level they are merged into one of the next, so a row is
rewritten once a level and a read opens fewer than ``fanout`` layers of each. What belongs to the replica is said by its newest
manifest alone: layers that were merged, and layers of batches that failed, are in none and are never opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.replication import DELETE, MODE
from ..operators.versions import latest
from .delta import BATCH, OnBatch

FANOUT = 8
MANIFESTS, LAYERS = "manifests", "layers"


class ManifestConflict(RuntimeError):
    """Another writer has published the same version."""


@dataclass(frozen=True)
class Replica:
    """The last image of every key, kept in the shared folder ``path``.

    ``order`` says which of two images of a key is the later one; the later batch decides between equals. Images with the
    change mode ``D`` are tombstones: reads leave their keys out, and merges keep them, so an older image that comes late does
    not bring a key back. Keys may be NULL and are then one key. One writer at a time: of two that publish the same version the
    second gets :class:`ManifestConflict` (renames are exclusive on HDFS and local mounts). Superseded layers stay on disk
    until :meth:`unused` folders are removed by whoever knows that no reader still holds an older manifest.
    """

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    fanout: int = FANOUT

    def __post_init__(self) -> None:
        if self.fanout < 2:
            raise ValueError("a merge takes two layers at least")

    # --- manifest ------------------------------------------------------------------------------

    def _files(self, folder: str):
        """The file system of the replica and the names in one of its folders."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        system = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
        return system, where, names

    def manifest(self) -> dict:
        """The newest manifest: its version, the layers with their levels, and the last batch of every subscriber."""
        system, where, names = self._files(MANIFESTS)
        versions = [name for name in names if name.endswith(".json") and not name.startswith((".", "_"))]
        if not versions:
            return {"version": 0, "layers": [], "delivered": {}}
        stream = system.open(self.spark._jvm.org.apache.hadoop.fs.Path(where, max(versions)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, old: dict, layers: Sequence[dict], delivered: dict) -> dict:
        """Write the next version beside its place and rename it there: readers see all of it or nothing."""
        new = {"version": old["version"] + 1, "layers": list(layers), "delivered": delivered}
        system, where, _ = self._files(MANIFESTS)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        draft, place = path(where, f"_draft-{uuid.uuid4().hex}"), path(where, f"{new['version']:012d}.json")
        out = system.create(draft, False)
        try:
            out.write(bytearray(json.dumps(new).encode()))
        finally:
            out.close()
        if system.exists(place) or not system.rename(draft, place):
            system.delete(draft, False)
            raise ManifestConflict(f"version {new['version']} of {self.path} was published by another writer")
        return new

    # --- writing -------------------------------------------------------------------------------

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BATCH, LongType())])

    def _layer(self, rows: DataFrame, level: int) -> dict:
        folder = f"{LAYERS}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "level": level}

    def _merged(self, layers: Sequence[dict]) -> DataFrame:
        return latest(self._rows(layers), list(self.keys), [*self.order, BATCH])

    def _rows(self, layers: Sequence[dict]) -> DataFrame:
        paths = [f"{self.path}/{layer['folder']}" for layer in layers]
        return self.spark.read.schema(self._stored()).parquet(*paths) if paths else self.spark.createDataFrame([], self._stored())

    def layer_to(self, subscriber: str = "stream") -> OnBatch:
        """The batch function of a stream. ``subscriber`` names its checkpoint: a batch that comes again is known by its number.

        The layer is written first and published with its number in one manifest, so a batch counts once or not at all.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            now = self.manifest()
            if batch_id <= now["delivered"].get(subscriber, -1):
                return
            number = F.lit(sum(last + 1 for last in now["delivered"].values())).cast("long")
            last = latest(batch.select(*self.schema.names), list(self.keys), list(self.order))
            layer = self._layer(last.withColumn(BATCH, number), 0)
            self._publish(now, [*now["layers"], layer], {**now["delivered"], subscriber: batch_id})
            self._climb()

        return write

    def _climb(self) -> None:
        """Merge every level that is full, lowest first."""
        level = 0
        while True:
            now = self.manifest()
            full = [layer for layer in now["layers"] if layer["level"] == level]
            if len(full) >= self.fanout:
                merged = self._layer(self._merged(full), level + 1)
                self._publish(now, [*[layer for layer in now["layers"] if layer["level"] != level], merged], now["delivered"])
            elif all(layer["level"] <= level for layer in now["layers"]):
                return
            level += 1

    def compact(self, forget_deleted: bool = False) -> None:
        """Merge all layers into one base. ``forget_deleted`` drops tombstones, too: for sources whose images never come late."""
        now = self.manifest()
        if not now["layers"]:
            return
        rows = self._merged(now["layers"])
        if forget_deleted and MODE in self.schema.names:
            rows = rows.where(~F.col(MODE).eqNullSafe(DELETE))
        base = self._layer(rows, max(layer["level"] for layer in now["layers"]))
        self._publish(now, [base], now["delivered"])

    # --- reading -------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The replica as of now; later batches and merges do not change what the returned DataFrame reads."""
        rows = self._merged(self.manifest()["layers"])
        if MODE in self.schema.names:
            rows = rows.where(~F.col(MODE).eqNullSafe(DELETE))
        return rows.select(*self.schema.names)

    def unused(self) -> list[str]:
        """Layer folders that the newest manifest does not name."""
        named = {layer["folder"] for layer in self.manifest()["layers"]}
        return sorted(f"{LAYERS}/{name}" for name in self._files(LAYERS)[2] if f"{LAYERS}/{name}" not in named)
