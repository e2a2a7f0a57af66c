"""WARC bundles in seekable Zstandard: independent frames of records, a seek table in the footer, and a map from record ids to places in frames."""

from __future__ import annotations

import io
import re
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictspark.session import work_dir

from .common import cut

#: A frame is closed when its records reach this size; one larger record is a frame.
FRAME_BYTES = 1 << 20
#: A bundle is closed when it reaches this size.
BUNDLE_BYTES = 256 << 20
#: Payloads from this size on are stored once.
LEAST_SHARED = 100
LEVEL = 6

# Fixed values of the public seekable format.
_SKIPPABLE, _FOOTER = 0x184D2A5E, 0x8F92EAB1
_ENTRY, _TAIL = "<II", "<IBI"

INDEX = "page_id long, bundle string, frame int, frame_start long, frame_bytes long, record_start long, record_bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a path without scheme on a shared mount."""
    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9]+:", uri) else (fs.LocalFileSystem(), uri)


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    name = record_id[len("<urn:page:") : -1]
    return None if name == "null" else int(name)


def _uri(url: str) -> str:
    """A URL as a header value: what would break the line is escaped, and ``%`` itself so that it can be read back."""
    return re.sub(r"[\x00-\x20\x7f%]|[^\x00-\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url)


def _url(uri: str) -> str:
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), uri.encode()).decode("utf-8", "surrogatepass")


def record(page_id: int | None, url: str | None, digest: str, refers_to: int | None, revisit: bool, payload: bytes) -> bytes:
    """One WARC record: an HTTP response with its payload, or a revisit that names the response which has it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict, int]:
    """The record at ``start`` as a row of RECORD, and where it ends."""
    head = data.index(b"\r\n\r\n", start)
    fields = dict(line.split(": ", 1) for line in data[start:head].decode().split("\r\n")[1:])
    block, end = head + 4, head + 4 + int(fields["Content-Length"])
    body = data.index(b"\r\n\r\n", block) + 4
    revisit = fields["WARC-Type"] == "revisit"
    length = int(re.search(rb"Content-Length: (\d+)", data[block:body])[1])
    row = {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "url": _url(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": fields["WARC-Type"],
        "refers_to": _page_of(fields["WARC-Refers-To"]) if revisit else None,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload_bytes": length,
        "payload": None if revisit else data[body:end],
    }
    return row, end + 4


class _Bundle:
    """A bundle being written; records go to the open frame."""

    def __init__(self, folder: str, frame_bytes: int):
        self.frame_bytes = frame_bytes
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, path = filesystem(self.uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.at, self.frames, self.open, self.size, self.rows = 0, [], [], 0, []

    def add(self, page_id: int | None, data: bytes) -> None:
        self.rows.append((page_id, len(self.frames), self.size, len(data)))
        self.open.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.out.write(packed)
            self.frames.append((self.at, len(packed), self.size))
            self.at, self.open, self.size = self.at + len(packed), [], 0

    def close(self) -> dict[str, list]:
        """Write the seek table; the index rows of all records."""
        self.flush()
        entries = b"".join(struct.pack(_ENTRY, packed, size) for _, packed, size in self.frames)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(entries) + struct.calcsize(_TAIL)) + entries + struct.pack(_TAIL, len(self.frames), 0, _FOOTER))
        self.out.close()
        cols = ["page_id", "bundle", "frame", "frame_start", "frame_bytes", "record_start", "record_bytes"]
        rows = [(p, self.uri, f, self.frames[f][0], self.frames[f][1], s, n) for p, f, s, n in self.rows]
        return {c: list(v) for c, v in zip(cols, zip(*rows, strict=True), strict=True)}


_INDEX_SCHEMA = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("frame_bytes", pa.int64()), ("record_start", pa.int64()), ("record_bytes", pa.int64())])
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int) -> Iterator[pa.RecordBatch]:
    bundle = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to", "revisit")]
        payloads = batch.column("payload")
        for i, (page_id, url, digest, refers_to, revisit) in enumerate(zip(*columns, strict=True)):
            bundle = bundle or _Bundle(folder, frame_bytes)
            bundle.add(page_id, record(page_id, url, digest, refers_to, revisit, payloads[i].as_buffer().to_pybytes()))
            if bundle.at >= bundle_bytes:
                yield pa.RecordBatch.from_pydict(bundle.close(), _INDEX_SCHEMA)
                bundle = None
    if bundle:
        yield pa.RecordBatch.from_pydict(bundle.close(), _INDEX_SCHEMA)


def write_bundles(pages: DataFrame, folder: str, least: int = LEAST_SHARED, page_id: str = "page_id", url: str = "url", html: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record per row to bundles in ``folder``; the written index: where each record lies.

    A null ``html`` is an empty payload. Of rows with equal payloads of at least ``least`` bytes the one with the smallest id is the response and others
    revisit it; rows that repeat this id are responses, too, and rows without an id revisit it, or are responses if no row has one.
    Null URLs have no target line. An empty table writes no bundle.

    Only ids and digests are aggregated to find repeated payloads, and only those that do repeat are joined, so that pages stay where
    they were read if there are few. The index names the bundles of finished tasks only; a file that a lost task left is in no index.
    ``folder`` must be one that all workers reach.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = rows.where(F.length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    joined = rows.join(cut(shared.select("digest", "refers_to")), "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    records = joined.select("page_id", "url", "digest", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"), "payload")
    return cut(records.mapInArrow(partial(_write, folder=folder, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes), INDEX))


def seek_table(file) -> list[tuple[int, int, int]]:
    """Start, packed and unpacked size of a bundle's frames, from its footer."""
    end = file.seek(0, io.SEEK_END)
    file.seek(end - struct.calcsize(_TAIL))
    n, descriptor, magic = struct.unpack(_TAIL, file.read(struct.calcsize(_TAIL)))
    if magic != _FOOTER:
        raise ValueError("the file has no seek table")
    entry = 12 if descriptor & 0x80 else 8
    file.seek(end - struct.calcsize(_TAIL) - n * entry)
    table, at, out = file.read(n * entry), 0, []
    for i in range(n):
        packed, size = struct.unpack_from(_ENTRY, table, i * entry)
        out.append((at, packed, size))
        at += packed
    return out


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("bundle").to_pylist():
            files, path = filesystem(uri)
            with files.open_input_file(path) as file:
                rows = seek_table(file)
            yield pa.RecordBatch.from_pydict({"bundle": [uri] * len(rows), "start": [r[0] for r in rows], "packed": [r[1] for r in rows], "size": [r[2] for r in rows]})


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in batch.to_pylist():
            files, path = filesystem(row["bundle"])
            with files.open_input_file(path) as file:
                file.seek(row["start"])
                data = unpacker.decompress(file.read(row["packed"]), max_output_size=row["size"])
            at, rows = 0, []
            while at < len(data):
                own, at = parse(data, at)
                rows.append(own if payloads else own | {"payload": None, "payload_bytes": own["payload_bytes"], "payload_digest": _checked(own)})
            yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)


def _checked(row: dict) -> str:
    """The digest, computed anew where the payload is there."""
    import hashlib

    if row["payload"] is None:
        return row["payload_digest"]
    if len(row["payload"]) != row["payload_bytes"]:
        raise ValueError(f"page {row['page_id']}: {len(row['payload'])} bytes, not {row['payload_bytes']}")
    return hashlib.sha256(row["payload"]).hexdigest()


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that an index names: RECORD rows. Without ``payloads`` they are checked and left out.

    Footers give the frames, and frames are dealt out to tasks, so a bundle is read by many. A revisit has the size and digest of the payload it repeats, and no payload.
    """
    frames = index.select("bundle").distinct().mapInArrow(_frames, "bundle string, start long, packed long, size long")
    return frames.repartition("bundle", "start").mapInArrow(partial(_read, payloads=payloads), RECORD)


def read_records(index: DataFrame) -> DataFrame:
    """The records of an index's rows alone, frame by frame: each frame that holds one is read and its records are taken by their places."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        last, data = None, b""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if last != (row["bundle"], row["frame_start"]):
                    files, path = filesystem(row["bundle"])
                    with files.open_input_file(path) as file:
                        file.seek(row["frame_start"])
                        packed = file.read(row["frame_bytes"])
                    last, data = (row["bundle"], row["frame_start"]), unpacker.decompress(packed)
                rows.append(parse(data, row["record_start"])[0])
            yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)

    return index.repartition("bundle", "frame_start").sortWithinPartitions("bundle", "frame_start").mapInArrow(take, RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for bundles in the shared folder."""
    return work_dir(spark, "warc")
