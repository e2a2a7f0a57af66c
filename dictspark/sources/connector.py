"""The format ``dictextract``: extract folders as text columns, read with pushed filters, written with commits, and streamed.

An extract folder holds ``lines/`` (text), ``dictionary/`` (field rows as JSON lines) and, where the connector wrote it,
``_commits/`` (the files of each write). Lines are split into cells and joined from them in Arrow batches; typing and encoding
cells is left to Catalyst expressions, which run in the JVM (:func:`read_extract` and :func:`write_extract` with
``connector=True`` and :func:`stream_extract` add them).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from ..functions.encode import encode_cell
from ..functions.sqltext import name as quoted
from ..functions.types import CHAR_TYPES, TEXT_TYPES, Field, cell_width, data_fields
from .dictionary import FIELD_ROW, _fields_of, as_fields, field_rows, fields_frame
from .extract import LINE, decode_cells, decode_extract, encode_extract
from .layouts import DEFAULT_DELIMITER, escapes, layout_named, row_width

FORMAT = "dictextract"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
SPLIT_BYTES = 64 << 20
READ_AHEAD = 64 << 10
BATCH_BYTES = 4 << 20
COMPRESSED = (".gz", ".bz2")
TABLE = "extract"
LINES, DICTIONARY, COMMITS = "lines", "dictionary", "_commits"


def write_extract(
    df: DataFrame,
    fields: Sequence[Field],
    path: str,
    layout: str = "delimited",
    delimiter: str = DEFAULT_DELIMITER,
    escape: bool = False,
    connector: bool = False,
    mode: str = "append",
    compression: str = "none",
) -> str:
    """Write an extract folder. A line break inside a cell would read as two rows: an error, unless ``escape`` writes it as a pair.

    The connector adds its files to those of earlier writes, or replaces them by ``mode="overwrite"``; its writes can be streamed.
    Lines may be written with a ``compression`` of Spark's text files. The native readers read them; the connector neither writes nor reads such files.
    """
    if connector:
        if compression != "none":
            raise ValueError("the connector writes plain lines")
        register(df.sparkSession)
        data = data_fields(fields)
        cells = df.selectExpr(*[f"{encode_cell(quoted(f.name), f)} AS {quoted(f.name)}" for f in data])
        columns = [c.strip().partition(" ")[0] for c in FIELD_ROW.split(",")]
        dictionary = json.dumps([dict(zip(columns, row)) for row in field_rows(TABLE, fields)])
        writer = cells.write.format(FORMAT).option("layout", layout).option("delimiter", delimiter).option("escape", str(escape).lower())
        writer.option("dictionary", dictionary).mode(mode).save(qualified(df.sparkSession, path))
        return path
    lines = encode_extract(df, fields, layout, delimiter, escape=escape).select(LINE)
    broken = F.raise_error(F.lit("a cell contains a line break; write it with escape=True")).cast("string")
    whole = lines.select(F.when(F.col(LINE).contains("\n") | F.col(LINE).contains("\r"), broken).otherwise(F.col(LINE)).alias(LINE))
    # for gzip and deflate: lines of many alike cells shrink nearly as much at the fastest level, in a third of the time
    whole.write.option("zlib.compress.level", "BEST_SPEED").text(f"{path}/lines", compression=compression)
    fields_frame(df.sparkSession, {TABLE: fields}).coalesce(1).write.json(f"{path}/dictionary")
    return path


def extract_fields(spark: SparkSession, path: str) -> list[Field]:
    """The dictionary of an extract folder: one row per column."""
    return as_fields(spark.read.schema(FIELD_ROW).json(f"{path}/dictionary"))


def read_extract(spark: SparkSession, path: str, layout: str = "delimited", delimiter: str = DEFAULT_DELIMITER, connector: bool = False, escape: bool = False) -> DataFrame:
    """An extract folder as a typed DataFrame, read by the JVM text source or by the connector; files in subfolders too."""
    fields = extract_fields(spark, path)
    if not connector:
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{path}/lines").withColumnRenamed("value", LINE)
        return decode_extract(lines, fields, layout, delimiter, escape=escape)
    register(spark)
    cells = spark.read.format(FORMAT).option("layout", layout).option("delimiter", delimiter).option("escape", str(escape).lower()).load(qualified(spark, path))
    return decode_cells(cells, fields)


def stream_extract(spark: SparkSession, path: str, layout: str = "delimited", delimiter: str = DEFAULT_DELIMITER, escape: bool = False) -> DataFrame:
    """What the connector writes to an extract folder, as a typed stream: each write is read once, whole and in turn."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("layout", layout).option("delimiter", delimiter).option("escape", str(escape).lower())
    return decode_cells(reader.load(qualified(spark, path)), extract_fields(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without belongs to the cluster's default file system, as for Spark's own readers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def register(spark: SparkSession) -> None:
    """Make the format known to a session. The source travels to the executors with its code, so
    the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(DictExtractSource)


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _data_files(path: str, folder: str) -> list:
    from pyarrow import fs

    system, root = _filesystem(path)
    top = f"{root}/{folder}"
    found = system.get_file_info(fs.FileSelector(top, recursive=True))
    hidden = [any(part.startswith(("_", ".")) for part in f.path[len(top) :].split("/")) for f in found]
    return [f for f, hide in zip(found, hidden) if f.is_file and f.size and not hide]


class DictExtractSource(DataSource):
    """Options: ``path`` (the extract folder), ``layout``, ``delimiter``, ``escape``; for reads ``splitBytes``; for writes
    ``dictionary`` (field rows as a JSON list; without it all columns are ``STRING``). Modes of writes: append, overwrite."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _fields(self) -> list[Field]:
        path = self.options["path"]
        system, _ = _filesystem(path)
        rows = []
        for file in _data_files(path, DICTIONARY):
            with system.open_input_stream(file.path) as stream:
                rows += [json.loads(line) for line in stream.read().decode("utf-8").splitlines() if line]
        rows.sort(key=lambda r: r["pos"])
        return data_fields(_fields_of(rows))

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self._fields()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return DictExtractReader(self.options, self._fields(), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return DictExtractStream(DictExtractReader(self.options, self._fields(), schema))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return DictExtractWriter(self.options, schema, overwrite)


class LineRange(InputPartition):
    """Lines that begin in a byte range of a file; without an end, all lines of a compressed file."""

    def __init__(self, path: str, start: int, end: int | None):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class DictExtractReader(DataSourceReader):
    def __init__(self, options, fields: Sequence[Field], schema: T.StructType):
        self.path = options["path"]
        self.layout = layout_named(options.get("layout", "delimited"))
        self.delimiter = options.get("delimiter", DEFAULT_DELIMITER)
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.escapes = escapes(self.layout, self.delimiter) if options.get("escape", "false").lower() == "true" else []
        self.fields = list(fields)
        self.names = schema.names
        self.wanted: dict[str, list[set[str]]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality and IN on character columns, whose cells compare as text; return the rest."""
        characters = {f.name for f in self.fields if f.type in CHAR_TYPES}
        for item in filters:
            column = item.attribute[0] if isinstance(item, (EqualTo, In)) and len(item.attribute) == 1 else None
            if column not in characters:
                yield item
            elif isinstance(item, EqualTo):
                self.wanted.setdefault(column, []).append({item.value})
            else:
                self.wanted.setdefault(column, []).append(set(item.value))

    def partitions(self) -> list[LineRange]:
        return self.ranges(_data_files(self.path, LINES)) or [LineRange("", 0, 0)]

    def ranges(self, files: list) -> list[LineRange]:
        found = []
        for file in files:
            if file.path.endswith(COMPRESSED):
                found.append(LineRange(file.path, 0, None))
                continue
            found += [LineRange(file.path, at, min(at + self.split_bytes, file.size)) for at in range(0, file.size, self.split_bytes)]
        return found

    def read(self, partition: LineRange):
        if not partition.path:
            return
        for block in self._blocks(partition):
            yield self._cells(block)

    def _blocks(self, partition: LineRange) -> Iterator[bytes]:
        """Whole lines of a range, some megabytes at a time, without the last line's end.

        A range owns the lines that begin in it; the one before its start belongs to its neighbour.
        """
        system, _ = _filesystem(self.path)
        if partition.end is None:
            with system.open_input_stream(partition.path, compression="detect") as stream:
                yield from _whole_lines(stream, None, False)
            return
        begin = max(partition.start - 1, 0)
        with system.open_input_file(partition.path) as stream:
            stream.seek(begin)
            yield from _whole_lines(stream, partition.end - begin, partition.start > 0)

    def _cells(self, block: bytes):
        """One Arrow batch of text cells, character cells right-trimmed, pushed filters applied. A short line lacks its last cells."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lines = pc.split_pattern(pa.array([block], pa.large_binary()).cast(pa.large_string()), "\n").flatten()
        lines = pc.replace_substring_regex(lines, "\r$", "")
        cells, count = [], len(self.fields)
        if self.layout.delimited:
            ends = pc.count_substring(lines, self.delimiter)
            # with as many delimiters behind it as there are fields, every line splits into one piece more than these
            padding, nothing = (pa.scalar(t, pa.large_string()) for t in (self.delimiter * count, ""))
            padded = pc.binary_join_element_wise(lines, padding, nothing)
            pieces = pc.split_pattern(padded, self.delimiter, max_splits=count)
            for i in range(count):
                cells.append(pc.if_else(pc.greater_equal(ends, i), pc.list_element(pieces, i), pa.scalar(None, pa.large_string())))
        else:
            start = 0
            for field in self.fields:
                cells.append(pc.utf8_slice_codeunits(lines, start, start + cell_width(field)))
                start += cell_width(field)
        for plain, written in self.escapes:
            cells = [pc.replace_substring(c, written, plain) if f.type in TEXT_TYPES else c for c, f in zip(cells, self.fields)]
        cells = [pc.utf8_rtrim(c, characters=" ") if f.type in CHAR_TYPES else c for c, f in zip(cells, self.fields)]
        cells = [c.cast(pa.string()) for c in cells]
        batch = pa.RecordBatch.from_arrays(cells, names=[f.name for f in self.fields]).select(self.names)
        for column, choices in self.wanted.items():
            for values in choices:
                batch = batch.filter(pc.is_in(batch.column(column), value_set=pa.array(sorted(values), pa.string())))
        return batch


def _whole_lines(stream, left: int | None, skip: bool) -> Iterator[bytes]:
    """Blocks of whole lines from the next ``left`` bytes (all, if None) and the rest of the last line; ``skip`` leaves out the first line."""
    rest = b""
    while left is None or left > 0:
        data = stream.read(BATCH_BYTES if left is None else min(BATCH_BYTES, left))
        if not data:
            break
        left = None if left is None else left - len(data)
        if skip:
            end = data.find(b"\n")
            if end < 0:
                continue
            data, skip = data[end + 1 :], False
        head, end, rest = (rest + data).rpartition(b"\n")
        if end:
            yield head
    if not rest:
        return
    while left is not None and (more := stream.read(READ_AHEAD)):
        end = more.find(b"\n")
        rest += more if end < 0 else more[:end]
        if end >= 0:
            break
    yield rest


# --- writing and streaming ---------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its hidden file and the number of lines."""

    draft: str
    lines: int


def _commits(path: str) -> list:
    """The log of an extract folder: one file a write, in order."""
    from pyarrow import fs

    system, root = _filesystem(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True))
    return sorted((f for f in found if f.is_file and not f.base_name.startswith("_")), key=lambda f: f.base_name)


class DictExtractWriter(DataSourceArrowWriter):
    """Tasks write hidden files; the commit makes those of successful tasks visible and enters them in the log.

    Files of failed or repeated attempts stay hidden and are read by nobody. One write at a time to a folder.
    """

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.layout = layout_named(options.get("layout", "delimited"))
        self.delimiter = options.get("delimiter", DEFAULT_DELIMITER)
        self.escapes = escapes(self.layout, self.delimiter) if options.get("escape", "false").lower() == "true" else []
        other = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
        if other:
            raise ValueError(f"{FORMAT} writes text cells; encode columns {other} first")
        if "dictionary" in options:
            self.rows = json.loads(options["dictionary"])
        else:
            columns = [c.strip().partition(" ")[0] for c in FIELD_ROW.split(",")]
            self.rows = [dict(zip(columns, row)) for row in field_rows(TABLE, [Field(name, "STRING", 0) for name in schema.names])]
        self.fields = data_fields(_fields_of(sorted(self.rows, key=lambda r: r["pos"])))
        if sorted(schema.names) != sorted(f.name for f in self.fields):
            raise ValueError(f"columns {schema.names} are not the fields of the dictionary")
        if self.layout.max_width and row_width(self.fields) > self.layout.max_width:
            raise ValueError(f"a row of {row_width(self.fields)} characters exceeds the {self.layout.max_width} of layout {self.layout.name!r}")

    def write(self, iterator) -> Written:
        system, root = _filesystem(self.path)
        folder = f"{root}/{LINES}"
        system.create_dir(folder, recursive=True)
        draft, lines = f"{folder}/_draft-{uuid.uuid4().hex}", 0
        with system.open_output_stream(draft) as out:
            for batch in iterator:
                if batch.num_rows:
                    out.write(self._text(batch))
                    lines += batch.num_rows
        return Written(draft, lines)

    def _text(self, batch):
        """The lines of a batch, each with its end. What could not be read back is an error."""
        import pyarrow as pa
        import pyarrow.compute as pc

        cells = []
        for field in self.fields:
            cell = pc.fill_null(batch.column(field.name).cast(pa.large_string()), "")
            for plain, written in reversed(self.escapes if field.type in TEXT_TYPES else []):
                cell = pc.replace_substring(cell, plain, written)
            if not self.layout.delimited:
                if pc.max(pc.utf8_length(cell)).as_py() > cell_width(field):
                    raise ValueError(f"field {field.name} is wider than {cell_width(field)}")
                cell = pc.utf8_rpad(cell, cell_width(field), " ")
            cells.append(cell)
        lines = pc.binary_join_element_wise(*cells, pa.scalar(self.delimiter if self.layout.delimited else "", pa.large_string()))
        if pc.any(pc.match_substring_regex(lines, "[\n\r]")).as_py():
            raise ValueError("a cell contains a line break; write it with escape")
        if self.layout.delimited and pc.max(pc.count_substring(lines, self.delimiter)).as_py() > len(self.fields) - 1:
            raise ValueError(f"a cell contains the delimiter {self.delimiter!r}")
        ended = pc.binary_join_element_wise(lines, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
        start, end = ended.offset, ended.offset + len(ended)
        bounds = memoryview(ended.buffers()[1]).cast("q")
        return ended.buffers()[2].slice(bounds[start], bounds[end] - bounds[start])

    def commit(self, messages) -> None:
        system, root = _filesystem(self.path)
        drafts = [m for m in messages if m is not None]
        replaced = [f.path for folder in (LINES, DICTIONARY) for f in self._existing(folder)] if self.overwrite else []
        if self.overwrite or not self._existing(DICTIONARY):
            system.create_dir(f"{root}/{DICTIONARY}", recursive=True)
            with system.open_output_stream(f"{root}/{DICTIONARY}/part-{uuid.uuid4().hex}.json") as out:
                out.write("".join(json.dumps(row) + "\n" for row in self.rows).encode())
        elif [f.name for f in self.fields] != [f.name for f in DictExtractSource({"path": self.path})._fields()]:
            self.abort(messages)
            raise ValueError("the folder has another dictionary")
        files = []
        for written in drafts:
            if not written.lines:
                system.delete_file(written.draft)
                continue
            place = written.draft.replace("/_draft-", "/part-") + ".txt"
            system.move(written.draft, place)
            files.append(place[len(root) + 1 :])
        for path in replaced:
            system.delete_file(path)
        log = _commits(self.path)
        number = int(log[-1].base_name.partition(".")[0]) + 1 if log else 1
        system.create_dir(f"{root}/{COMMITS}", recursive=True)
        draft = f"{root}/{COMMITS}/_draft-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(sorted(files)).encode())
        system.move(draft, f"{root}/{COMMITS}/{number:012d}.json")

    def _existing(self, folder: str) -> list:
        try:
            return _data_files(self.path, folder)
        except FileNotFoundError:
            return []

    def abort(self, messages) -> None:
        system, _ = _filesystem(self.path)
        for written in messages:
            if written is not None:
                system.delete_file(written.draft)


class DictExtractStream(DataSourceStreamReader):
    """The writes of a folder in the order of its log; an offset is the number of the last one read.

    Lines that an overwrite has removed are gone for streams, too: a stream that has not read them yet fails.
    """

    def __init__(self, reader: DictExtractReader):
        self.reader = reader

    def initialOffset(self) -> dict:
        return {"commit": 0}

    def latestOffset(self) -> dict:
        log = _commits(self.reader.path)
        return {"commit": int(log[-1].base_name.partition(".")[0]) if log else 0}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        system, root = _filesystem(self.reader.path)
        paths = []
        for entry in _commits(self.reader.path):
            if start["commit"] < int(entry.base_name.partition(".")[0]) <= end["commit"]:
                with system.open_input_stream(entry.path) as stream:
                    paths += [f"{root}/{name}" for name in json.loads(stream.read().decode())]
        files = system.get_file_info(paths)
        gone = [f.path for f in files if not f.is_file]
        if gone:
            raise FileNotFoundError(f"lines that were not read yet are gone: {gone[:3]}")
        return self.reader.ranges(files)

    def read(self, partition: LineRange):
        return self.reader.read(partition)
