"""Fill-in-middle transformation by secondary sort: texts travel as small pieces, sorted into output order and back.

A document is cut into chunks of whole units (a run of letters, or one other character). Pieces are dealt by document and sorted
by their place in the output within their partition; a task streams them into a digest of each output, reads the markers back
and gives every piece its place in the original; sorted again within the same partition, they stream into the digest of the
restored text. Texts cross the network once, and no task ever holds more of a document than a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Parts of a document in the order of its text.
PARTS = (PREFIX, MIDDLE, SUFFIX)
#: Order of the parts in an output, by form. A plain output is one unmarked part.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
#: Units of a piece.
CHUNK = 1024
#: Rows of a batch that a task hands on.
BATCH_ROWS, BATCH_CHARS = 1024, 4 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_WITHIN = np.zeros(256, bool)  # bytes within a code point
_WITHIN[0x80:0xC0] = True


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that follow from seed and id: the first 8-digit groups of the SHA-256 of ``seed:id``; a null id is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(digest.substr(1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte positions where the units of a UTF-8 text begin: a run of ASCII letters, or one other code point."""
    letter = _LETTER[data]
    begins = ~_WITHIN[data]
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


_PIECE = [("row", pa.int64()), ("place", pa.int64()), ("mark", pa.string()), ("body", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECE_SCHEMA = "row long, place long, mark string, body string, doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _cut(batches: Iterator[pa.RecordBatch], chunk: int, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(_PIECE)
    for batch in batches:
        for part in slices(batch, 2):
            rows: dict[str, list] = {name: [] for name in schema.names}
            for row, doc_id, text, *h in zip(*[c.to_pylist() for c in part.columns], strict=True):
                data = text.encode()
                starts = unit_starts(np.frombuffer(data, np.uint8))
                n = len(starts)
                form = PLAIN
                if data and h[2] % 100 < rate and not any(m in text for m in PARTS):
                    form = "spm" if h[3] % 100 < spm else "psm"
                first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                bounds = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, n)}
                at = np.append(starts, len(data))  # byte position of every unit, and the end
                if form == PLAIN:
                    order, sizes = [("", (0, n))], [None, None]
                else:
                    order = [(mark, bounds[mark]) for mark in FORMS[form]]
                    sizes = [len(data[at[a] : at[z]].decode()) for a, z in (bounds[PREFIX], bounds[MIDDLE])]
                place = 0
                for mark, (a, z) in order:
                    for i in range(a, max(z, a + 1), chunk):
                        body = data[at[i] : at[min(i + chunk, z)]].decode()
                        head = (doc_id, n, form, *sizes) if place == 0 else (None,) * 5
                        for name, value in zip(schema.names, (row, place, mark if i == a else "", body, *head), strict=True):
                            rows[name].append(value)
                        place += 1
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


def pieces(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, chunk: int = CHUNK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The outputs as pieces: ``row, place, mark, body`` and, at place 0, ``doc_id, n, form, prefix_chars, middle_chars`` (null elsewhere).

    ``row`` tells the rows of ``docs`` apart, ``place`` counts the pieces of an output from 0, ``mark`` is the marker that stands before
    ``body`` (empty within a part). The output of a row is the concatenation of marks and bodies in order of place. A piece has at
    most ``chunk`` units; a part without text is one piece with an empty body.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)])
    return rows.mapInArrow(partial(_cut, chunk=chunk, rate=rate, spm=spm), _PIECE_SCHEMA)


class _Rows:
    """Rows collected into batches of bounded size."""

    def __init__(self, fields: list[tuple[str, pa.DataType]]):
        self.schema = pa.schema(fields)
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.chars = 0

    def add(self, values: tuple, chars: int = 0) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.chars += chars

    def full(self) -> bool:
        return len(self.columns[0]) >= BATCH_ROWS or self.chars >= BATCH_CHARS

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
        self._clear()
        return out


_READ = [("row", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("body", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string())]
_READ_SCHEMA = "row long, part int, place long, body string, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string"
_HEAD = ("doc_id", "n", "form", "prefix_chars", "middle_chars")
_END = len(PARTS)


def _read_output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the pieces of each output into its digest, and hands them on with their part of the original text, told from form and markers.

    After its pieces, a document is given its head and the digest as one more row, of part ``_END``.
    """
    out = _Rows(_READ)
    row = head = digest = None
    part = 0

    def end() -> None:
        out.add((row, _END, 0, None, *head, digest.hexdigest()))

    for batch in batches:
        names = ("row", "place", "mark", "body", *_HEAD)
        for this, place, mark, body, *values in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            if this != row:
                if row is not None:
                    end()
                row, head, digest, part = this, values, hashlib.sha256(), 0
            said = mark + body
            digest.update(said.encode())
            if head[2] != PLAIN and said[:3] in PARTS:  # texts hold no marker, so one can only be a part's beginning
                part, body = PARTS.index(said[:3]), said[3:]
            out.add((row, part, place, body, *(None,) * 5, None), len(body))
            if out.full():
                yield out.take()
    if row is not None:
        end()
    yield out.take()


_DONE = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
_DONE_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _read_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the pieces in the order of the original text into its digest; one row for each document."""
    out, digest = _Rows(_DONE), hashlib.sha256()
    for batch in batches:
        names = ("part", "body", *_HEAD, "output_sha256")
        for part, body, *values in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            if part < _END:
                digest.update(body.encode())
                continue
            out.add((*values, digest.hexdigest()))
            digest = hashlib.sha256()
            if out.full():
                yield out.take()
    yield out.take()


def digests(parts: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every output given as ``pieces``.

    Both sorts are within the partitions of one exchange. The first puts pieces in output order. Restoration knows outputs and
    forms only: which part a piece belongs to is read from the markers, and the second sort puts the parts back.
    """
    output = parts.repartition("row").sortWithinPartitions("row", "place").mapInArrow(_read_output, _READ_SCHEMA)
    return output.sortWithinPartitions("row", "part", "place").mapInArrow(_read_restored, _DONE_SCHEMA)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f for f in _DONE if f[0] in _HEAD]
    out = _Rows([*fields, ("output", pa.string())])
    row = head = None
    said: list[str] = []
    for batch in batches:
        for this, mark, body, *values in zip(*[batch.column(c).to_pylist() for c in ("row", "mark", "body", *_HEAD)], strict=True):
            if this != row:
                if row is not None:
                    text = "".join(said)
                    out.add((*head, text), len(text))
                    if out.full():
                        yield out.take()
                row, head, said = this, values, []
            said.append(mark + body)
    if row is not None:
        out.add((*head, "".join(said)))
    yield out.take()


def outputs(parts: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: the pieces of every output put together."""
    sorted_ = parts.repartition("row").sortWithinPartitions("row", "place")
    return sorted_.mapInArrow(_joined, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The original text of an output of a form, by Spark expressions: marked texts hold no other markers, so it splits at them."""
    parts = F.split(output, "|".join(PARTS), -1)
    back = {name: F.concat(*[F.get(parts, 1 + order.index(mark)) for mark in PARTS]) for name, order in FORMS.items()}
    return F.when(form == "psm", back["psm"]).when(form == "spm", back["spm"]).otherwise(output)


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, chunk: int = CHUNK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as training texts with a hole: ``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row.

    A text is cut at two of its units into prefix, middle and suffix. Its form is ``plain`` (the text as it is) if it is empty, holds a marker or its
    third draw is not below ``rate`` percent; else ``spm`` for ``spm`` percent of the fourth draws, or ``psm``. The marked parts follow in
    the form's order. ``n`` counts the units, ``prefix_chars`` and ``middle_chars`` code points (null if plain).

    Cuts and form follow from seed and id alone, so rows that repeat an id and text have equal outputs, each its own; a null id draws as an empty one,
    a null text is empty. Texts may be of any length: they are cut into pieces when they are read. Only id and text are read, so other
    columns may have any names; an empty table gives no rows. Rows are told apart by number, so ``docs`` should come in a repeatable
    order, as from a table.
    """
    return outputs(pieces(docs, seed, rate, spm, chunk, doc_id, text))
