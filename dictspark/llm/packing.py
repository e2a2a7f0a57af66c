"""Packing by power-of-two decomposition: every sequence is a piece of one document, so none needs padding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MAX_LENGTH = 4096
END_OF_DOCUMENT = 2
#: Words and word parts whose ids a worker remembers; others are encoded again.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
BLOCK_CHARS = 1 << 20
#: Bytes of texts whose words are told apart together.
SLICE = 16 << 20

# White space beyond ASCII's is left to the tokenizer, as is a word with other characters than these.
_ODD_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
_PLAIN_WORD = re.compile("[!-~\\xc0-\\xff]*")
_SPACE = re.compile("[ \t\n\r\f\v]")
# The split pattern of the word tokenizer for lower-case plain words (fixed by its file).
_PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_PART_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class WordIds:
    """Token ids of texts, remembered by word.

    A tokenizer that drops white space and never joins across it gives a text the ids of its words in order. Words of plain
    characters are cut further, as the tokenizer cuts them, so that its work is done once for every part seen.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for parts that are cut and lower-case already
        self.of_parts = Tokenizer.from_file(path)
        self.of_parts.normalizer = normalizers.Sequence([])
        self.of_parts.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = spec["normalizer"] is not None and _PART_PATTERN in json.dumps(spec["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = self.by_word and bool(suffix)
        if self.by_word:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_parts(self, parts: list[str]) -> dict[str, bytes]:
        ids = np.array(self.of_parts.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):
            return {p: self._encode(p) for p in parts}
        starts = np.concatenate([[0], ends[:-1]])
        return {p: ids[s:e].tobytes() for p, s, e in zip(parts, starts.tolist(), ends.tolist(), strict=True)}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered."""
        known, cut, parts_of = {}, {}, _PART.findall
        for word in words:
            if word.isascii() and word.isalpha():
                cut[word] = [word.lower()]
            elif _PLAIN_WORD.fullmatch(word) and "<|" not in word:
                cut[word] = parts_of(word.lower())
            else:
                known[word] = self._encode(word)
        missing = list({p for own in cut.values() for p in own if p not in self.parts})
        fresh: dict[str, bytes] = {}
        for i in range(0, len(missing), 4096):
            fresh |= self._learn_parts(missing[i : i + 4096])
        room = REMEMBERED - len(self.parts)
        for part in missing[: max(0, room)]:
            if len(part) <= LONGEST_REMEMBERED:
                self.parts[part] = fresh[part]
        for word, own in cut.items():
            known[word] = b"".join([self.parts.get(p) or fresh[p] for p in own])
        for word in words[: max(0, REMEMBERED - len(self.words))]:
            if len(word) <= LONGEST_REMEMBERED:
                self.words[word] = known[word]
        return known

    def _plain(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without odd white space: their words are told apart and looked up once each."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.words.get, distinct))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        if unknown:
            fresh = self._learn([distinct[i] for i in unknown])
            for i in unknown:
                found[i] = fresh[distinct[i]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        known = np.frombuffer(b"".join(found), "<u4")
        at = coded.indices.to_numpy()
        sizes, starts = sizes[at], (np.cumsum(sizes) - sizes)[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = known[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids, np.diff(bounds)

    def _blocks(self, text: str) -> pa.StringArray:
        """A long text in blocks that end before white space."""
        found, at = [], 0
        while at < len(text):
            end = at + BLOCK_CHARS
            if end < len(text):
                gap = _SPACE.search(text, end)
                end = gap.start() if gap else len(text)
            found.append(text[at:end])
            at = end
        return pa.array(found, pa.string())

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each has."""
        sizes = np.zeros(len(texts), np.int64)
        found: list[np.ndarray | None] = [None] * len(texts)
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False) if self.by_word else np.ones(len(texts), bool)
        long = ~odd & (pc.utf8_length(texts).to_numpy() > BLOCK_CHARS)
        plain = np.flatnonzero(~odd & ~long)
        ids, own = self._plain(texts if len(plain) == len(texts) else texts.take(pa.array(plain)))
        if len(plain) == len(texts):
            return ids, own
        for i, part in zip(plain.tolist(), np.split(ids, np.cumsum(own)[:-1]), strict=True) if len(plain) else ():
            found[i] = part
        for i in np.flatnonzero(odd).tolist():
            found[i] = np.frombuffer(self._encode(texts[i].as_py()), "<u4")
        for i in np.flatnonzero(long).tolist():
            blocks = self._blocks(texts[i].as_py())
            found[i] = np.concatenate([self._plain(blocks.slice(j, 4))[0] for j in range(0, len(blocks), 4)])
        sizes[:] = [len(f) for f in found]
        return np.concatenate([np.zeros(0, np.uint32), *found]), sizes


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def piece_lengths(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the pieces of documents of so many ids, document after document, and each piece's document: whole lengths of ``longest`` (a power of two), then falling powers of two."""
    bits = np.arange(longest.bit_length() - 1, -1, -1)
    often = (sizes[:, None] >> bits) & 1
    often[:, 0] = sizes // longest
    return np.repeat(np.tile(1 << bits, len(sizes)), often.ravel()), np.repeat(np.arange(len(sizes)), often.sum(1))


def _pack(batches: Iterator[pa.RecordBatch], path: str, longest: int, end_id: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoder = word_ids(path)
    first, at = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        for part in slices(batch, 1, SLICE):
            own, sizes = encoder.ids(pc.fill_null(part.column(1), ""))
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            ids = np.full(ends[-1], end_id, "<u4")
            text = np.ones(len(ids), bool)
            text[ends - 1] = False
            ids[text] = own
            lengths, doc = piece_lengths(sizes, longest)
            stops = np.cumsum(lengths)
            bucket = np.log2(lengths).astype(np.int32)
            offsets = pa.py_buffer(np.concatenate([[0], 4 * stops]).astype(np.int32))
            columns = {
                "doc_id": part.column(0).take(pa.array(doc)),
                "start": stops - lengths - (ends - sizes)[doc],
                "length": lengths,
                "ids": pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(ids)]),
                "doc_tokens": sizes[doc],
                "sequence_id": bucket.astype(np.int64) << 56 | first | (at + np.arange(len(lengths))),
                "offset": np.zeros(len(lengths), np.int64),
                "bucket": bucket,
            }
            at += len(lengths)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], schema=schema)


def pack(docs: DataFrame, tokenizer: str, longest: int = MAX_LENGTH, end_id: int = END_OF_DOCUMENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket``.

    The ids of a document and ``end_id`` are cut into pieces of ``longest`` ids and then into the powers of two that its rest
    is the sum of. A piece is a sequence: its length is a power of two, so it has no padding and holds one document only, and
    ``offset`` is 0. ``bucket`` is the length's power: batches are made of equal buckets. ``sequence_id`` sorts by bucket;
    it is unique among the rows of one run. ``ids`` holds little-endian unsigned 32-bit numbers.

    Nothing is shuffled: a document's pieces need no other document. A null or empty text gives the one id ``end_id``; a null
    ``doc_id`` is kept as it is, and repeated rows each give their pieces. Other columns are not read. An empty table gives no
    rows. ``tokenizer`` is a file that every worker can read. Long texts are encoded in blocks that end at white space.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest length must be a power of two, not {longest}")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("bucket", pa.int32())])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    work = partial(_pack, path=tokenizer, longest=longest, end_id=end_id, schema=schema)
    return rows.mapInArrow(work, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int")


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
