"""Packing by concatenate and cut, with two-pass prefix sums for the offsets.

All documents' token ids, each document's end id included, form one stream that
is cut into sequences of ``SEQUENCE`` tokens; a piece is the part of a document
inside one sequence.

Pass 1 tokenises every text once and writes (partition, start inside the
partition, ids) to the shared scratch folder.  The partitions' token totals, one
number each, give by a prefix sum the offset of every partition in the stream.
Pass 2 adds it to each document's own start, which fixes its pieces without any
exchange of rows.  Only the last sequence is padded.

Token ids come from the tokenizer file itself.  A text is split at ASCII white
space, where its pre-tokenizer always splits and its normaliser never joins, and
before the marks that end a word; so the ids of a part do not depend on its
neighbours and are kept in a table by the part's 64-bit hash (at most about
``CACHE_WORDS`` parts, then the table starts anew).

Cases: a null or empty text is the end id alone.  A very long text is cut at
every sequence boundary.  Repeated rows are packed each by itself.  Extra
columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotalake.llm import common as C

SEQUENCE = 2048
END_ID = 1
CACHE_WORDS = 600_000
SLICE_BYTES = 2 << 20
MAX_BROADCAST_PARTS = 1 << 20


# Bytes as the byte-level alphabet writes them: printable Latin-1 as itself, the rest from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_REST = [b for b in range(256) if b not in set(_PRINTABLE)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_REST)}
_LATIN1 = [_ALPHABET[b] for b in range(256)]
# Lower-case words that the normaliser and pre-tokenizer leave whole.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")

_LETTER = C.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)).astype(bool)
_ASCII_LETTER = C.byte_class((0x41, 0x5A), (0x61, 0x7A)).astype(bool)
_NO_TAIL = C.byte_class((0x30, 0x39), (0x27, 0x27)).astype(bool)  # digits, apostrophe


def units(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, C.Tokens]:
    """(bytes lower-cased in A-Z (see below), parts of the texts whose ids do not depend on each other).

    A part is a run without ASCII white space; marks that end it behind a letter
    are a part by themselves, which the pre-tokenizer would split off as well.
    Texts with a special token's "<|" keep their case and their runs whole.  So does
    a letter before a non-ASCII byte: the normaliser composes marks with it before
    it lower-cases, and some marks compose with the small letter only.
    """
    lowered = C.ascii_lower(data)
    marked = np.flatnonzero(data[1:] >= 0x80)
    lowered[marked] = data[marked]
    special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
    rows = np.unique(np.searchsorted(offsets, special, side="right") - 1)
    for r in rows.tolist():
        lowered[offsets[r]:offsets[r + 1]] = data[offsets[r]:offsets[r + 1]]
    runs = C.tokenise(offsets, lowered, C.NOT_SPACE)
    if not len(runs.start):
        return lowered, runs
    letter = _LETTER[lowered]
    last = np.maximum.accumulate(np.where(letter, np.arange(len(lowered)), -1))[runs.end - 1]
    other = np.concatenate([[0], np.cumsum(_NO_TAIL[lowered])])
    before = lowered[np.maximum(last - 1, 0)]
    at = lowered[np.maximum(last, 0)]
    known = _ASCII_LETTER[at] | ((before == 0xC3) & (at >= 0x80) & (at != 0x97) & (at != 0xB7))
    split = ((last >= runs.start) & (last < runs.end - 1) & known & (other[runs.end] == other[last + 1])
             & ~np.isin(runs.row, rows))
    cut = last[split] + 1
    start = np.concatenate([runs.start, cut])
    end = np.concatenate([np.where(split, last + 1, runs.end), runs.end[split]])
    row = np.concatenate([runs.row, runs.row[split]])
    order = np.argsort(start, kind="stable")
    start, end, row = start[order], end[order], row[order]
    return lowered, C.Tokens(start, end, row, C.hash_ranges(lowered, start, end))


class _Encoder:
    """Token ids of texts by way of a table of the ids of known parts, by their 64-bit hash."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)  # sorted
        self.slot = np.empty(0, np.int64)  # of keys[i]: ids[start[slot]:start[slot + 1]]
        self.start = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _encode_parts(self, parts: list[bytes]) -> list[list[int]]:
        model, out, others = self.tokenizer.model, [], []
        for i, part in enumerate(parts):
            word = part.decode("utf-8", "replace").lower()
            if _PLAIN.fullmatch(word):
                mapped = word if word.isascii() else "".join([_LATIN1[b] for b in word.encode()])
                out.append([t.id for t in model.tokenize(mapped)])
            else:
                out.append([])
                others.append(i)
        if others:
            encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
            texts = [parts[i].decode("utf-8", "replace") for i in others]
            for i, encoding in zip(others, encode(texts, add_special_tokens=False)):
                out[i] = encoding.ids
        return out

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per text, all ids in order), end ids not included."""
        n = len(offsets) - 1
        lowered, tokens = units(offsets, data)
        if not len(tokens.start):
            return np.zeros(n, np.int64), np.empty(0, np.uint32)
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        distinct, first, inverse = np.unique(tokens.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            where = first[~known]
            found = self._encode_parts([lowered[a:b].tobytes() for a, b in zip(tokens.start[where].tolist(),
                                                                               tokens.end[where].tolist())])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))])
            new_slot = len(self.start) - 1 + np.arange(len(found))
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
            keys = np.concatenate([self.keys, distinct[~known]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.slot = keys[order], np.concatenate([self.slot, new_slot])[order]
            at = np.searchsorted(self.keys, distinct)
        slot = self.slot[at][inverse]
        begin = self.start[slot]
        size = self.start[slot + 1] - begin
        done = np.cumsum(size)
        ids = self.ids[np.repeat(begin - (done - size), size) + np.arange(int(done[-1]))]
        ends = np.concatenate([[0], done])
        return np.diff(ends[np.searchsorted(tokens.row, np.arange(n + 1))]), ids


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """One encoder, with its cache, per Python worker."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(part, start, doc_id, n, ids): ids as little-endian uint32, start inside the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in C.byte_slices(whole, limit=SLICE_BYTES):
                counts, ids = encoder.encode(*C.text_buffer(batch.column("text")))
                n = counts + 1
                stop = np.cumsum(n)
                out = np.full(int(stop[-1]), end_id, np.uint32)
                keep = np.ones(len(out), bool)
                keep[stop - 1] = False
                out[keep] = ids
                offsets = pa.array(np.concatenate([[0], 4 * stop]).astype(np.int32))
                blobs = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets.buffers()[1], pa.py_buffer(out.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), pa.array(at + stop - n),
                     batch.column("doc_id"), pa.array(n), blobs],
                    names=["part", "start", "doc_id", "n", "ids"])
                at += int(stop[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.need(docs, "doc_id", "text").mapInArrow(
        run, f"part long, start long, doc_id {kind}, n long, ids binary")


def _cut(sequence: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy()
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            pieces = (first + n - 1) // sequence - first // sequence + 1
            row = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            where = first[row] // sequence + number
            begin = np.maximum(first[row], where * sequence)
            end = np.minimum(first[row] + n[row], (where + 1) * sequence)
            start, length = begin - first[row], end - begin
            ids = batch.column("ids")
            blobs, held, blob = [], -1, b""
            for r, s, size in zip(row.tolist(), start.tolist(), length.tolist()):
                if r != held:
                    held, blob = r, ids[r].as_py()
                blobs.append(blob[4 * s:4 * (s + size)])
            crc = np.fromiter(map(zlib.crc32, blobs), np.int64, len(blobs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc),
                 pa.array(n[row]), pa.array(where), pa.array(begin % sequence), pa.array(blobs, pa.binary())],
                names=names)

    return run


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids."""
    rows = C.materialise(tokenised(docs, tokenizer, end_id))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per input partition: the totals of the first pass
    offsets = (rows.groupBy("part").agg(F.sum("n").alias("total"))
               .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    if offsets.count() <= MAX_BROADCAST_PARTS:  # else the totals are joined by a shuffle
        offsets = F.broadcast(offsets)
    placed = rows.join(offsets, "part").select((F.col("base") + F.col("start")).alias("first"), "doc_id", "n", "ids")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(
        _cut(sequence), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids binary")
