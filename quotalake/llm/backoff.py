"""Stupid-backoff language-model scores of every document, from corpus n-gram counts.

The score of word i is the relative frequency of the longest n-gram ending at i
that the corpus holds outside the document itself,

    S = ALPHA ** (backed-off words) * c(n-gram) / c(its context)

down to c(word) / N, and ALPHA ** order / N for a word found nowhere else.  A
document's score is the mean of log S over its words.

Counts are relational, with the n-grams of a block of documents packed into
arrays so that a row carries many of them:

1. Documents are packed into blocks of about ``BLOCK_BYTES`` of text, written
   once, compressed.
2. Every block sends each of its distinct n-grams (all orders, as 64-bit hashes)
   once, with its count, to the count-table partition that its hash names.
   A frequent n-gram thus sends one entry per block, not one per occurrence.
3. Each partition adds up its part of the count table and answers every block,
   in the order of its request, with the occurrences outside that block.
4. Blocks are co-grouped with their answers and sum the scores per document.

A partition holds about ``PART_BYTES`` of text worth of n-grams, at most some
three million, so the number of partitions grows with the corpus and no task's
share does.  Within a partition an n-gram is known by ``HASH_BITS`` of its hash: the
chance that it is taken for another is about 1 in 10**8 at every corpus size.
This is the equality join of count tables with exploded n-grams, with a block's
n-grams in one row for each partition; there is no row for a single n-gram.

Cases: a null or empty text has no words and a null score.  Repeated rows are
separate documents, each counting for the other.  A very long text is a block by
itself.  A corpus of one document backs off everywhere.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C

ORDER = 3
ALPHA = 0.4
PART_BYTES = 4 << 20
HASH_BITS = 48
DELTA_BYTES = 5
SMALL = (1 << 16) - 1
BLOCK_BYTES = 4 << 20


def block_table(docs: DataFrame) -> DataFrame:
    """(block, doc_id array, size array, blob, bytes, words): the texts of a block as one zstd blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, block = zstandard.ZstdCompressor(level=9), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in C.byte_slices(whole, limit=BLOCK_BYTES):
                offsets, data = C.text_buffer(batch.column("text"))
                words = sum(len(C.tokenise(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], C.ALNUM).row)
                            for a, b in _slices(offsets))
                n = batch.num_rows
                one = np.array([0, n], np.int32)
                ids = batch.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.ListArray.from_arrays(pa.array(one), ids),
                     pa.ListArray.from_arrays(pa.array(one), pa.array(np.diff(offsets))),
                     pa.array([pack.compress(data.tobytes())], pa.binary()), pa.array([len(data)]), pa.array([words])],
                    names=["block", "doc_id", "size", "blob", "bytes", "words"])
                block += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.need(docs, "doc_id", "text").mapInArrow(
        run, f"block long, doc_id array<{kind}>, size array<long>, blob binary, bytes long, words long")


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``C.SLICE_BYTES`` of text (a longer text stays alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + C.SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop
        row = stop


class _Grams:
    """The n-grams of a block: their distinct hashes by partition, and each word's own."""

    def __init__(self, size: np.ndarray, blob: bytes, order: int, parts: int):
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
        rows, firsts, hashes, words = [], [[] for _ in range(order)], [[] for _ in range(order)], 0
        for a, b in _slices(offsets):  # bounds the temporaries of tokenising
            tokens = C.tokenise(offsets[a:b + 1] - offsets[a], C.ascii_lower(data[offsets[a]:offsets[b]]), C.ALNUM)
            rows.append(tokens.row + a)
            for n in range(1, order + 1):
                first, h = C.ngrams(tokens, n)
                firsts[n - 1].append(first + words)
                with np.errstate(over="ignore"):
                    hashes[n - 1].append(C.mix64(h + np.uint64(n)))
            words += len(tokens.row)
        none = np.empty(0, np.int64)
        self.row = np.concatenate([none, *rows])
        self.first = [np.concatenate([none, *x]) for x in firsts]
        every = [np.concatenate([none.view(np.uint64), *x]) for x in hashes]
        joined = np.concatenate(every)
        grams, inverse, counts = np.unique(joined, return_inverse=True, return_counts=True)
        part = (C.mix64(grams) % np.uint64(parts)).astype(np.int64)
        sort = np.argsort(part, kind="stable")
        place = np.empty(len(sort), np.int64)
        place[sort] = np.arange(len(sort))
        self.grams, self.counts, self.part = grams[sort], counts[sort], part[sort]
        #: of[n - 1][j]: place of the j-th n-gram (which starts at word first[n - 1][j])
        self.of = np.split(place[inverse], np.cumsum([len(x) for x in every])[:-1])


def requests(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(part, block, grams, counts): the distinct n-grams that a block asks a partition for.

    ``grams`` holds the leading ``HASH_BITS`` of the hashes, ascending, as differences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, size, blob in zip(*(batch.column(c) for c in ("block", "size", "blob"))):
                g = _Grams(size.values.to_numpy(), blob.as_py(), order, parts)
                if not len(g.grams):
                    continue
                start = np.concatenate([[0], np.flatnonzero(np.diff(g.part)) + 1])
                edges = np.append(start, len(g.part)).astype(np.int32)
                counts = g.counts.astype(np.uint32)
                packed = _differences(g.grams >> np.uint64(64 - HASH_BITS), edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.part[start]), pa.array(np.full(len(start), block.as_py())),
                     pa.array(packed, pa.binary()),
                     pa.array([_squeezed(counts[a:b], 4) for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.binary())],
                    names=["part", "block", "grams", "counts"])

    return blocks.select("block", "size", "blob").mapInArrow(
        run, "part long, block long, grams binary, counts binary")


def _squeezed(numbers: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned numbers, byte by byte of all of them, compressed."""
    size = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, size)[:, :width].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueezed(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


_MOST = (1 << 8 * DELTA_BYTES) - 1  # "so much further, and the difference goes on"


def _differences(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Ascending runs of values, each from 0 on, as numbers of ``DELTA_BYTES``, compressed run by run."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.int64)
    gaps[edges[:-1]] = values[edges[:-1]].astype(np.int64)
    more = gaps // _MOST
    at = np.cumsum(more + 1) - 1
    out = np.full(int(at[-1]) + 1 if len(at) else 0, _MOST, np.uint64)
    out[at] = (gaps - more * _MOST).astype(np.uint64)
    ends = np.concatenate([[0], at + 1])[edges].tolist()
    return [_squeezed(out[a:b], DELTA_BYTES) for a, b in zip(ends, ends[1:])]


def _values(blobs: list[bytes]) -> np.ndarray:
    """The values of runs of differences, one run after the other."""
    runs = []
    for blob in blobs:
        gaps = _unsqueezed(blob, DELTA_BYTES)
        runs.append(np.cumsum(gaps)[gaps != _MOST])
    return np.concatenate([np.empty(0, np.uint64), *runs])


def _answer(table: pa.Table) -> pa.Table:
    """Add up one partition of the count table and answer each of its requests."""
    asked = _values(table.column("grams").to_pylist())
    runs = [_unsqueezed(b, 4).astype(np.int64) for b in table.column("counts").to_pylist()]
    counts, size = np.concatenate(runs), np.array([len(r) for r in runs])
    _, inverse = np.unique(asked, return_inverse=True)
    totals = np.bincount(inverse, weights=counts).astype(np.int64)[inverse] - counts
    return _packed(table.column("part"), table.column("block"), totals, size)


def _packed(part: pa.ChunkedArray, block: pa.ChunkedArray, others: np.ndarray, size: np.ndarray) -> pa.Table:
    """Occurrences outside the block, for each request, as two-byte numbers; ``at`` and ``big`` hold the others."""
    edges = np.concatenate([[0], np.cumsum(size)])
    small = np.minimum(others, SMALL).astype("<u2")
    place = np.flatnonzero(others >= SMALL)
    row = np.searchsorted(edges, place, side="right") - 1
    cuts = pa.array(np.searchsorted(row, np.arange(len(size) + 1)).astype(np.int32))
    return pa.table({
        "part": part, "block": block,
        "small": pa.array([_squeezed(small[a:b], 2) for a, b in zip(edges.tolist(), edges[1:].tolist())], pa.binary()),
        "at": pa.ListArray.from_arrays(cuts, pa.array((place - edges[row]).astype(np.int32))),
        "big": pa.ListArray.from_arrays(cuts, pa.array(others[place]))})


def _unpacked(answers: pa.Table) -> np.ndarray:
    """All numbers of the rows in order."""
    none = np.empty(0, np.int64)
    runs = [_unsqueezed(b, 2).astype(np.int64) for b in answers.column("small").to_pylist()]
    found = np.concatenate([none, *runs])
    start = np.cumsum([0, *map(len, runs)])[:-1]
    count = np.concatenate([none, *[x.value_lengths().to_numpy() for x in answers.column("at").chunks]])
    at, big = (np.concatenate([none, *[x.flatten().to_numpy() for x in answers.column(c).chunks]]) for c in ("at", "big"))
    found[np.repeat(start, count) + at] = big
    return found


def _score_block(blocks: pa.Table, answers: pa.Table, order: int, parts: int, alpha: float, words: int,
                 leave_out: bool) -> pa.Table:
    row = blocks.slice(0, 1).to_pydict()
    size = np.array(row["size"][0], np.int64)
    g = _Grams(size, row["blob"][0], order, parts)
    n = len(size)
    total = g.counts + _unpacked(answers.sort_by("part"))
    n_words = np.bincount(g.row, minlength=n)
    # occurrences within the document itself, for every n-gram of it
    known, logs = [], np.zeros(len(g.row))
    for k in range(order):
        doc = g.row[g.first[k]]
        own = np.zeros(len(doc), np.int64)
        if leave_out:
            _, inverse, counts = np.unique(g.of[k] * n + doc, return_inverse=True, return_counts=True)
            own = counts[inverse]
        known.append(total[g.of[k]] - own)
    outside = np.maximum(words - n_words[g.row] * leave_out, 1)
    single = known[0]
    with np.errstate(divide="ignore"):
        logs = np.where(single > 0, np.log(np.maximum(single, 1) / outside) + (order - 1) * np.log(alpha),
                        order * np.log(alpha) - np.log(outside))
    for k in range(1, order):  # longer n-grams replace shorter ones where they are known
        context = np.zeros(len(g.row), np.int64)
        context[g.first[k - 1]] = known[k - 1]
        ok = known[k] > 0
        first = g.first[k][ok]
        logs[first + k] = np.log(known[k][ok] / context[first]) + (order - 1 - k) * np.log(alpha)
    sums = np.bincount(g.row, weights=logs, minlength=n)
    pa.default_memory_pool().release_unused()
    mean = np.divide(sums, n_words, out=np.full(n, np.nan), where=n_words > 0)
    return pa.table({"doc_id": blocks.column("doc_id").chunk(0)[0].values, "n_words": pa.array(n_words),
                     "log_score": pa.array(sums), "mean_log_score": pa.array(mean, mask=n_words == 0)})


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, leave_out: bool = True) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row."""
    blocks = C.materialise(block_table(docs), codec="uncompressed")
    size, words = blocks.agg(F.sum("bytes"), F.sum("words")).first()
    parts = max(64, -(-(size or 0) // PART_BYTES))
    total = words or 0
    answers = (requests(blocks, order, parts).groupBy("part")
               .applyInArrow(_answer, "part long, block long, small binary, at array<int>, big array<long>"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score_block(left, right, order, parts, alpha, total, leave_out)

    return (blocks.select("block", "doc_id", "size", "blob").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(run, f"doc_id {kind}, n_words long, log_score double, mean_log_score double"))
