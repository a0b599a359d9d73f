"""Helpers shared by the corpus operators: scratch tables and vectorised tokenising.

Tokenising works on the UTF-8 bytes of a whole Arrow batch at once: a
256-entry class table finds the token boundaries, and one prefix sum of
``byte * base**position`` gives a 64-bit polynomial hash of every token.
"""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quotalake.session import shared_scratch

#: Bytes of text that are tokenised together; bounds the numpy temporaries.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def scratch_path(spark: SparkSession) -> str:
    """A fresh folder name below the shared ``spark.checkpoint.dir``."""
    return f"{shared_scratch(spark)}/quotalake-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a shared Parquet table and read it back (cuts the lineage).

    Row order inside a written part file is kept, and a lost executor only costs
    a re-read, which is why iterative steps use this and not a cached frame.
    What the write shuffled is deleted with it: nothing reads it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package's Python code to the executors (once per session).

    Python workers import the operators by name; a job whose driver put the
    package on ``sys.path`` itself would not find it there otherwise.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quotalake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="quotalake-code-"), "quotalake"),
                                  "zip", root, "quotalake")
    sc.addPyFile(archive)
    sc._quotalake_shipped = True


def give_back() -> None:
    """Return freed memory to the system: a Python worker waits for its next task with what it keeps."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def need(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, so that extra columns can clash with nothing."""
    return df.select(*[df[c] for c in columns])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- batches ---------------------------------------------------------------

def byte_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes (a longer row stays alone)."""
    offsets, _ = text_buffer(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield batch.slice(start, stop - start)
        start = stop


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    if n == 0:
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


# --- byte classes ----------------------------------------------------------

def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry 0/1 table that is 1 on the given inclusive byte ranges."""
    table = np.zeros(256, np.uint8)
    for lo, hi in ranges:
        table[lo:hi + 1] = 1
    return table


#: Everything but ASCII white space.
NOT_SPACE = 1 - byte_class((0x20, 0x20), (0x09, 0x0D))
#: Digits, ASCII letters and every non-ASCII byte.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: 1 for ALNUM, 2 for the other visible ASCII bytes, 0 for white space.
WORD_OR_PUNCT = (NOT_SPACE * (2 - ALNUM)).astype(np.uint8)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z only."""
    return _LOWER[data]


# --- tokens ----------------------------------------------------------------

@dataclass
class Tokens:
    """Tokens of a slice: byte range, row and 64-bit hash of each, in text order."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]),
                              dtype=np.uint64)
        if size > 8 * SLICE_BYTES:  # one very long text: do not keep its table
            return have
        _powers[name] = have
    return have


def mix64(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def tokenise(offsets: np.ndarray, data: np.ndarray, classes: np.ndarray) -> Tokens:
    """Maximal runs of one non-zero byte class; runs never cross rows."""
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Tokens(none, none, none, np.empty(0, np.uint64))
    kind = classes[data]
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change[offsets] = True
    edge = np.flatnonzero(change)
    start, end = edge[:-1], edge[1:]
    real = kind[start] != 0
    start, end = start[real], end[real]
    row = np.searchsorted(offsets, start, side="right") - 1
    return Tokens(start, end, row, hash_ranges(data, start, end))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``data[start:end]`` (equal contents give equal hashes)."""
    n = len(data)
    up, down = _power_table(_BASE, n + 1, "up"), _power_table(_BASE_INV, n + 1, "down")
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        poly = (sums[end] - sums[start]) * down[start]
        return mix64(poly + (end - start).astype(np.uint64) * _BASE)


def hash_bytes(value: bytes) -> int:
    """The same hash for one token."""
    data = np.frombuffer(value, np.uint8)
    return int(hash_ranges(data, np.array([0]), np.array([len(data)]))[0])


def ngrams(tokens: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of first token, hash) of every run of ``n`` tokens of one row."""
    count = len(tokens.row) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    same = tokens.row[:count] == tokens.row[n - 1:]
    h = tokens.hash[:count]
    with np.errstate(over="ignore"):
        for i in range(1, n):
            h = mix64(h * _BASE + tokens.hash[i:count + i])
    first = np.flatnonzero(same)
    return first, h[first]


def bincount(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Per-row counts, or sums of ``weights``, for ``n`` rows."""
    return np.bincount(rows, weights=weights, minlength=n)


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's BIGINT."""
    return h.view(np.int64)
