"""Fill-in-the-middle transformation by displacement scatter.

A text is cut at two line boundaries into prefix, middle and suffix and written
again with the middle last, either as ``<P>prefix<S>suffix<M>middle`` (psm) or as
``<S>suffix<P>prefix<M>middle`` (spm).  The cuts and the form come from a hash of
the seed and the document id, so a lost task computes the same rows again.

All texts of a slice are one byte array.  A scan of its line ends gives the cuts;
every piece moves as a whole, so a difference array that is non-zero at piece
starts only, summed up, holds the shift of every byte, and one numpy scatter
builds all outputs.  ``restore`` finds the sentinels of each output, sums up the
same kind of difference array and gathers the bytes back.  Both walk through the
bytes in windows of ``WINDOW``: besides a text and its output, memory does not
depend on how long the text is or how many lines it has.

Cases: a null text is an empty one.  An empty text, a text that holds a sentinel
and a document beyond ``fim_rate`` stay as they are (form plain, no piece
lengths).  A null doc_id hashes as an empty string.  Repeated rows give repeated
results.  Only doc_id and text are read, so other columns can clash with
nothing.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C

SEED = 7
FIM_RATE = 100
SPM_RATE = 50
WINDOW = 1 << 20

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_FORMS = np.array([PLAIN, PSM, SPM])
_MARK = np.zeros(256, bool)
_MARK[[PREFIX[1], SUFFIX[1], MIDDLE[1]]] = True


# --- scans -------------------------------------------------------------------

def _windows(n: int) -> Iterator[tuple[int, int]]:
    for lo in range(0, n, WINDOW):
        yield lo, min(lo + WINDOW, n)


def count_before(flags, data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each of the ascending byte ``points``: how many flagged bytes stand before it."""
    out, total = np.zeros(len(points), np.int64), 0
    for lo, hi in _windows(len(data)):
        here = np.flatnonzero(flags(data[lo:hi])) + lo
        first, last = np.searchsorted(points, lo), np.searchsorted(points, hi)
        out[first:last] = total + np.searchsorted(here, points[first:last])
        total += len(here)
    out[np.searchsorted(points, len(data)):] = total
    return out


def _is_line_end(data: np.ndarray) -> np.ndarray:
    return data == 10


def _starts_char(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def line_ends(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Byte positions of the line ends with these ranks (the first line end of ``data`` has rank 0)."""
    out, total = np.zeros(len(ranks), np.int64), 0
    for lo, hi in _windows(len(data)):
        here = np.flatnonzero(data[lo:hi] == 10) + lo
        inside = (ranks >= total) & (ranks < total + len(here))
        out[inside] = here[ranks[inside] - total]
        total += len(here)
    return out


def sentinels(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of every sentinel that lies inside one row, in order."""
    found = []
    for lo, hi in _windows(len(data)):
        at = np.flatnonzero(data[lo:hi] == PREFIX[0]) + lo
        at = at[at + 2 < len(data)]
        found.append(at[_MARK[data[at + 1]] & (data[at + 2] == PREFIX[2])])
    at = np.concatenate(found) if found else np.empty(0, np.int64)
    row = np.searchsorted(offsets, at, side="right") - 1
    whole = at + 3 <= offsets[row + 1]
    return row[whole], at[whole]


# --- displacement ------------------------------------------------------------

def displaced(starts: np.ndarray, shifts: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, target of each byte of [lo, hi)): piece i begins at ``starts[i]`` and moves by ``shifts[i]``.

    The steps from one shift to the next are the difference array, its running
    sum the shift of every byte.
    """
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for lo, hi in _windows(n):
        first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
        change = np.zeros(hi - lo, np.int64)
        np.add.at(change, starts[first:last] - lo, steps[first:last])
        change[0] += carry
        shift = np.cumsum(change)
        carry = int(shift[-1])
        yield lo, hi, shift + np.arange(lo, hi)


def _in_order(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                       pa.py_buffer(data))


def rearrange(offsets: np.ndarray, data: np.ndarray, h: np.ndarray, fim_rate: int, spm_rate: int) -> dict:
    """Columns of one slice; ``h`` holds the four hash numbers of each row."""
    start, end = offsets[:-1], offsets[1:]
    ends_before = count_before(_is_line_end, data, offsets)
    n = np.diff(ends_before)
    open_end = np.zeros(len(n), bool)
    filled = end > start
    open_end[filled] = data[end[filled] - 1] != 10
    n = n + open_end
    plain = ~filled | (h[2] % 100 >= fim_rate)
    plain[sentinels(data, offsets)[0]] = True
    form = np.where(plain, 0, np.where(h[3] % 100 < spm_rate, 2, 1))

    draws = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    cuts = []
    for units in draws:  # a cut stands behind its last line, at the row's start, or at its open end
        inside = (units > 0) & ~((units == n) & open_end)
        at = np.where(units == 0, start, end)
        at[inside] = line_ends(data, ends_before[:-1][inside] + units[inside] - 1) + 1
        cuts.append(at)
    cut1, cut2 = np.where(plain, end, cuts[0]), np.where(plain, end, cuts[1])

    lp, ls = cut1 - start, end - cut2
    out_offsets = np.concatenate([[0], np.cumsum(end - start + 9 * ~plain)])
    out0 = out_offsets[:-1]
    spm = form == 2
    prefix_at = np.where(plain, out0, out0 + 3 + np.where(spm, ls + 3, 0))
    suffix_at = out0 + 3 + np.where(spm, 0, lp + 3)
    middle_at = out0 + 9 + lp + ls
    pieces = _in_order(start, cut1, cut2)
    shifts = _in_order(prefix_at - start, middle_at - cut1, suffix_at - cut2)
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for lo, hi, target in displaced(pieces, shifts, len(data)):
        out[target] = data[lo:hi]
    moved = ~plain
    for mark, behind in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        for i, byte in enumerate(mark):
            out[behind[moved] - 3 + i] = byte
    chars = count_before(_starts_char, data, pieces).reshape(-1, 3)
    return {"n_lines": pa.array(n), "form": pa.array(_FORMS[form]),
            "prefix_chars": pa.array(chars[:, 1] - chars[:, 0], mask=plain),
            "middle_chars": pa.array(chars[:, 2] - chars[:, 1], mask=plain),
            "output": _strings(out_offsets, out)}


def put_back(offsets: np.ndarray, out: np.ndarray, form: np.ndarray) -> pa.Array:
    """The texts of one slice of outputs."""
    start, end = offsets[:-1], offsets[1:]
    moved = form != PLAIN
    row, at = sentinels(out, offsets)
    at = at[moved[row]]
    if not np.array_equal(row[moved[row]], np.repeat(np.flatnonzero(moved), 3)):
        raise ValueError("an output does not hold exactly three sentinels")
    first, second, third = at.reshape(-1, 3).T
    lead = np.where(form[moved] == SPM, SUFFIX[1], PREFIX[1])
    if not (np.array_equal(first, start[moved]) and np.array_equal(out[first + 1], lead)
            and (out[third + 1] == MIDDLE[1]).all()):
        raise ValueError("an output does not have the sentinels of its form")
    spm = form[moved] == SPM
    lead_at, lead_n, next_at, next_n = first + 3, second - first - 3, second + 3, third - second - 3
    lp = np.where(spm, next_n, lead_n)
    lm = end[moved] - third - 3
    text_offsets = np.concatenate([[0], np.cumsum(end - start - 9 * moved)])
    text0 = text_offsets[:-1]
    cut1, cut2 = text0.copy(), text0.copy()
    source = np.repeat((start - text0)[:, None], 3, axis=1)
    cut1[moved] += lp
    cut2[moved] += lp + lm
    source[moved, 0] = np.where(spm, next_at, lead_at) - text0[moved]
    source[moved, 1] = third + 3 - cut1[moved]
    source[moved, 2] = np.where(spm, lead_at, next_at) - cut2[moved]
    text = np.empty(int(text_offsets[-1]), np.uint8)
    for lo, hi, target in displaced(_in_order(text0, cut1, cut2), source.ravel(), len(text)):
        text[lo:hi] = out[target]
    return _strings(text_offsets, text)


# --- Spark -------------------------------------------------------------------

_COLUMNS = "n_lines long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n_lines, form, prefix_chars, middle_chars (code points) and output of every document."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C.byte_slices(whole):
                draws = np.stack([batch.column(f"h{i}").to_numpy() for i in range(4)])
                done = rearrange(*C.text_buffer(batch.column("text")), draws, fim_rate, spm_rate)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *done.values()], ["doc_id", *done])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs["text"], *h).mapInArrow(run, f"doc_id {kind}, {_COLUMNS}")


def restore(done: DataFrame) -> DataFrame:
    """``transform``'s rows with the column ``restored``: each text, rebuilt from output and form alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C.byte_slices(whole, "output"):
                form = np.array(batch.column("form").to_pylist(), dtype=object)
                text = put_back(*C.text_buffer(batch.column("output")), form)
                yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in done.schema)
    return done.mapInArrow(run, f"{fields}, restored string")
