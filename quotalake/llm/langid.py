"""Language identification with hyperdimensional profiles.

Every letter (and the word break) has a random vector of +1/-1 in ``DIMENSIONS``
dimensions, drawn from its code point.  A trigram's vector binds its letters'
vectors, each permuted by its place: roll(a, 2) * roll(b, 1) * c.  A document's
vector bundles (sums) the vectors of its trigrams, a language's prototype those
of all training documents of the language.  The predicted language has the
largest cosine with the document's vector; ties go to the first in sort order.

Training sums every training document; what reaches the driver is one vector
per language, so the bound is DIMENSIONS numbers per distinct ``lang`` value
(at most ``MAX_LANGUAGES`` of them, else an error, never a silent cut).

Cases: a null text, or one without a letter, is ``und`` with score 0.  A null
lang or doc_id is never learned from (a null id is not held out either).  Without training rows everything is ``und``.
Repeated rows are counted and predicted each.  A very long text is read whole.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C

DIMENSIONS = 1024
MAX_LANGUAGES = 4096
MAX_TABLE = 20_000  # trigram vectors kept per worker
UNKNOWN = "und"

_SHIFT = np.int64(21)  # a code point has at most 21 bits
_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every trigram; runs of non-letters are one break, as are both ends."""
    lowered = [f" {t.lower()} " if t else "" for t in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), size)
    is_letter = _letters()[code]
    code[~is_letter] = 0
    keep = is_letter.copy()
    if len(code):
        keep[0] = True
        keep[1:] |= is_letter[:-1] | (row[1:] != row[:-1])  # the first of a run of breaks
    code, row = code[keep], row[keep]
    if len(code) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    same = row[2:] == row[:-2]
    key = (((code[:-2] << _SHIFT) | code[1:-1]) << _SHIFT) | code[2:]
    return row[:-2][same], key[same]


class _Space:
    """Vectors of letters and trigrams, made when first needed."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letter: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.int64)
        self.order = np.empty(0, np.int64)
        self.table = np.empty((0, self.dimensions), np.float32)

    def _of_letter(self, code: int) -> np.ndarray:
        if code not in self.letter:
            bits = np.random.Generator(np.random.Philox(code)).integers(0, 2, self.dimensions)
            self.letter[code] = (2 * bits - 1).astype(np.float32)
        return self.letter[code]

    def _bind(self, keys: np.ndarray) -> np.ndarray:
        mask = (1 << 21) - 1
        out = np.empty((len(keys), self.dimensions), np.float32)
        for i, key in enumerate(keys.tolist()):
            a, b, c = key >> 42, key >> 21 & mask, key & mask
            out[i] = np.roll(self._of_letter(a), 2) * np.roll(self._of_letter(b), 1) * self._of_letter(c)
        return out

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Table rows of sorted distinct ``keys``."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        if not known.all():
            new = keys[~known]
            if len(self.keys) + len(new) > MAX_TABLE and len(self.keys):
                self.clear()
                return self.rows(keys)
            self.order = np.concatenate([self.order, len(self.table) + np.arange(len(new))])
            self.table = np.concatenate([self.table, self._bind(new)])
            self.keys = np.concatenate([self.keys, new])
            sort = np.argsort(self.keys, kind="stable")
            self.keys, self.order = self.keys[sort], self.order[sort]
            at = np.searchsorted(self.keys, keys)
        return self.order[at]

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors of ``keys`` times their counts, in parts that fit the table."""
        total = np.zeros(self.dimensions)
        for i in range(0, len(keys), MAX_TABLE):
            part = keys[i:i + MAX_TABLE]
            total += counts[i:i + MAX_TABLE].astype(np.float32) @ self.table_of(part)
        return total

    def table_of(self, keys: np.ndarray) -> np.ndarray:
        at = self.rows(keys)  # may replace the table
        return self.table[at]


_spaces: dict[int, _Space] = {}


def _space(dimensions: int) -> _Space:
    return _spaces.setdefault(dimensions, _Space(dimensions))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) from the rows with a lang that are not held out."""
    rows = docs.where(~held_out(docs["doc_id"]) & docs["doc_id"].isNotNull() & docs["lang"].isNotNull()
                      & docs["text"].isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(dimensions), {}
        for whole in batches:
            for batch in C.byte_slices(whole):
                row, key = trigrams(batch.column("text").to_pylist())
                langs = batch.column("lang").dictionary_encode()
                of_row = langs.indices.to_numpy()[row]
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    keys, counts = np.unique(key[of_row == i], return_counts=True)
                    if len(keys):
                        sums[lang] = sums.get(lang, 0) + space.bundle(keys, counts)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions)), pa.array(np.rint(total).astype(np.int64))],
                names=["lang", "dim", "total"])

    sums = (C.need(rows, "text", "lang").mapInArrow(run, "lang string, dim long, total long")
            .groupBy("lang", "dim").agg(F.sum("total").alias("total")))
    sums = C.materialise(sums)
    langs = [r.lang for r in sums.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {lang: i for i, lang in enumerate(langs)}
    prototypes = np.zeros((len(langs), dimensions))
    for r in sums.collect():
        prototypes[place[r.lang], r.dim] = r.total
    return langs, prototypes


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """The rows of ``docs`` with ``text`` replaced by lang_pred and score (the cosine, 0 at least)."""
    others = [c for c in docs.columns if c != "text"]
    dimensions = prototypes.shape[1]
    unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _space(dimensions)
        for whole in batches:
            for batch in C.byte_slices(whole):
                n = batch.num_rows
                row, key = trigrams(batch.column("text").to_pylist())
                cut = np.searchsorted(row, np.arange(n + 1))
                best, score = np.full(n, len(langs)), np.zeros(n)
                for i in range(n if langs else 0):
                    if cut[i] < cut[i + 1]:
                        keys, counts = np.unique(key[cut[i]:cut[i + 1]], return_counts=True)
                        vector = space.bundle(keys, counts)
                        cosine = unit @ vector / max(np.linalg.norm(vector), 1e-12)
                        best[i] = int(np.argmax(cosine))
                        score[i] = min(max(float(cosine[best[i]]), 0.0), 1.0)
                names = np.array([*langs, UNKNOWN], dtype=object)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in others], pa.array(names[best], pa.string()), pa.array(score)],
                    names=[*others, "lang_pred", "score"])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in others]
    return docs.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Fit on ``docs`` and return doc_id, held_out, lang_pred and score of every row."""
    langs, prototypes = fit(C.need(docs, "doc_id", "text", "lang"), dimensions)
    rows = docs.select(docs["doc_id"], held_out(docs["doc_id"]).alias("held_out"), docs["text"])
    return predict(rows, langs, prototypes)
