"""Quality rules: base rules plus a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed unigrams and bigrams are counted: the
raw corpus (every document) and a trusted target (documents labelled good).  A
document's score is the mean log ratio of its n-grams,

    mean over n-grams of  log((target[b] + K) / (expected[b] + K)),

where ``expected[b]`` is the raw count scaled to the size of the target and K
the pseudo-count of both.  A document is kept if it passes the base rules and
its score is at least ``THRESHOLD``.

Parameters: the target is a bounded sample of at most about ``MAX_TRUSTED``
labelled documents (lowest id hashes); the raw side counts every document.

Cases: a null or empty text has no words and fails the base rules (score 0).
Repeated rows and ties are judged alike, each on its own text.  A null doc_id
is never trusted.  Without labels, or without documents, both multinomials are
equal, so every score is 0.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quotalake.llm import common as C

BUCKETS = 1 << 14
MAX_TRUSTED = 20_000
PSEUDO_COUNT = 5.0
THRESHOLD = -0.4
MIN_WORDS = 50

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> np.ndarray:
    """Sorted ids of a bounded sample of the documents labelled good and not toxic.

    Every label of a document must agree.  The sample is the part of the ids
    whose hash is below a bound set from their exact number.
    """
    good = (C.need(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
            .groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"),
                                   F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
            .where("q = 1 AND t = 0"))
    total = good.count()
    if total > limit:
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(limit / total * (1 << 30)))
    return np.sort(np.array([r.doc_id for r in good.select("doc_id").collect()],
                            dtype=object if isinstance(labels.schema["doc_id"].dataType, StringType) else np.int64))


def _features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every unigram and bigram of words and punctuation runs."""
    tokens = C.tokenise(offsets, data, C.WORD_OR_PUNCT)
    first, pairs = C.ngrams(tokens, 2)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    buckets = np.concatenate([tokens.hash, pairs]) >> shift
    return np.concatenate([tokens.row, tokens.row[first]]), buckets.astype(np.int64)


def bucket_counts(docs: DataFrame, trusted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(raw, target) n-gram counts per bucket over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for batch in C.byte_slices(whole):
                rows, buckets = _features(*C.text_buffer(batch.column("text")))
                raw += np.bincount(buckets, minlength=BUCKETS)
                ids = batch.column("doc_id")
                known = pa.array(trusted.tolist(), ids.type)
                good = pc.is_in(ids, value_set=known).to_numpy(zero_copy_only=False)
                target += np.bincount(buckets[good[rows]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                         names=["bucket", "raw", "target"])

    rows = (C.need(docs, "doc_id", "text").mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
            .collect())  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of every bucket (0 everywhere without a target)."""
    if not raw.sum() or not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + PSEUDO_COUNT) / (expected + PSEUDO_COUNT))


def _repeated_words(tokens: C.Tokens, n: int) -> np.ndarray:
    """Per row: words inside 3-word windows that the row holds twice or more."""
    first, h = C.ngrams(tokens, 3)
    covered = np.zeros(len(tokens.row), bool)
    if len(first):
        with np.errstate(over="ignore"):
            key = C.mix64(h + tokens.row[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = first[twice]
        covered[at] = covered[at + 1] = covered[at + 2] = True
    return np.bincount(tokens.row[covered], minlength=n)


def _base(text: bytes) -> tuple[int, int, int]:
    """(word_chars, n_symbols, n_dup_lines) of one text."""
    visible = text.translate(None, _SPACE)
    lines = [x for x in text.split(b"\n") if x.translate(None, _SPACE)]
    return len(visible.decode("utf-8", "replace")), len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines))


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The base counts, the score and the verdict of every row, beside its own columns."""
    own = list(docs.schema.fields)
    taken = {f.name for f in own}
    added = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
             ("n_repeat_words", "long"), ("base_failed", "boolean"), ("score", "double"), ("kept", "boolean")]
    clash = taken & {k for k, _ in added}
    if clash:  # a computed column replaces an input column of its name
        docs = docs.drop(*clash)
        own = list(docs.schema.fields)
    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in own]
                       + [f"{k} {t}" for k, t in added])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C.byte_slices(whole):
                offsets, data = C.text_buffer(batch.column("text"))
                n = batch.num_rows
                rows, buckets = _features(offsets, data)
                count = np.bincount(rows, minlength=n)
                mean = np.bincount(rows, weights=weights[buckets], minlength=n) / np.maximum(count, 1)
                words = C.tokenise(offsets, data, C.NOT_SPACE)
                n_words = np.bincount(words.row, minlength=n)
                repeat = _repeated_words(words, n)
                raw = data.tobytes()
                base = np.array([_base(raw[offsets[i]:offsets[i + 1]]) for i in range(n)], np.int64).reshape(n, 3)
                failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
                kept = ~failed & (mean >= threshold)
                columns = [n_words, base[:, 0], base[:, 1], base[:, 2], repeat, failed, mean, kept]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(c) for c in columns]],
                    names=[*batch.schema.names, *[k for k, _ in added]])

    return docs.mapInArrow(judge, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
            max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Fit both multinomials over all of ``docs`` and judge every row."""
    raw, target = bucket_counts(docs, trusted_ids(labels, max_trusted))
    return score(docs, log_ratio(raw, target), threshold)
