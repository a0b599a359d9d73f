"""Hyperdimensional profiles: the algebra by brute force, accuracy on held-out documents."""

from __future__ import annotations

import zlib

import numpy as np

from quotalake.llm import langid as L

from .conftest import ODD


def test_trigrams_by_hand():
    row, key = L.trigrams(["Ab, c!", None, "12", "é"])
    got = [(int(r), (int(k) >> 42, int(k) >> 21 & 0x1FFFFF, int(k) & 0x1FFFFF)) for r, k in zip(row, key)]
    a, b, c, e = map(ord, "abcé")
    assert got == [(0, (0, a, b)), (0, (a, b, 0)), (0, (b, 0, c)), (0, (0, c, 0)), (3, (0, e, 0))]


def test_bundle_equals_brute_force():
    space = L._Space(64)
    _, key = L.trigrams(["the cat that sat"])
    keys, counts = np.unique(key, return_counts=True)
    want = sum(np.roll(space._of_letter(int(k) >> 42), 2) * np.roll(space._of_letter(int(k) >> 21 & 0x1FFFFF), 1)
               * space._of_letter(int(k) & 0x1FFFFF) for k in key)
    assert np.allclose(space.bundle(keys, counts), want)
    small = L._Space(64)
    old, L.MAX_TABLE = L.MAX_TABLE, 3  # the table starts anew and the sum stays the same
    try:
        assert np.allclose(small.bundle(keys, counts), want)
    finally:
        L.MAX_TABLE = old


def test_held_out_accuracy(spark, sf_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and len(held) > 100
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_read(spark, sf_docs):
    lied = sf_docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 'zz' ELSE lang END AS lang")
    a = sorted(map(tuple, L.identify(sf_docs).collect()))
    assert a == sorted(map(tuple, L.identify(lied).collect()))


def test_odd_rows_and_empty_tables(docs):
    out = L.identify(docs([*ODD, (11, "plain english words")])).collect()
    assert len(out) == len(ODD) + 1
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for i in (1, 2, 3, 8):  # no text or no letter
        assert by_id[i] == [("und", 0.0)]
    assert by_id[5][0][0] == "en" and all(not r.held_out for r in out if r.doc_id is None)
    assert L.identify(docs([])).count() == 0
    alone = L.identify(docs([(10, "words")]).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).first()
    assert (alone.lang_pred, alone.score) == ("und", 0.0)


def test_predictions_and_scores_by_plain_sums(sf_docs):
    """Prototypes and cosines of the whole table, trigram by trigram."""
    from collections import Counter

    space = L._Space(L.DIMENSIONS)
    made = {}

    def vector(text):
        total = np.zeros(L.DIMENSIONS)
        _, keys = L.trigrams([text])
        for k, n in Counter(keys.tolist()).items():
            if k not in made:
                letters = [space._of_letter(k >> 42), space._of_letter(k >> 21 & 0x1FFFFF), space._of_letter(k & 0x1FFFFF)]
                made[k] = np.roll(letters[0], 2) * np.roll(letters[1], 1) * letters[2]
            total += n * made[k]
        return total

    rows = [(r.doc_id, r.text, r.lang) for r in sf_docs.collect()]
    vectors = {d: vector(t) for d, t, _ in rows}
    prototypes = {}
    for d, _, lang in rows:
        if zlib.crc32(str(d).encode()) % 5 and lang is not None:
            prototypes[lang] = prototypes.get(lang, 0) + vectors[d]
    names = sorted(prototypes)
    unit = np.array([prototypes[x] / np.linalg.norm(prototypes[x]) for x in names])
    for r in L.identify(sf_docs).collect():
        cosine = unit @ vectors[r.doc_id] / np.linalg.norm(vectors[r.doc_id])
        assert r.lang_pred == names[int(np.argmax(cosine))] and abs(r.score - max(cosine.max(), 0)) < 1e-5


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "the quick brown fox " * 250_000, "en"), (2, "der schnelle braune fuchs " * 50, "de")],
                               "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in L.identify(df).collect()}[1] in ("en", "de", "und")
