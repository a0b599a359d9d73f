"""Quality rules against brute force; the likelihood ratio on labelled documents."""

from __future__ import annotations

import re

import numpy as np

from quotalake.llm import quality as Q

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    inside = {i + j for i, g in enumerate(grams) if g in twice for j in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def judged(df):
    return [(r.doc_id, r.text, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
            for r in df.collect()]


def test_base_rules_match_brute_force(docs, sf_docs):
    rows = ODD + [(20, "a b c a b c " * 30), (21, "l 1\nl 2\nl 1\n\nl 1"), (22, " ".join(f"w{i}" for i in range(60)))]
    flat = Q.log_ratio(np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS))
    for df in (docs(rows), sf_docs.limit(40)):
        for _, text, got in judged(Q.score(df, flat)):
            assert got == base(text)


def test_clashing_columns_are_replaced_and_others_kept(docs):
    flat = np.zeros(Q.BUCKETS)
    out = Q.score(docs(ODD), flat)
    assert out.columns.count("score") == out.columns.count("kept") == out.columns.count("n_words") == 1
    assert {"lang", "line", "row"} <= set(out.columns) and out.count() == len(ODD)
    assert Q.score(docs([]), flat).count() == 0


def test_ratio_keeps_labelled_good_documents_and_rejects_junk(spark, sf_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.quality(docs, labels).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert len(good) > 200 and all(good)
    assert len(junk) > 10 and not any(junk)


def test_trusted_sample_is_bounded_agreed_and_deterministic(spark):
    rows = [(i, 1, 0) for i in range(3000)] + [(1, 0, 0), (2, 1, 1), (None, 1, 0), (4000, None, 0), (4001, 1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    every = Q.trusted_ids(labels)
    assert len(every) == 2999 and 4001 in every and not {1, 2, 4000} & set(every.tolist())
    some = Q.trusted_ids(labels, 500)
    assert 350 < len(some) < 650 and set(some) <= set(every)
    assert (some == Q.trusted_ids(labels.repartition(7), 500)).all()


def test_no_labels_or_no_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    long_text = " ".join(f"w{i}" for i in range(60))
    out = Q.quality(docs([(1, long_text), (None, None)]), none).collect()
    assert sorted((r.score, r.kept) for r in out) == [(0.0, False), (0.0, True)]
    assert Q.quality(docs([]), none).count() == 0


def test_counts_cover_every_document(docs):
    raw, target = Q.bucket_counts(docs([(1, "a b c"), (2, "a b"), (None, "a")]), np.array([2]))
    assert raw.sum() == (3 + 2) + (2 + 1) + 1 and target.sum() == 3


def test_score_and_verdict_by_plain_counting(spark, docs):
    """Both multinomials, the ratio, the mean and the verdict of every row, from Counters over tokens."""
    import math
    from collections import Counter

    from quotalake.llm import common as C

    def features(text):
        t = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e\x00-\x08\x0e-\x1f\x7f]+", (text or "").encode())
        shift = 64 - (Q.BUCKETS.bit_length() - 1)
        h = [C.hash_bytes(x) for x in t]
        pairs = [int(C.mix64(np.uint64((a * int(C._BASE) + b) % (1 << 64)))) for a, b in zip(h, h[1:])]
        return [x >> shift for x in h + pairs]

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trusted = set(Q.trusted_ids(labels).tolist())
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(features(t))
        if d in trusted:
            target.update(features(t))
    total, good = sum(raw.values()), sum(target.values())
    ratio = {b: math.log((target[b] + Q.PSEUDO_COUNT) / (n * good / total + Q.PSEUDO_COUNT)) for b, n in raw.items()}
    want = []
    for d, t in rows:
        f = features(t)
        mean = sum(ratio[b] for b in f) / max(len(f), 1)
        want.append((str(d), round(mean, 9), not base(t)[5] and mean >= Q.THRESHOLD))
    got = [(str(r.doc_id), round(r.score, 9), r.kept) for r in Q.quality(docs(rows), labels).collect()]
    assert sorted(got) == sorted(want)


def test_string_ids_and_very_long_texts(spark):
    long_text = " ".join(f"w{i}" for i in range(600_000))
    df = spark.createDataFrame([("a", long_text), ("b", "x " * 80), (None, "z")], "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1, 0), ("c", 1, 0)], "doc_id string, quality int, toxic int")
    rows = {r.doc_id: r for r in Q.quality(df, labels).collect()}
    assert rows["a"].n_words == 600_000 and rows["a"].kept and rows["a"].score > rows["b"].score
