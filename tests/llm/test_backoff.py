"""Stupid backoff against a direct computation."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quotalake.llm import backoff as B

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, order, alpha=0.4, leave_out=True):
    words = [re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOW)) for t in texts]
    own = [Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in words]
    total = sum(own, Counter())
    n_all = sum(map(len, words))
    out = []
    for w, o in zip(words, own):
        o = o if leave_out else Counter()
        outside = max(1, n_all - len(w)) if leave_out else max(1, n_all)
        score = 0.0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1:i + 1])
                if total[gram] > o[gram]:
                    context = total[gram[:-1]] - o[gram[:-1]] if n > 1 else outside
                    score += math.log((total[gram] - o[gram]) / context) + (order - n) * math.log(alpha)
                    break
            else:
                score += order * math.log(alpha) - math.log(outside)
        out.append((len(w), score))
    return out


def same(df, rows, **kw):
    got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 6)) for r in B.score(df, **kw).collect())
    want = sorted((str(d), n, round(s, 6)) for (d, _), (n, s) in zip(rows, brute([t for _, t in rows], kw.get("order", B.ORDER),
                                                                                 leave_out=kw.get("leave_out", True))))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) <= 1e-6 * max(1, abs(w[2])) for g, w in zip(got, want))


@pytest.mark.parametrize("order,leave_out", [(1, True), (2, True), (2, False), (3, True), (4, True)])
def test_odd_rows(docs, order, leave_out):
    rows = [*ODD, (20, "a b c a b d"), (21, "a b c"), (22, "A b. C a"), (22, "a b c"), (23, "the of and the of and " * 50)]
    same(docs(rows), rows, order=order, leave_out=leave_out)


def test_whole_table_over_several_blocks(sf_docs):
    same(sf_docs.repartition(5), [(r.doc_id, r.text) for r in sf_docs.collect()])


def test_blocks_are_cut_and_every_text_is_whole(docs):
    old, B.BLOCK_BYTES = B.BLOCK_BYTES, 64
    try:
        rows = [(i, f"word{i} " * (1 + i % 30)) for i in range(60)]
        same(docs(rows), rows)
    finally:
        B.BLOCK_BYTES = old


def test_null_score_and_empty_table(docs):
    r = {x.doc_id: x for x in B.score(docs([(1, None), (2, "a"), (3, "a")])).collect()}
    assert r[1].mean_log_score is None and r[1].n_words == 0 and r[2].mean_log_score is not None
    assert B.score(docs([])).count() == 0


def test_large_totals_survive_packing():
    totals = np.array([1, 2, 65534, 65535, 65536, 10**12, 3, 70_000], np.int64)
    size = np.array([3, 0, 4, 1])
    table = B._packed(pa.chunked_array([[0, 1, 2, 3]]), pa.chunked_array([[9, 9, 9, 9]]), totals, size)
    assert B._unpacked(table).tolist() == totals.tolist()
    moved = B._unpacked(table.take([2, 0, 1, 3]))
    assert moved.tolist() == [65535, 65536, 10**12, 3, 1, 2, 65534, 70_000]
    assert B._unpacked(table.slice(0, 0)).tolist() == []


def test_registered_score_has_two_words_of_context(docs):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "x b c y"), (4, "b c d a b"), (5, "c d a b c")]
    got = {r.doc_id: r.log_score for r in B.score(docs(rows)).collect()}
    for (d, _), (_, want) in zip(rows, brute([t for _, t in rows], 3)):
        assert abs(got[d] - want) < 1e-9


def test_differences_of_any_runs():
    import numpy as np

    rng = np.random.default_rng(6)
    runs = [np.sort(rng.integers(0, 1 << top, n).astype(np.uint64)) for n in (1, 2, 900) for top in (3, 40, 41, 48)]
    runs.append(np.array([0, 0, B._MOST, 2 * B._MOST, (1 << 48) - 1], np.uint64))
    edges = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
    blobs = B._differences(np.concatenate(runs), edges)
    assert (B._values(blobs) == np.concatenate(runs)).all()
    assert all((B._values([b]) == r).all() for b, r in zip(blobs, runs))
