"""Histogram sort: exact cover, gapless slots, even bytes."""

from __future__ import annotations

import zlib
from collections import Counter

from quotalake.llm import sharding as S

from .conftest import ODD


def check(rows, out, n):
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    by = {}
    for r in out:
        assert 0 <= r.shard < n
        by.setdefault(r.shard, []).append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    return {s: sum(r["size"] for r in rs) for s, rs in by.items()}


def test_odd_rows(docs):
    for n in (1, 2, 7, 40):
        check(ODD, S.shard_by_bytes(docs(ODD), n).collect(), n)
    assert S.shard_by_bytes(docs([]), 40).count() == 0


def test_shares_are_even_with_a_hot_text(docs):
    rows = [(i, "the same text " * 5) for i in range(3000)] + [(i, f"text {i} " * (1 + i % 40)) for i in range(3000, 9000)]
    sizes = check(rows, S.shard_by_bytes(docs(rows), 40).collect(), 40)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and all(abs(x - mean) < 0.02 * mean for x in sizes.values())


def test_repeated_ids_and_rows_are_cut_too(docs):
    rows = [(1, "same row")] * 4000
    sizes = check(rows, S.shard_by_bytes(docs(rows), 8).collect(), 8)
    assert max(sizes.values()) - min(sizes.values()) <= 0.01 * sum(sizes.values()) / 8 + 48


def test_splitters_are_exact_quantiles_of_bytes(docs, spark):
    rows = [(i, f"t{i}") for i in range(5000)]
    keyed = S.with_keys(docs(rows))
    total = sum(r["size"] for r in keyed.collect())
    cuts = S.find_splitters(keyed, 10, total)
    keys = sorted((r["_key"], r["size"]) for r in keyed.collect())
    for j, cut in enumerate(cuts, 1):
        below = sum(size for key, size in keys if key < cut)
        assert abs(below - j * total / 10) <= max(S.TOLERANCE * total / 10, max(size for _, size in keys))


def test_main_path_is_native(docs):
    plan = S.shard_by_bytes(docs(ODD), 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
