"""SimHash: fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from quotalake.llm import simhash as S

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, bits):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= bits and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def components(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = roots(set(prints), 3)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[root[p]] = min(least.get(root[p], d), d)
    return sorted(((d, f"{p:016x}", least.get(root[p])) for (d, _), p in zip(rows, prints)), key=str)


def got(df):
    return sorted(((r.doc_id, f"{r.fingerprint & (1 << 64) - 1:016x}", r.component_id)
                   for r in S.simhash_components(df).collect()), key=str)


def test_documents_match_brute_force(docs):
    rnd = random.Random(3)
    long = [f"w{rnd.randrange(500)}" for _ in range(300)]
    near = []
    for i in range(40):
        w = list(long)
        for _ in range(i % 4):
            w[rnd.randrange(300)] = f"z{i}"
        near.append((100 + i, " ".join(w)))
    rows = ODD + near + near[:3] + [(50, "A b"), (51, "a  B"), (52, "one two three"), (None, near[0][1])]
    assert got(docs(rows)) == components(rows)


def test_whole_table(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    assert got(sf_docs) == components(rows)


@pytest.mark.parametrize("bits,block,blocks", [(3, 8192, 16), (3, 5, 100), (1, 4, 2), (2, 3, 100), (4, 6, 100),
                                               (5, 8192, 16), (3, 4, 2), (2, 8, 1), (4, 8, 2)])
def test_links_connect_exactly_the_near_fingerprints(spark, docs, bits, block, blocks):
    """Also with signatures that are spread over blocks, and cut again where they have too many."""
    rnd = random.Random(bits * 100 + block)
    values = set()
    for _ in range(6):
        center = rnd.getrandbits(64)
        for _ in range(40):
            v = center
            for _ in range(rnd.randrange(0, 9)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    values |= {rnd.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1, 1 << 63}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    links = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in S.near_links(prints, bits, block, blocks).collect()]
    assert all(0 < (a ^ b).bit_count() <= bits for a, b in links)
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {v: find(v) for v in values} == roots(values, bits)


def test_keep_one(docs):
    rows = ODD + [(12, "x"), (13, "y z"), (None, "x")]
    kept = sorted(((r.doc_id, r.text) for r in S.keep_one(docs(rows)).collect()), key=str)
    groups = set(roots({fingerprint(t) for _, t in rows}, 3).values())
    assert len(kept) == len(groups)
    assert sum(k == (5, "x") for k in kept) == 1 and (12, "x") not in kept and (13, "y z") not in kept
    assert S.keep_one(docs([])).count() == 0
    assert S.keep_one(docs(ODD)).columns == docs(ODD).columns


def test_empty(docs):
    assert S.simhash_components(docs([])).count() == 0
