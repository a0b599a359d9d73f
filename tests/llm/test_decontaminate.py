"""Winnowing against a scan of all windows."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quotalake.llm import decontaminate as D
from quotalake.llm import queries

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        if item is not None and n:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=str)


def run(df, bench):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)
                   for r in D.decontaminate(df, bench).collect()), key=str)


ITEMS = [(1, " ".join(f"q{i}" for i in range(25))), (2, "A short, item"), (3, "solo"), (4, None), (5, "..."), (None, "zz yy"),
         (6, "Q3 q4 q5 q6 q7 q8 q9 q10 q11 q12"), (7, "r0 " * 12), (7, "other text of item seven which is long enough to be one"),
         (8, " ".join(f"t{i}" for i in range(9)))]


def test_matches_brute_force_on_planted_spans(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    q = [f"q{i}" for i in range(25)]
    rows = ODD + [(30, "x " + " ".join(q)), (31, " ".join(q[3:13])), (32, " ".join(q[3:12]) + " y"),
                  (33, " ".join(q[:12]) + " gap " + " ".join(q[10:])), (34, "a SHORT item, a short. item"), (35, "so solo"),
                  (36, "r0 " * 40), (37, " ".join(f"t{i}" for i in range(9))), (38, "zz yy"), (34, "none of it"),
                  (39, " ".join(["filler"] * 9000 + q + ["filler"] * 9000 + q[5:17])), (39, "solo"), (39, "solo")]
    assert run(docs(rows), bench) == brute(rows, ITEMS)


@pytest.mark.parametrize("lead", [D.CHUNK - 20, D.CHUNK - 9, D.CHUNK, D.CHUNK + 1])
def test_spans_across_chunk_borders(spark, docs, lead):
    bench = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    rows = [(1, " ".join([f"f{i}" for i in range(lead)] + [f"q{i}" for i in range(12)] + ["end"]))]
    assert run(docs(rows, 1), bench) == brute(rows, ITEMS[:2])


def test_query_digest_on_whole_table(spark, sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in queries.op2_decontaminate(spark, "/root/testdata/sf0.001").collect()}
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, n, h, i, c in brute(rows, items)}
    assert got == want and any(c[-1] for c in got.values())


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert run(docs([]), none) == []
    assert run(docs([(1, "a b")]), none) == [(1, 2, 0, [], False)]
    assert run(docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")) == []


def test_main_path_is_native(docs, spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    grams = D._grams(D.benchmark_windows(bench).select("window", "n").distinct())
    plan = D.scan(docs(ODD), grams)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_every_long_shared_span_has_a_seed(spark, docs):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    grams = D._grams(D.benchmark_windows(bench).select("window", "n").distinct())
    rows = [(i, f"a{i} b{i} " + " ".join(f"q{j}" for j in range(i, i + 10)) + " z") for i in range(16)]
    seeds = D.scan(docs(rows), grams).agg(F.min(F.size("seeds"))).first()[0]
    assert seeds >= 1
