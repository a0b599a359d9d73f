"""Fill in the middle: against a row-at-a-time version, and the exact round trip."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotalake.llm import common as C
from quotalake.llm import fim as M

from .conftest import ODD


def brute(doc, text, seed=7, fim_rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def got(df):
    return sorted(((r.doc_id, (r.n_lines, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored)
                   for r in df.collect()), key=repr)


def check(df, rows, **rates):
    want = sorted(((d, brute(d, t, **rates), t or "") for d, t in rows), key=repr)
    assert got(M.restore(M.transform(df, **rates))) == want


def test_odd_rows_against_brute_force(docs):
    rows = ODD + [(20, "a\nb\nc"), (21, "\n"), (22, "\n\n\n"), (23, "x <P> y\nz\n"), (24, "<P\n>\n<\nS>"), (25, "é\n日本\n🙂\n"),
                  (26, "line\n" * 3000), (27, "<"), (28, "<M"), (29, "a\n<S>")]
    check(docs(rows), rows)
    check(docs(rows), rows, fim_rate=40, spm_rate=20, seed=3)


def test_sentinels_at_row_ends_are_not_joined_across_rows(docs):
    rows = [(i, t) for i, t in enumerate(["x\n<P", "><S", ">\n<", "M>a\nb", "<M"])]
    check(docs(rows, partitions=1), rows)


def test_whole_table(sf_docs):
    check(sf_docs, [(r.doc_id, r.text) for r in sf_docs.collect()])


def test_empty_table(docs):
    assert M.restore(M.transform(docs([]))).count() == 0


def test_clashing_column_names_and_string_ids(spark):
    df = spark.createDataFrame([("a", "x\ny\n", "1", 2)], "doc_id string, text string, output string, h0 int")
    check(df, [("a", "x\ny\n")])


def _arrays(texts):
    return C.text_buffer(pa.array(texts, pa.string()))


def _check_slice(texts, ids):
    digests = [hashlib.sha256(f"7:{i}".encode()).hexdigest() for i in ids]
    h = np.array([[int(d[8 * k:8 * k + 8], 16) for d in digests] for k in range(4)], np.int64)
    done = M.rearrange(*_arrays(texts), h, 100, 50)
    rows = list(zip(*[done[c].to_pylist() for c in ("n_lines", "form", "prefix_chars", "middle_chars", "output")]))
    assert rows == [brute(i, t) for i, t in zip(ids, texts)]
    back = M.put_back(*C.text_buffer(done["output"]), np.array(done["form"].to_pylist(), dtype=object))
    assert back.to_pylist() == texts


@given(st.lists(st.text(st.sampled_from("a\n<PSM>é🙂"), max_size=30), min_size=1, max_size=6), st.integers(0, 10**6),
       st.sampled_from([1, 3, 7, 1 << 20]))
@settings(max_examples=300, deadline=None)
def test_any_texts_in_any_windows(texts, first, window):
    old, M.WINDOW = M.WINDOW, window
    try:
        _check_slice(texts, list(range(first, first + len(texts))))
    finally:
        M.WINDOW = old


def test_very_long_texts():
    _check_slice(["ab\n" * 2_000_000, "x" * 5_000_000, "\n" * 3_000_000], [11, 12, 13])


def test_a_damaged_output_is_refused():
    with pytest.raises(ValueError):
        M.put_back(*_arrays(["<P>a<S>b"]), np.array(["psm"], dtype=object))
    with pytest.raises(ValueError):
        M.put_back(*_arrays(["<S>a<P>b<M>c"]), np.array(["psm"], dtype=object))
