"""Concatenate and cut: exact round trip with the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quotalake.llm import common as C
from quotalake.llm import packing as P

from .conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER, TOKENIZER = P._Encoder(PATH), Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(rows, pieces, sequence):
    """Every row's ids lie in its pieces once; sequences are full and gapless."""
    tokenizer = Tokenizer.from_file(PATH)
    left = defaultdict(list)
    for d, t in rows:
        left[d].append(ids_of(tokenizer, t))
    total = sum(len(x) for xs in left.values() for x in xs)
    stream = np.zeros(total, np.uint32)
    starts = []
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length >= 1 and zlib.crc32(r.ids) == r.ids_crc32
        at = r.sequence_id * sequence + r.offset
        assert r.offset + r.length <= sequence
        stream[at:at + r.length] = ids
        if r.start == 0:
            starts.append((at, r.doc_id, r.doc_tokens))
    assert sum(r.length for r in pieces) == total
    for at, doc, n in starts:
        got = stream[at:at + n]
        match = next(i for i, x in enumerate(left[doc]) if len(x) == n and (x == got).all())
        left[doc].pop(match)
    assert not any(left.values())


def test_odd_rows_and_tokenizer_corner_cases(docs):
    rows = ODD + [(20, "It's we'll 12 3.4 -- 'S THE's don't"), (21, "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>"),
                  (22, "école   wide space ＦＵＬＬ İstanbul ΣΑΣ"), (23, "word " * 9000), (24, "a\rb\fc\x85d e")]
    check(rows, P.pack(docs(rows), PATH, 64).collect(), 64)


def test_whole_table(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    pieces = P.pack(sf_docs, PATH).collect()
    check(rows, pieces, P.SEQUENCE)
    used = defaultdict(int)
    for r in pieces:
        used[r.sequence_id] += r.length
    assert sorted(used) == list(range(len(used)))
    assert all(n == P.SEQUENCE for s, n in used.items() if s < len(used) - 1)  # only the last is padded


def _encode(encoder, texts):
    return encoder.encode(*C.text_buffer(pa.array(texts, pa.string())))


def test_cache_restart_changes_nothing():
    encoder, tokenizer = P._Encoder(PATH), Tokenizer.from_file(PATH)
    old, P.CACHE_WORDS = P.CACHE_WORDS, 5
    try:
        for text in ("one two three four five six seven", "eight one two", "seven nine"):
            counts, ids = _encode(encoder, [text, "", None])
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
            assert counts.tolist() == [len(ids), 0, 0]
    finally:
        P.CACHE_WORDS = old


@given(st.lists(st.text(st.sampled_from("ab zE'.,!-<|>3é\u0301ßÉ×÷ΣÇ—\u00a0\n=\u0338½²ŉǅ𝔸")), max_size=6))
@settings(max_examples=400, deadline=None)
def test_any_text_gets_the_tokenizers_own_ids(texts):
    counts, ids = _encode(ENCODER, texts)
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_empty_table(docs):
    assert P.pack(docs([]), PATH).count() == 0


def test_capitals_before_combining_marks():
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = [f"a{x}{m}b {x}{m}" for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks]
    texts += [f"{x}̣{m}" for x in "HJTWY" for m in marks] + ["J̌", "W̊E", "H", "̱"]
    counts, ids = _encode(P._Encoder(PATH), texts)
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
