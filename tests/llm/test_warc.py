"""WARC archives: round trip, revisits against brute force, and every kind of damage."""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from quotalake.llm import common as C
from quotalake.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string, k string, id int"


@pytest.fixture(scope="module")
def pages(spark):
    C.ship_code(spark)

    def make(rows, partitions=3):
        df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
        return df.repartition(partitions) if rows else df

    return make


def written(spark, df, **options):
    path = C.scratch_path(spark)
    W.write(df, path, **options)
    return path, W.read(spark, path)


def brute(rows, bound=W.MIN_REVISIT):
    best = defaultdict(list)
    for p, _, h in rows:
        best[h or ""].append(p)
    out = []
    for p, u, h in rows:
        body = (h or "").encode()
        keep = max((x for x in best[h or ""] if x is not None), default=None)
        again = len(body) >= bound and keep is not None and p != keep
        out.append((p, u, len(body), hashlib.sha1(body).hexdigest(), W.REVISIT if again else W.RESPONSE,
                    keep if again else None, None if again else body))
    return sorted(out, key=repr)


def got(records):
    number = lambda x: None if x is None else int(x)
    rows = records.collect()
    assert [r.problem for r in rows if r.problem] == []
    return sorted(((number(r.page), r.target_uri, r.payload_bytes, r.payload_digest, r.record_type,
                    number(r.refers_to), None if r.payload is None else bytes(r.payload)) for r in rows), key=repr)


LONG, OTHER = "<p>é</p>" * 200, "<b>text</b>" * 500
ODD = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, "http://a/9", LONG), (3, None, None), (4, "", ""), (5, "http://a/5", "x"),
       (6, "http://a/6", "x"), (None, "http://a/7", LONG), (None, "http://b", OTHER), (None, "http://c", OTHER),
       (9, "http://a/9", LONG), (12, "u", "\r\n\r\n" * 400), (13, "u", "\r\n\r\n" * 400), (14, "u", "a" * 999), (15, "u", "a" * 999),
       (16, "u", "a" * 1000), (17, "u", "a" * 1000), (18, "u", "b" * 3_000_000), (-5, "u", "z\x00" * 600), (-4, "u", "z\x00" * 600)]


def test_odd_rows_against_brute_force(spark, pages):
    _, records = written(spark, pages(ODD))
    assert got(records) == brute(ODD)
    assert W.unresolved(records).count() == 0


def test_revisits_resolve_to_the_payloads_of_their_pages(spark, pages):
    rows = [r for r in ODD if r[0] is not None]
    _, records = written(spark, pages(rows))
    assert (sorted((int(r.page), bytes(r.payload)) for r in W.resolve(records).collect())
            == sorted((p, (h or "").encode()) for p, _, h in rows))


def test_whole_table_with_a_dictionary_and_many_archives(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    path, records = written(spark, df, archive_bytes=50_000)
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert got(records) == brute(rows)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(files) > 3 and all(f[:4] == W.DICTIONARY for f in files)
    assert sum(map(len, files)) < sum(len((h or "").encode()) for _, _, h in rows)


def test_other_names_and_string_ids(spark):
    df = spark.createDataFrame([("a b", "u\r\nX: y", LONG), ("ü/", "v", LONG)], "k string, page string, body string")
    _, records = written(spark, df, page_id="k", url="page", payload="body")
    found = {r.page: (r.target_uri, r.record_type, r.refers_to, r.problem) for r in records.collect()}
    assert found == {"a b": ("u%0D%0AX:%20y", "revisit", "ü/", None), "ü/": ("v", "response", None, None)}


def test_empty_table(spark, pages):
    _, records = written(spark, pages([]))
    assert records.count() == 0


def test_a_hot_payload_marks_one_response(spark, pages):
    rows = [(i, "u", LONG) for i in range(3000)] + [(10_000 + i, "u", f"{i}" * 600) for i in range(500)]
    _, records = written(spark, pages(rows, 8))
    counts = {r.record_type: r["count"] for r in records.groupBy("record_type").count().collect()}
    assert counts == {"response": 501, "revisit": 2999}
    assert {r.refers_to for r in records.where("record_type = 'revisit'").collect()} == {"2999"}


# --- archives of other writers, and damage -----------------------------------

def one(page="1", payload=b"hello", **kw):
    return W.record(page, "http://x", len(payload), hashlib.sha1(payload).hexdigest(), payload, None, **kw)


def zframe(raw, trained=None):
    return zstandard.ZstdCompressor(dict_data=trained).compress(raw)


def test_dictionary_frame_may_itself_be_compressed():
    samples = [one(str(i), f"<html>{i} some words {i * i}</html>".encode() * 9) for i in range(300)]
    trained = zstandard.train_dictionary(4096, samples)
    for stored in (trained.as_bytes(), zframe(trained.as_bytes())):
        archive = W.DICTIONARY + struct.pack("<I", len(stored)) + stored + b"".join(zframe(s, trained) for s in samples)
        assert [raw for _, raw, _ in W.frames(archive)] == samples


def test_frames_of_any_size_and_foreign_skippable_frames():
    raws = [one("a", b"x" * n) for n in (0, 1, W.PIECE - 1, W.PIECE, 3 * W.PIECE + 7)]
    skip = b"\x53\x2a\x4d\x18" + struct.pack("<I", 5) + b"12345"
    archive = skip + skip.join(map(zframe, raws)) + W.EMPTY_FRAME.encode()
    assert [(raw, problem) for _, raw, problem in W.frames(archive)] == [(r, None) for r in raws]


def test_reader_goes_on_behind_damage():
    good = [zframe(one(str(i), bytes([65 + i]) * 500)) for i in range(3)]
    found = list(W.frames(good[0] + b"garbage" + good[1] + good[2][:-3]))
    assert [p for _, _, p in found] == [None, "these bytes are no frame", None, "the frame is cut off"]
    assert list(W.frames(W.DICTIONARY + struct.pack("<I", 99) + b"x")) == [(0, None, "the dictionary is cut off")]
    broken = bytearray(zstandard.ZstdCompressor(write_checksum=True).compress(one()))
    broken[-1] ^= 1
    (_, raw, problem), = W.frames(bytes(broken))
    assert raw is None and "cannot be decoded" in problem


@pytest.mark.parametrize(("old", "new", "problem"), [
    (b"WARC/1.1", b"WARC/9.9", "no version line"),
    (b"WARC-Date:", b"X-Date:", "warc-date is missing"),
    (b"WARC-Type: response", b"WARC-Type: answer", "the type is unknown"),
    (b"WARC-Date:", b"no field\r\nWARC-Date:", "a header line is no field"),
    (b"WARC-Type: response", b"WARC-Type: response\r\nwarc-type: request", "warc-type is given twice"),
    (b"hello", b"hello!", "the block has another length"),
    (b"hello\r\n\r\n", b"hello\r\n", "the block has another length"),
    (b"hello", b"hallo", "the payload has another digest"),
    (b"charset=utf-8\r\nContent-Length: 5", b"charset=utf-8\r\nContent-Length: 6", "the payload has another length"),
    (b"HTTP/1.1", b"JTTP/1.1", "no HTTP header"),
])
def test_each_fault_is_named(old, new, problem):
    raw = one()
    assert old in raw and W.parse(raw)["problem"] is None
    assert problem in W.parse(raw.replace(old, new))["problem"]


def test_short_and_empty_records_are_named():
    assert "the header does not end" in W.parse(b"")["problem"]
    assert "Content-Length is no number" in W.parse(one().replace(b"response\r\nContent-Length: ", b"response\r\nContent-Length: x"))["problem"]
    revisit = W.record("1", None, 5, hashlib.sha1(b"hello").hexdigest(), None, "2")
    assert W.parse(revisit)["problem"] is None and W.parse(revisit)["payload_bytes"] == 5
    assert "warc-refers-to is missing" in W.parse(revisit.replace(b"WARC-Refers-To", b"X-Refers-To"))["problem"]


def test_damaged_file_in_a_folder_is_reported_by_row(spark, pages, tmp_path):
    good = zframe(one("7", b"fine"))
    (tmp_path / "a.warc.zst").write_bytes(good + b"\x00\x01" + good)
    records = W.read(spark, str(tmp_path))
    assert sorted(r.problem or "" for r in records.collect()) == ["", "", "these bytes are no frame"]
    assert records.where(F.col("problem").isNull()).select("page").distinct().collect()[0].page == "7"
