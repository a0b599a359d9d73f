"""WARC archives in Zstandard: a writer, and a reader that validates every record.

Layout of an archive: a leading skippable frame (magic 0x184D2A5D) that holds the
compression dictionary, then one Zstandard frame per record.  The reader takes
any archive of this layout, with or without a dictionary (which may itself be
compressed), and passes over other skippable frames.

``write`` gives each page a record.  Of pages with equal payloads of at least
``MIN_REVISIT`` bytes the one with the largest id is stored as a response, the
others as revisits that refer to it and hold the HTTP header only.  The groups
come from an aggregate over digests; only groups of two and more are kept, as a
table of their own, so the join that marks the pages is a broadcast when Spark
sees that this table is small, and a shuffle join otherwise (AQE splits a hot
digest; pages below the bound get keys of their own, which match nothing).  A
task hands its finished archives, each about ``ARCHIVE_BYTES`` long, to Spark's
own text writer, one archive per row and file: its commit protocol decides which
attempt's files count, and any store that Spark reaches will do.  The writer's
line end is an empty skippable frame, so every file is a valid archive.

``read`` is one task per set of files.  It loads the dictionary, decodes frame by
frame and checks version line, header lines, mandatory fields, Content-Length,
record end, HTTP length and payload digest.  What is wrong with a record stands
in ``problem``; behind bytes that are no frame it goes on at the next frame.

The dictionary is trained from at most ``SAMPLES`` whole payloads of at most
``SAMPLE_BYTES`` each, drawn by a hash of the row number.  It changes the size of
an archive only; without enough samples there is none.

Cases: a null payload is an empty one, a null url a record without target URI,
control characters and blanks in a url are percent-encoded.  A null id is a
record without page; in a group it refers to the largest id there is, and if all
ids are null all are responses, as are repeated rows of the largest id.  An
archive holds a very long payload whole, so archives may exceed their usual
length by one record.  Only the three named columns are read.  An empty table
writes no archive, and reading none gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalake.llm import common as C

MIN_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLES = 256
SAMPLE_BYTES = 64 << 10
#: Bytes given to the decoder at once, and of payload in one batch of the reader.
PIECE = 64 << 10
BATCH_BYTES = 4 << 20

RESPONSE, REVISIT = "response", "revisit"

# Fixed values of the WARC 1.1 and Zstandard formats.
FRAME = b"\x28\xb5\x2f\xfd"
DICTIONARY = b"\x5d\x2a\x4d\x18"
_SKIPPABLE = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18")
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

_ID, _NO_ID = "<urn:x-page:%s>", "<urn:x-no-page:>"
_ID_PATTERN = re.compile(r"<urn:x-page:(.*)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_FIELD = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*(.*?)[ \t]*", re.DOTALL)


# --- writing -----------------------------------------------------------------

def _record_id(page: str | None) -> str:
    return _NO_ID if page is None else _ID % quote(page, safe="")


def record(page: str | None, url: str | None, size: int, digest: str, payload: bytes | None,
           refers_to: str | None, date: str = DATE) -> bytes:
    """One whole record; with a null ``payload`` a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [("WARC-Type", REVISIT if payload is None else RESPONSE), ("WARC-Record-ID", _record_id(page)),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: quote(m[0]), url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def train(pages: DataFrame, payload: str = "html", samples: int = SAMPLES,
          sample_bytes: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES) -> bytes | None:
    """A dictionary from a bounded sample of whole payloads, or None if there are too few."""
    text = pages[payload]
    # draws by row, so copies cannot crowd the sample, and a share so small that few rows reach the driver
    share = min(1.0, 2 * samples / max(pages.count(), 1))
    rows = (pages.select(text.alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("h"))
            .where((F.col("h") <= int(share * (1 << 64)) - (1 << 63) - 1) & F.octet_length("text").between(1, sample_bytes))
            .orderBy("h").limit(samples).collect())
    try:
        return zstandard.train_dictionary(size, [r.text.encode() for r in rows]).as_bytes()
    except (zstandard.ZstdError, ValueError):  # the library's way to say: too few or too small samples
        return None


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                 min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page, url, size, digest, payload or null for a revisit, refers_to) of every page."""
    body = F.coalesce(pages[payload], F.lit(""))
    base = pages.select(pages[page_id].alias("id"), pages[url].cast("string").alias("url"), body.alias("body"),
                        F.octet_length(body).cast("long").alias("size"), F.sha1(body).alias("digest"))
    large = F.col("size") >= min_revisit
    # the second hash tells apart payloads that were made to share their SHA-1
    key = F.concat_ws(":", "digest", F.hex(F.xxhash64("body")), "size")
    groups = C.materialise(base.where(large).groupBy(key.alias("k")).agg(F.max("id").alias("keep"), F.count("*").alias("n"))
                           .where("n > 1 AND keep IS NOT NULL").select("k", "keep"))
    keyed = base.withColumn("k", F.when(large, key).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    revisit = ~F.col("keep").eqNullSafe(F.col("id")) & F.col("keep").isNotNull()
    return keyed.join(groups, "k", "left").select(
        F.col("id").cast("string").alias("page"), "url", "size", "digest",
        F.when(~revisit, F.col("body")).alias("payload"),
        F.when(revisit, F.col("keep").cast("string")).alias("refers_to"))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
          min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE,
          level: int = LEVEL) -> None:
    """Write the archives of ``pages`` as files of the new folder ``path``."""
    trained = train(pages, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = b"" if trained is None else DICTIONARY + struct.pack("<I", len(trained)) + trained
        packer = zstandard.ZstdCompressor(
            level=level, write_checksum=True, dict_data=None if trained is None else zstandard.ZstdCompressionDict(trained))
        frames, held = [lead], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "size", "digest", "payload", "refers_to")]
            columns[4] = columns[4].cast(pa.large_binary())
            for i in range(batch.num_rows):
                page, target, size, digest, body, refers_to = (c[i].as_py() for c in columns)
                frames.append(packer.compress(record(page, target, size, digest, body, refers_to, date)))
                held += len(frames[-1])
                if held >= archive_bytes:
                    yield archive()
                    frames, held = [lead], 0
        if held:
            yield archive()

    (plan_records(pages, page_id, url, payload, min_revisit).mapInArrow(run, "archive binary")
     .select(F.col("archive").cast("string"))
     .write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).option("compression", "none").text(path))


# --- reading -----------------------------------------------------------------

def frames(archive: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(first byte, decoded frame, problem) of every frame of an archive."""
    view, at, n = memoryview(archive), 0, len(archive)
    trained = None
    if archive[:4] == DICTIONARY and n >= 8:
        stop = 8 + struct.unpack_from("<I", archive, 4)[0]
        if stop > n:
            yield 0, None, "the dictionary is cut off"
            return
        raw = bytes(view[8:stop])
        if raw[:4] == FRAME:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        trained, at = zstandard.ZstdCompressionDict(raw), stop
    decoder = zstandard.ZstdDecompressor(dict_data=trained)
    while at < n:
        magic = archive[at:at + 4]
        if _SKIPPABLE.fullmatch(magic) and at + 8 <= n:
            stop = at + 8 + struct.unpack_from("<I", archive, at + 4)[0]
            if stop > n:
                yield at, None, "a skippable frame is cut off"
            at = stop
            continue
        problem = "these bytes are no frame"
        if magic == FRAME:
            one, parts, stop = decoder.decompressobj(), [], at
            try:
                while not one.eof and stop < n:
                    piece = view[stop:stop + PIECE]
                    parts.append(one.decompress(piece))
                    stop += len(piece) - len(one.unused_data)
                if one.eof:
                    yield at, b"".join(parts), None
                    at = stop
                    continue
                problem = "the frame is cut off"
            except zstandard.ZstdError as error:
                problem = f"the frame cannot be decoded: {error}"
        yield at, None, problem
        following = archive.find(FRAME, at + 1)
        at = n if following < 0 else following


def _header(lines: list[bytes], problems: list[str]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        field = _FIELD.fullmatch(line)
        if not field:
            problems.append("a header line is no field")
            continue
        name = field[1].decode().lower()
        if name in found and name != "warc-concurrent-to":
            problems.append(f"{name} is given twice")
        found.setdefault(name, field[2].decode("utf-8", "replace"))
    return found


def _length(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch("[0-9]+", value) else None


def _page(record_id: str | None) -> str | None:
    page = _ID_PATTERN.fullmatch(record_id or "")
    return unquote(page[1]) if page else None


def parse(raw: bytes) -> dict:
    """The fields of one record; ``problem`` lists all that is wrong with it."""
    problems: list[str] = []
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        problems.append("the header does not end")
    version, *lines = head.split(b"\r\n")
    if version not in (b"WARC/1.0", b"WARC/1.1"):
        problems.append("no version line")
    fields = _header(lines, problems)
    problems += [f"{name} is missing" for name in MANDATORY if name not in fields]
    kind = fields.get("warc-type")
    if kind is not None and kind not in TYPES:
        problems.append("the type is unknown")
    length = _length(fields.get("content-length"))
    if length is None:
        problems.append("Content-Length is no number")
    elif len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        problems.append("the block has another length")
    block = rest[:length] if length is not None else rest
    payload: bytes | None = block
    size = len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap or not http.startswith(b"HTTP/"):
            problems.append("no HTTP header")
        size = len(payload)
        told = _length(_header(http.split(b"\r\n")[1:], problems).get("content-length"))
        if kind == REVISIT and told is not None:
            size = told
        elif told is not None and told != size:
            problems.append("the payload has another length")
    if kind == REVISIT:
        problems += [f"{name} is missing" for name in ("warc-profile", "warc-refers-to") if name not in fields]
        payload = None
    scheme, _, said = fields.get("warc-payload-digest", "").partition(":")
    digest = None if payload is None else hashlib.sha1(payload).hexdigest()
    if said and scheme.lower() == "sha1":
        try:
            said = said.lower() if len(said) == 40 else base64.b32decode(said).hex()
        except ValueError:
            problems.append("the payload digest is no SHA-1")
        else:
            if digest is not None and said != digest:
                problems.append("the payload has another digest")
            digest = digest or said
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "page": _page(fields.get("warc-record-id")),
            "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": size, "payload_digest": digest,
            "payload": payload, "problem": "; ".join(problems) or None}


_SCHEMA = pa.schema([
    ("archive", pa.string()), ("start", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("page", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("problem", pa.string())])


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record (and per undecodable place) of the archives in ``path``; payloads on request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            names, contents = batch.column("path"), batch.column("content")
            for i in range(batch.num_rows):
                for start, raw, problem in frames(contents[i].as_py()):
                    row = {"problem": problem} if raw is None else parse(raw)
                    held += len(row.get("payload") or b"")
                    if not payloads:
                        row["payload"] = None
                    rows.append({"archive": names[i].as_py(), "start": start, **row})
                    if held >= BATCH_BYTES or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "archive string, start long, record_type string, record_id string, page string, "
                            "target_uri string, date string, refers_to string, payload_bytes long, "
                            "payload_digest string, payload binary, problem string")


def unresolved(records: DataFrame) -> DataFrame:
    """Revisits without a response of the page they refer to that has the same digest."""
    there = (records.where(F.col("record_type") == RESPONSE)
             .select(F.col("page").alias("refers_to"), "payload_digest").distinct())
    return records.where(F.col("record_type") == REVISIT).join(there, ["refers_to", "payload_digest"], "left_anti")


def resolve(records: DataFrame) -> DataFrame:
    """(page, target_uri, payload) of all responses and revisits, the latter with their response's payload."""
    stored = records.where(F.col("record_type") == RESPONSE)
    once = (stored.groupBy(F.col("page").alias("refers_to"), "payload_digest")
            .agg(F.first("payload").alias("payload")))
    again = (records.where(F.col("record_type") == REVISIT).drop("payload")
             .join(once, ["refers_to", "payload_digest"], "left"))
    return stored.select("page", "target_uri", "payload").unionByName(again.select("page", "target_uri", "payload"))
