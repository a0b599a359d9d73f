"""SimHash near-duplicates through one-wildcard segment signatures.

A 64-bit fingerprint holds, per bit, the majority of the XXH64 hashes of the
text's word shingles.  Two fingerprints that differ in at most ``max_bits``
bits are cut into ``max_bits // 2 + 1`` segments, fewer than the usual
``max_bits + 1``: then some segment differs in at most one bit, so the two
share the segment itself or the segment with one bit masked out.

1. Distinct fingerprints only (copies collapse before anything is joined).
2. Each is indexed under its segments and their one-wildcard variants.
3. Signatures with one member, and masked ones whose members agree in the
   masked bit (they share the segment itself), are dropped by an equality join
   with the signature counts.
4. Members of a signature are verified by exact bit distance, in blocks of at
   most ``BLOCK``: a larger signature is spread over all pairs of its blocks, so
   no task holds a whole group, nothing is dropped, and only a spanning forest
   of each block's links is returned, never all pairs.  A signature of more than
   ``MAX_BLOCKS`` blocks is cut again, by the same rule, in the bits that its
   members may still differ in, until few different fingerprints can be left.
5. Linked fingerprints are joined to components; a document's component is the
   smallest doc_id among all of its fingerprint's component.

Cases: a null, empty or blank text has no words and the fingerprint zero, which
links like any other.  Fewer words than a shingle: the whole sequence is the
one shingle.  Repeated rows get the same component.  Null doc_ids keep their
fingerprint and never become a component id (null if no member has an id).
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C
from quotalake.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 8192
MAX_BLOCKS = 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text (words split at ASCII white space)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, end[shingle - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):  # bounds the bit matrix of a very long text
        part = hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` with ``text`` replaced by ``fingerprint`` (a BIGINT with the same bits)."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(prints.view(np.int64))],
                                             names=[*others, "fingerprint"])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in others]
    return docs.mapInArrow(run, ", ".join([*kinds, "fingerprint long"]))


def signatures(rows: DataFrame, max_bits: int = MAX_BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per segment of ``rest`` whole (bit null) and with each of its bits masked out.

    ``rows`` has sig, fp and the ``width`` low bits of ``rest`` that members of
    ``sig`` may still differ in.  Returns fp, ``carry``, the new sig, bit and segment.
    """
    n = max_bits // 2 + 1
    lo, hi = f"int(width * s div {n})", f"int(width * (s + 1) div {n})"
    mask = f"if({hi} - {lo} = 64, -1L, shiftleft(1L, least({hi} - {lo}, 62)) - 1)"
    value = f"(shiftrightunsigned(rest, {lo}) & {mask})"
    variants = (f"transform(sequence(-1, {hi} - {lo} - 1), i -> named_struct("
                f"'sig', xxhash64(sig, s, i, if(i < 0, {value}, {value} & ~shiftleft(1L, greatest(i, 0)))), "
                f"'bit', if(i < 0, null, int(shiftrightunsigned({value}, greatest(i, 0)) & 1)), 'segment', s))")
    return (rows.select("fp", *carry,
                        F.explode(F.expr(f"flatten(transform(sequence(0, {n - 1}), s -> {variants}))")).alias("v"))
            .select("fp", *carry, "v.sig", "v.bit", "v.segment"))


def _refined(members: DataFrame, max_bits: int) -> DataFrame:
    """Rows of a signature without the segment that its members share."""
    n = max_bits // 2 + 1
    lo, hi = f"int(width * segment div {n})", f"int(width * (segment + 1) div {n})"
    above = f"if({hi} >= width, 0L, shiftleft(shiftrightunsigned(rest, {hi}), {lo}))"
    return members.select("sig", "fp", F.expr(f"{above} | (rest & (shiftleft(1L, {lo}) - 1))").alias("rest"),
                          F.expr(f"width - ({hi} - {lo})").alias("width"))


def _forest(members: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning forest edges of the links within one block of distinct fingerprints."""
    left, right, rest = [], [], members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), x, np.uint64))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    return left, right


def _block_links(max_bits: int):
    """Verify groups of rows with equal (sig, b1, b2), which arrive sorted and contiguous."""

    def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        start = np.concatenate([[0], cut])
        size = np.diff(np.concatenate([start, [len(fp)]]))
        left, right = [], []
        for offset in range(1, 8):  # groups of up to 8 rows: all of their pairs at once
            at = start[(size <= 8) & (size > offset)]
            most = size[(size <= 8) & (size > offset)]
            for shift in range(0, 8 - offset):
                a = at[most > offset + shift] + shift
                if not len(a):
                    break
                near = np.bitwise_count(fp[a] ^ fp[a + offset]) <= max_bits
                left.append(fp[a][near])
                right.append(fp[a + offset][near])
        for s, n in zip(start[size > 8], size[size > 8]):
            more = _forest(np.unique(fp[s:s + n]), max_bits)
            left += more[0]
            right += more[1]
        none = np.empty(0, np.uint64)
        a, b = np.concatenate([none, *left]), np.concatenate([none, *right])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "b1", "b2")], axis=1)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            key, fp = np.concatenate([held_key, key.astype(np.int64)]), np.concatenate([held_fp, fp])
            if not len(fp):
                continue
            last = np.flatnonzero(np.any(key != key[-1], axis=1))
            done = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            if done:
                yield links(key[:done], fp[:done])
            held_key, held_fp = key[done:], fp[done:]
        if len(held_fp):
            yield links(held_key, held_fp)

    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK,
               max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect all that are near."""
    # the table of prints is small and each row becomes many: spread it first
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = prints.select("fp").repartition(parts)
    rows = start.select(F.lit(0).cast("long").alias("sig"), "fp", F.col("fp").alias("rest"), F.lit(64).alias("width"))
    links, carry = None, ()
    while True:
        signed = signatures(rows, max_bits, carry)
        shared = C.materialise(
            signed.groupBy("sig")
            .agg(F.count(F.lit(1)).alias("n"), F.min("bit").alias("lo"), F.max("bit").alias("hi"))
            .where("n > 1 AND (lo IS NULL OR lo < hi)")
            .select("sig", F.ceil(F.col("n") / F.lit(block)).cast("long").alias("blocks")))
        found = _verified(signed.join(shared.where(F.col("blocks") <= max_blocks), "sig"), max_bits)
        links = found if links is None else links.unionByName(found)
        large = shared.where(F.col("blocks") > max_blocks).select("sig")
        if not large.limit(1).count():
            return links.distinct()
        # Members of a large signature are cut anew in the bits that they may still differ in.
        # Each round fixes more bits, so that soon only few different fingerprints are left.
        members = signed.join(large, "sig")
        if not carry:
            members = members.withColumns({"rest": F.col("fp"), "width": F.lit(64)})
        rows, carry = C.materialise(_refined(members, max_bits)), ("rest", "width")


def _verified(members: DataFrame, max_bits: int) -> DataFrame:
    """Links inside each signature, over all pairs of its blocks."""
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (members.select("sig", "fp", own.alias("own"), "blocks")
             .select("sig", "fp", "own", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other"))
             .select("sig", "fp", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2")))
    return (pairs.repartition("sig", "b1", "b2").sortWithinPartitions("sig", "b1", "b2")
            .mapInArrow(_block_links(max_bits), "a long, b long"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, text_hash, fingerprint, root, component_id) of every row; root: the group's key."""
    rows = docs.select(docs["doc_id"], docs["text"], F.xxhash64(docs["text"]).alias("text_hash"))
    found = C.materialise(with_fingerprints(rows, shingle))
    prints = C.materialise(found.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(near_links(prints.select("fp"), max_bits))
    placed = (prints.join(roots, prints["fp"] == roots["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    first = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = placed.join(first, "root").select("fp", "root", "component_id")
    return (found.join(of, found["fingerprint"] == of["fp"])
            .select("doc_id", "text_hash", "fingerprint", "root", "component_id"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    return _grouped(docs, shingle, max_bits).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group left: that with the smallest doc_id (nulls last).

    Of several texts under that doc_id the one with the smallest hash stays, and
    of wholly repeated rows one.
    """
    id_hash, text_hash = C.fresh(docs, "_id_hash"), C.fresh(docs, "_text_hash")
    groups = _grouped(docs, shingle, max_bits)
    keep = (groups.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one"))
            .select(F.xxhash64("one.doc_id").alias(id_hash), F.col("one.text_hash").alias(text_hash)))
    rows = docs.withColumns({id_hash: F.xxhash64(docs["doc_id"]), text_hash: F.xxhash64(docs["text"])})
    return rows.join(keep, [id_hash, text_hash], "left_semi").dropDuplicates([id_hash, text_hash]).drop(id_hash, text_hash)
