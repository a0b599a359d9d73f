"""Sharding by histogram sort: shards of near equal bytes, one final exchange.

Every row gets a 63-bit sort key: the high bits are a hash of its text, so equal
texts are neighbours, and the low bits a hash of its id, so that a group of
copies of any size can still be cut anywhere.  The splitters between the shards
are then found without sorting: each round counts, over all partitions, the
exact bytes below evenly spaced probe keys inside the interval known to hold
each splitter, and narrows the interval to one probe step, until the bytes
below a probe are within ``TOLERANCE`` of the wanted share (or one row lies
between).  Only then are the rows exchanged, once, by shard.

Each round returns at most ``(n_shards - 1) * PROBES`` counts to the driver,
whatever the size of the table.

Cases: a null text is an empty one (size 16, CRC of nothing).  A null doc_id is
hashed as null and sharded like any other.  Repeated rows differ in their row
number and may be cut apart.  An empty table gives an empty result.  Texts
larger than a shard's share make shards as even as whole rows allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotalake.llm import common as C

PROBES = 64
TOLERANCE = 0.001
KEY_END = 1 << 63
ROW_OVERHEAD = 16


def with_keys(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` columns (as ``_c0``, ...), size, CRC and sort key of every row, written once."""
    text = F.coalesce(docs["text"], F.lit(""))
    group = F.xxhash64(text).bitwiseAND(F.lit(-(1 << 32)))
    inside = F.xxhash64(docs["doc_id"], F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 32) - 1))
    return C.materialise(docs.select(
        *[docs[c].alias(f"_c{i}") for i, c in enumerate(carry)],
        (F.octet_length(text).cast("long") + F.lit(ROW_OVERHEAD)).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(group.bitwiseOR(inside), 1).alias("_key")))


def _pick(key: Column, bounds: Sequence[int], leaves: Sequence[Column]) -> Column:
    """``leaves[i]`` where i is the number of ``bounds`` at or below the key (binary search)."""
    if not bounds:
        return leaves[0]
    mid = len(bounds) // 2
    return (F.when(key < F.lit(bounds[mid]), _pick(key, bounds[:mid], leaves[:mid + 1]))
            .otherwise(_pick(key, bounds[mid + 1:], leaves[mid + 1:])))


def find_splitters(keyed: DataFrame, n_shards: int, total: int, tolerance: float = TOLERANCE,
                   probes: int = PROBES) -> list[int]:
    """Keys of the ``n_shards - 1`` cuts: shard = number of splitters at or below a key."""
    slack = tolerance * total / n_shards
    target = {j: j * total / n_shards for j in range(1, n_shards)}
    held = {j: (0, KEY_END, 0) for j in target}  # splitter -> [lo, hi) and the bytes below lo
    found: dict[int, int] = {}
    while held:
        spans = sorted(set(held.values()))
        steps = [max(1, -(-(hi - lo) // probes)) for lo, hi, _ in spans]
        key = F.col("_key")
        bounds, leaves = [], [F.lit(None).cast("struct<span:int,cell:long>")]
        for i, ((lo, hi, _), step) in enumerate(zip(spans, steps)):
            inside = F.struct(F.lit(i).alias("span"),
                              F.expr(f"(_key - {lo}L) div {step}L").alias("cell"))
            if bounds and bounds[-1] == lo:
                leaves[-1] = inside
            else:
                bounds.append(lo)
                leaves.append(inside)
            if hi < KEY_END:
                bounds.append(hi)
                leaves.append(F.lit(None).cast("struct<span:int,cell:long>"))
        counts: dict[int, dict[int, tuple[int, int]]] = {}
        for r in (keyed.select(_pick(key, bounds, leaves).alias("at"), "size").where("at IS NOT NULL")
                  .groupBy("at.span", "at.cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()):
            counts.setdefault(r.span, {})[r.cell] = (r.bytes, r.n)
        for i, ((lo, hi, below), step) in enumerate(zip(spans, steps)):
            cells = sorted(counts.get(i, {}).items())
            for j in [j for j, span in held.items() if span == spans[i]]:
                done, cell, size, n = below, 0, 0, 0
                for cell, (size, n) in cells:
                    if done + size > target[j]:
                        break
                    done += size
                else:
                    size = 0
                start, end = lo + cell * step, min(lo + (cell + 1) * step, hi)
                before, after = target[j] - done, done + size - target[j]
                if min(before, after) <= slack or n <= 1 or end - start <= 1:
                    found[j] = start if before <= after else end
                    del held[j]
                else:
                    held[j] = (start, end, done)
    return [min(found[j], KEY_END - 1) for j in sorted(found)]


def shard_by_bytes(docs: DataFrame, n_shards: int, carry: Sequence[str] = ("doc_id",),
                   tolerance: float = TOLERANCE) -> DataFrame:
    """``carry`` columns, size, text_crc32, shard and slot (gapless from 0) of every row."""
    keyed = with_keys(docs, carry)
    total, rows = keyed.agg(F.sum("size"), F.count(F.lit(1))).first()
    splitters = find_splitters(keyed, n_shards, total, tolerance) if rows else []
    shard = _pick(F.col("_key"), splitters, [F.lit(i) for i in range(len(splitters) + 1)])
    # Slots are numbered inside runs of about sqrt(rows) rows, spread by the low key bits.
    runs = max(1, -(-rows // n_shards // max(256, int(rows ** 0.5)))) if rows else 1
    placed = (keyed.withColumn("shard", shard.cast("int"))
              .withColumn("_run", F.pmod(F.xxhash64("_key"), F.lit(runs)).cast("int")))
    before = Window.partitionBy("shard").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "_run").agg(F.count(F.lit(1)).alias("_n"))
               .select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("shard", "_run").orderBy("_key", "text_crc32", "size")
    return (placed.withColumn("_at", F.row_number().over(inside))
            .join(offsets, ["shard", "_run"])
            .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "size", "text_crc32", "shard",
                    (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot")))
