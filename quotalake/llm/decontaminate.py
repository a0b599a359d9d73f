"""Benchmark decontamination by winnowing (DataFrame and SQL functions only).

Words are lower-cased; a benchmark window is ``WINDOW`` consecutive item words
(a shorter item is one window).  Of every ``WINNOW`` consecutive word
``GRAM``-grams of a document, the one with the smallest hash is kept as a
fingerprint; GRAM + WINNOW - 1 = WINDOW, so every shared span of WINDOW words
or more holds a fingerprint of the document whose gram the item has too.

1. The item grams are the test fingerprints.  A bitmap of their hashes (size
   bounded by ``MAX_BITS``) is a constant of the scan, which winnows each
   document and keeps the fingerprints that the bitmap lets through, each with
   the words around it.  No text leaves the scan.
2. These fingerprints are equality-joined with the test fingerprints.
3. A hit is extended: the WINNOW windows around it are equality-joined, as
   text, with the benchmark windows, so nothing rests on hashes alone.

Items shorter than WINDOW hold no full run of grams; for each of their (at
most WINDOW - 1) lengths the scan tests every run of that many words instead.

Documents are cut into chunks of ``CHUNK`` windows (overlapping by WINDOW - 1
words), which bounds the work on one very long text.

Cases: a null text or item has no words; an item without words has no window.
Items with a null item_id are ignored (they cannot be listed).  Repeated rows
of documents each get the result; items that share an item_id are one item.
Empty tables give no hits or no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotalake.llm import common as C
from quotalake.llm.native import ascii_lower, words

WINDOW = 10
GRAM = 5
WINNOW = WINDOW - GRAM + 1
CHUNK = 4096
MIN_BITS, MAX_BITS = 1 << 16, 1 << 22
_POS_BITS = 13  # a position inside a chunk of CHUNK + WINDOW - 1 words


def _hash_run(array: str, at: str, n: int) -> str:
    return f"xxhash64({', '.join(f'{array}[{at} + {i}]' for i in range(n))})"


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, window, n): every window of every item, its words joined by a space."""
    items = (C.need(benchmark, "item_id", "text").where("item_id IS NOT NULL")
             .select("item_id", words(ascii_lower(F.coalesce("text", F.lit("")))).alias("w"))
             .where(F.size("w") > 0))
    n = F.least(F.size("w"), F.lit(WINDOW))
    return (items.select("item_id", "w", n.alias("n"),
                         F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
            .select("item_id", F.concat_ws(" ", F.slice("w", F.col("i"), F.col("n"))).alias("window"), "n")
            .distinct())


def _grams(windows: DataFrame) -> DataFrame:
    """Distinct test fingerprints: (length of the run, hash)."""
    w = windows.select("n", F.split("window", " ").alias("w"))
    h = w.select("n", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    full = (h.where(F.col("n") == WINDOW)
            .select(F.lit(GRAM).alias("n"), F.explode(F.expr(
                f"transform(sequence(0, {WINNOW - 1}), i -> shiftright({_hash_run('h', 'i', GRAM)}, {_POS_BITS}))"
            )).alias("gram")))
    for n in range(1, WINDOW):
        short = h.where(F.col("n") == n).select(
            F.lit(-n).alias("n"), F.expr(f"shiftright({_hash_run('h', '0', n)}, {_POS_BITS})").alias("gram"))
        full = full.unionByName(short)
    return full.distinct()


class _Bitmap:
    """A bitmap of hashes as one array constant of 64-bit words."""

    def __init__(self, grams: DataFrame, count: int):
        bits = MIN_BITS
        while bits < 16 * count and bits < MAX_BITS:
            bits *= 2
        self.bits = bits
        cells = [0] * (bits // 64)
        for r in (grams.select(F.pmod("gram", F.lit(bits)).alias("b")).distinct()
                  .groupBy(F.expr("b div 64").alias("cell"))
                  .agg(F.bit_or(F.expr("shiftleft(1L, int(b % 64))")).alias("word")).collect()):
            cells[r.cell] = r.word  # at most bits / 64 rows
        self.sql = f"cast(split('{','.join(map(str, cells))}', ',') as array<bigint>)"

    def holds(self, gram: str) -> str:
        at = f"pmod({gram}, {self.bits})"
        return f"bit_get(element_at({self.sql}, int({at} div 64) + 1), int({at} % 64)) = 1"


def _around(chunk: str, at: str, back: int, length: int) -> str:
    """First word position (in the chunk) and the words from ``back`` before ``at`` on."""
    first = f"greatest({at} - {back}, 0)"
    return f"'at', base + {first}, 'w', slice({chunk}, {first} + 1, {at} - {first} + {length})"


def scan(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Per chunk: doc_id, text hash, chunk number, n_words, and the passing fingerprints.

    A fingerprint is (n, gram, at, w): WINDOW-word neighbourhood ``w`` from word ``at`` on,
    or for a short run its own words.
    """
    counts = {r.n: r.c for r in grams.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    text = F.coalesce(docs["text"], F.lit(""))
    kind = "array<struct<n:int,gram:bigint,at:int,w:array<string>>>"
    base = (docs.select(docs["doc_id"], F.xxhash64(text).alias("text_hash"), words(ascii_lower(text)).alias("w"))
            .select("doc_id", "text_hash", "w", F.size("w").cast("long").alias("n_words"),
                    F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)), F.lit(CHUNK)))
                    .alias("base"))
            .select("doc_id", "text_hash", "n_words", "base",
                    F.slice("w", F.col("base") + 1, F.lit(CHUNK + WINDOW - 1)).alias("w"))
            .withColumn("h", F.transform("w", lambda x: F.xxhash64(x))))
    parts: list[Column] = []
    if counts.get(GRAM):
        bitmap = _Bitmap(grams.where(F.col("n") == GRAM), counts[GRAM])
        mask = (1 << _POS_BITS) - 1
        base = (base.withColumn("g", F.expr(
            f"case when size(h) >= {WINDOW} then transform(sequence(0, size(h) - {GRAM}), i -> "
            f"shiftleft(shiftright({_hash_run('h', 'i', GRAM)}, {_POS_BITS}), {_POS_BITS}) | i) end"))
            .withColumn("m", F.expr(
                f"case when g is not null then array_distinct(transform(sequence(0, size(g) - {WINNOW}), i -> "
                f"least({', '.join(f'g[i + {j}]' for j in range(WINNOW))}))) end")))
        passing = f"filter(m, x -> {bitmap.holds(f'shiftright(x, {_POS_BITS})')})"
        at = f"int(x & {mask})"
        parts.append(F.expr(
            f"coalesce(transform({passing}, x -> named_struct('n', {GRAM}, 'gram', shiftright(x, {_POS_BITS}), "
            f"{_around('w', at, WINNOW - 1, WINDOW)})), cast(array() as {kind}))"))
    for n in range(1, WINDOW):
        if counts.get(-n):
            bitmap = _Bitmap(grams.where(F.col("n") == -n), counts[-n])
            gram = f"shiftright({_hash_run('h', 'i', n)}, {_POS_BITS})"
            parts.append(F.expr(
                f"case when size(h) >= {n} then transform(filter(sequence(0, size(h) - {n}), i -> "
                f"{bitmap.holds(gram)}), i -> named_struct('n', {-n}, 'gram', {gram}, "
                f"{_around('w', 'i', 0, n)})) else cast(array() as {kind}) end"))
    seeds = F.concat(*[p.cast(kind) for p in parts]) if parts else F.expr(f"cast(array() as {kind})")
    return base.select("doc_id", "text_hash", "n_words", "base", seeds.alias("seeds"))


def hits(scanned: DataFrame, grams: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, n, window): every occurrence of a benchmark window."""
    seeds = scanned.select("doc_id", "text_hash", F.explode("seeds").alias("s")).select("doc_id", "text_hash", "s.*")
    joined = seeds.join(grams, ["n", "gram"])
    runs = F.when(F.col("n") < 0, F.lit(1)).otherwise(F.size("w") - WINDOW + 1)
    length = F.when(F.col("n") < 0, -F.col("n")).otherwise(F.lit(WINDOW))
    near = (joined.withColumn("length", length)
            .where(runs >= 1)
            .select("doc_id", "text_hash", "at", "w", "length", F.explode(F.sequence(F.lit(1), runs)).alias("i"))
            .select("doc_id", "text_hash", (F.col("at") + F.col("i") - 1).alias("start"), "length",
                    F.concat_ws(" ", F.slice("w", F.col("i"), F.col("length"))).alias("window"))
            .dropDuplicates(["doc_id", "text_hash", "start", "length"]))
    return near.join(windows.select("window").distinct(), "window").withColumnRenamed("length", "n")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items (sorted ids) and contaminated, per row."""
    windows = C.materialise(benchmark_windows(benchmark))
    grams = C.materialise(_grams(windows.select("window", "n").distinct()))
    scanned = C.materialise(scan(docs, grams))
    found = C.materialise(hits(scanned, grams, windows))
    key = ["doc_id", "text_hash"]
    before = (Window.partitionBy(*key).orderBy("start", "n")
              .rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("n")
    cover = (found.withColumn("_end", end)
             .withColumn("_done", F.coalesce(F.max("_end").over(before), F.lit(0)))
             .groupBy(*key)
             .agg(F.sum(F.greatest(F.col("_end") - F.greatest("start", "_done"), F.lit(0))).alias("n_hit")))
    items = (found.select(*key, "window").distinct()
             .join(windows.select("window", "item_id"), "window")
             .select(*key, F.col("item_id").cast("string").alias("item_id")).distinct()
             .groupBy(*key).agg(F.sort_array(F.collect_list("item_id")).alias("items")))

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])

    rows = scanned.where("base = 0").select(*key, "n_words")
    facts = cover.join(items, same(cover, items)).select(cover["doc_id"], cover["text_hash"], "n_hit", "items")
    return (rows.join(facts, same(rows, facts), "left")
            .select(rows["doc_id"], rows["text_hash"], "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("items", F.expr("cast(array() as array<string>)"))).cast("long").alias("n_items"),
                    F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
