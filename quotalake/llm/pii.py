"""PII: pattern spans, and information-theoretic sanitisation of revealing terms.

Base: e-mail addresses, IP addresses, payment cards and phone numbers by their
patterns (leftmost, non-overlapping per kind, failing matches dropped).

Method: the protected entities are the distinct base values, the secrets, and
each kind of these as a whole, so that values which stand once or twice still
give evidence together.  A secret is a run of ``SECRET_CHARS`` characters or more
of ``[A-Za-z0-9_-]`` that carries at least ``SECRET_BITS`` bits (its length times the
entropy of its characters) and changes between letters and digits
``SECRET_TURNS`` times or more: keys and hashes do, words, dates and slugs do not.
A term, a run of letters and digits, that stands within ``CONTEXT`` terms of an
entity reveals it as far as their pointwise mutual information over the corpus
reaches the entity's own information content:

    PMI(t; e) = log2(n_te * N / (n_t * n_e * 2 * CONTEXT)),
    IC(e)     = log2(N / (n_e * 2 * CONTEXT)),

with n_te the co-occurrences, n_t and n_e all occurrences of term and entity
and N the corpus words.  A term with PMI >= ``GENERALISE`` * IC is generalised,
and with PMI >= ``REMOVE`` * IC removed, if the two share at least
``MIN_CONTEXTS`` different contexts (so that copies of one text are no
evidence).  For a kind they must share as many as ``KIND_SHARE`` of its
occurrences: a term beside few of them says little about the kind, and with it at
most 2 * CONTEXT / KIND_SHARE terms a kind are candidates, however large the
corpus.  A term goes wherever it stands, in documents without the entity too, but
for places inside base spans and secrets; of several entities the strongest action counts.
The documents are scanned again for these terms, by a bitmap of fixed size and
an equality join; their places are added as spans of kind ``term``, the secrets
as spans of kind ``secret``.

Corpus counts cover every document.  They are kept for the words that may be a
candidate term, chosen by a bitmap of fixed size, so what is shuffled is at
most the vocabulary and what the driver holds has a bound.

Cases: a null or empty text has no spans.  Repeated rows are scanned each.  A
very long text is searched whole; all patterns run in linear time.  An empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalake.llm import common as C

CONTEXT = 5
MIN_CONTEXTS = 3
KIND_SHARE = 0.01
GENERALISE = 0.9
REMOVE = 0.98
SECRET_CHARS = 20
SECRET_BITS = 64
SECRET_TURNS = 5
BITMAP_BITS = 18
HELD_TERMS = 1 << 18  # counted in a task before they are sent

KINDS = ("email", "ip", "card", "phone")
SECRET, TERM = "secret", "term"

# Possessive runs and the look-behind change no match; they keep a long run of digits linear.
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")
_SECRET = re.compile(f"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{{{SECRET_CHARS},}}+")
_TURN = re.compile("[0-9][_-]?(?=[A-Za-z])|[A-Za-z][_-]?(?=[0-9])")


def _emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            found.append((start, last))
            at = text.find("@", last)
        else:
            last = max(last, at + 1)
            at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                      if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return found


def is_secret(value: str) -> bool:
    n = len(value)
    bits = sum(c * math.log2(n / c) for c in Counter(value).values())
    return bits >= SECRET_BITS and len(_TURN.findall(value)) >= SECRET_TURNS


def _inside(spans: list[tuple[str, int, int]]):
    """Whether a range overlaps some span."""
    starts, ends, edge = [], [], -1
    for a, b in sorted((a, b) for _, a, b in spans):
        if a < edge:
            ends[-1] = edge = max(edge, b)
        else:
            starts.append(a)
            ends.append(b)
            edge = b

    def overlaps(a: int, b: int) -> bool:
        i = bisect_right(ends, a)
        return i < len(starts) and starts[i] < b

    return overlaps


def secret_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Secrets outside of base spans, by place."""
    taken = _inside(base)
    return [(SECRET, m.start(), m.end()) for m in _SECRET.finditer(text)
            if is_secret(m.group()) and not taken(m.start(), m.end())]


def _contexts(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The terms around each span, outside all spans, with a hash of the whole context."""
    starts, ends, taken, out = array("q"), array("q"), _inside(spans), []
    for m in _TERM.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    for kind, a, b in spans:
        left, right = bisect_right(ends, a), bisect_left(starts, b)
        near = [*range(max(0, left - CONTEXT), left), *range(right, min(len(starts), right + CONTEXT))]
        terms = [text[starts[i]:ends[i]].encode().lower() for i in near if not taken(starts[i], ends[i])]
        context = xxhash.xxh64_intdigest(b" ".join(terms), 0) - (1 << 63)
        out += [{"entity": f"{kind}:{text[a:b].lower()}", "context": context, "term": t.decode("utf-8", "replace"),
                 "term_hash": C.hash_bytes(t) - (1 << 63)} for t in terms]
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("entity", pa.string())]))
_CONTEXTS = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.int64()), ("term", pa.string()),
                                ("term_hash", pa.int64())]))


def find_base(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_hash, base, spans, contexts) of every row; ``row`` numbers the rows, spans hold secrets too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in C.byte_slices(whole):
                base, spans, contexts = [], [], []
                for value in batch.column("text"):
                    text = value.as_py() or ""
                    found = base_spans(text)
                    base.append(",".join(f"{k}:{a}:{b}" for k, a, b in found))
                    found += secret_spans(text, found)
                    spans.append([{"kind": k, "start": a, "stop": b, "entity": f"{k}:{text[a:b].lower()}"}
                                  for k, a, b in found])
                    contexts.append(_contexts(text, found) if found else [])
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), batch.column("doc_id"), batch.column("text_hash"), pa.array(base, pa.string()),
                     pa.array(spans, _SPANS), pa.array(contexts, _CONTEXTS)],
                    names=["row", "doc_id", "text_hash", "base", "spans", "contexts"])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs["text"], F.xxhash64(docs["text"]).alias("text_hash")).mapInArrow(
        run, f"row long, doc_id {kind}, text_hash long, base string, "
        "spans array<struct<kind:string,start:int,stop:int,entity:string>>, "
        "contexts array<struct<entity:string,context:long,term:string,term_hash:long>>")


def corpus_counts(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term_hash, n): occurrences of every word whose hash bucket is ``wanted``; null: all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, counts = 0, np.empty(0, np.uint64), np.empty(0, np.int64)

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array((keys - np.uint64(1 << 63)).view(np.int64)), pa.array(counts)], names=["term_hash", "n"])

        for whole in batches:
            for batch in C.byte_slices(whole):
                offsets, data = C.text_buffer(batch.column("text"))
                h = C.tokenise(offsets, C.ascii_lower(data), C.ALNUM).hash
                total += len(h)
                new, n = np.unique(h[wanted[_bucket(h)]], return_counts=True)
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
                if len(keys) > HELD_TERMS:
                    yield held()
                    keys, counts = keys[:0], counts[:0]
        yield held()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total])], names=["term_hash", "n"])

    return (C.need(docs, "text").mapInArrow(run, "term_hash long, n long")
            .groupBy("term_hash").agg(F.sum("n").alias("n")))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _wanted(terms: DataFrame) -> np.ndarray:
    """The hash buckets of ``terms``."""
    buckets = (terms.select(F.shiftrightunsigned(F.col("term_hash").bitwiseXOR(F.lit(-(1 << 63))), 64 - BITMAP_BITS)
                            .alias("b")).distinct().collect())  # at most 2 ** BITMAP_BITS
    wanted = np.zeros(1 << BITMAP_BITS, bool)
    wanted[[r.b for r in buckets]] = True
    return wanted


def revealing_terms(docs: DataFrame, found: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE,
                    min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """(entity, term, term_hash, pmi, ic, action) of the terms above the disclosure threshold."""
    # a value and its kind: "email:ann@mail.org" and "email:"
    both = F.explode(F.array(F.col("x.entity"), F.concat(F.substring_index("x.entity", ":", 1), F.lit(":")))).alias("entity")
    entities = (found.select(F.explode("spans").alias("x")).select(both)
                .groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    # of a kind, whose name ends with the colon, only terms beside a share of its occurrences
    enough = F.greatest(F.lit(float(min_contexts)),
                        F.when(F.col("entity").endswith(":"), F.col("n_e") * KIND_SHARE).otherwise(0.0))
    candidates = C.materialise(
        found.select(F.explode("contexts").alias("x")).select(both, "x.context", "x.term", "x.term_hash")
        .groupBy("entity", "term", "term_hash", "context").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term", "term_hash").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("support"))
        .where(F.col("support") >= min_contexts)
        .join(entities, "entity").where(F.col("support") >= enough))
    counts = C.materialise(corpus_counts(docs, _wanted(candidates)))
    total = (counts.where("term_hash IS NULL").first() or [None, 0])[1]
    pmi = F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n_t") * F.col("n_e") * F.lit(2.0 * CONTEXT)))
    ic = F.log2(F.lit(float(total)) / (F.col("n_e") * F.lit(2.0 * CONTEXT)))
    return (candidates.join(counts.select("term_hash", F.col("n").alias("n_t")), "term_hash")
            .select("entity", "term", "term_hash", pmi.alias("pmi"), ic.alias("ic"))
            .where((F.col("ic") > 0) & (F.col("pmi") >= generalise * F.col("ic")))
            .withColumn("action", F.when(F.col("pmi") >= remove * F.col("ic"), "remove").otherwise("generalise")))


def term_places(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(id_hash, text_hash, term, start, stop): the words in ``wanted`` buckets outside of base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C.byte_slices(whole):
                offsets, data = C.text_buffer(batch.column("text"))
                lowered = C.ascii_lower(data)
                words = C.tokenise(offsets, lowered, C.ALNUM)
                hit = np.flatnonzero(wanted[_bucket(words.hash)])
                if not len(hit):
                    continue
                row, begin, end = words.row[hit], words.start[hit], words.end[hit]
                letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before a byte
                start, stop = letters[begin] - letters[offsets[row]], letters[end] - letters[offsets[row]]
                free = np.ones(len(hit), bool)
                for r in np.unique(row).tolist():
                    text = batch.column("text")[r].as_py()
                    spans = base_spans(text)
                    spans += secret_spans(text, spans)
                    if spans:
                        taken, mine = _inside(spans), np.flatnonzero(row == r)
                        free[mine] = [not taken(x, y) for x, y in zip(start[mine].tolist(), stop[mine].tolist())]
                row, start, stop, begin, end = (x[free] for x in (row, start, stop, begin, end))
                terms = [lowered[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(begin.tolist(), end.tolist())]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id_hash").take(take), batch.column("text_hash").take(take), pa.array(terms, pa.string()),
                     pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
                    names=["id_hash", "text_hash", "term", "start", "stop"])

    return docs.select(F.xxhash64(docs["doc_id"]).alias("id_hash"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"]
                       ).mapInArrow(run, "id_hash long, text_hash long, term string, start int, stop int")


def find_private(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans, terms) of every row; terms: array of (start, stop, action)."""
    found = C.materialise(find_base(docs))
    flagged = C.materialise(revealing_terms(docs, found).groupBy("term", "term_hash").agg(F.max("action").alias("action")))
    none = F.expr("cast(array() as array<struct<start:int,stop:int,action:string>>)")
    wanted = _wanted(flagged)
    if not wanted.any():
        return found.select("doc_id", "text_hash", "base", "spans", none.alias("terms"))
    places = (term_places(docs, wanted).join(flagged.select("term", "action"), "term")
              .groupBy("id_hash", "text_hash")
              .agg(F.sort_array(F.collect_set(F.struct("start", "stop", "action"))).alias("terms")))
    return (found.withColumn("id_hash", F.xxhash64("doc_id")).join(places, ["id_hash", "text_hash"], "left")
            .select("doc_id", "text_hash", "base", "spans", F.coalesce("terms", none).alias("terms")))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans replaced by their kind, and revealing terms by [TERM] or nothing."""
    id_hash, text_hash, cuts = (C.fresh(docs, c) for c in ("_id_hash", "_text_hash", "_cuts"))
    found = find_private(docs).where("size(spans) > 0 OR size(terms) > 0")
    places = (found.select(F.xxhash64("doc_id").alias(id_hash), F.col("text_hash").alias(text_hash), F.concat(
        F.transform("spans", lambda s: F.struct(s["start"], s["stop"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))),
        F.transform("terms", lambda t: F.struct(t["start"], t["stop"], F.when(t["action"] == "remove", "").otherwise("[TERM]")))
    ).cast("array<struct<start:int,stop:int,by:string>>").alias(cuts))
        .dropDuplicates([id_hash, text_hash]))

    @F.pandas_udf("string")
    def apply(texts, cuts):
        return texts.combine(cuts, _cut_text)

    columns = [F.when(F.col(cuts).isNull(), docs["text"]).otherwise(apply(docs["text"], F.col(cuts))).alias(c)
               if c == "text" else docs[c] for c in docs.columns]
    return (docs.withColumns({id_hash: F.xxhash64(docs["doc_id"]), text_hash: F.xxhash64(docs["text"])})
            .join(places, [id_hash, text_hash], "left").select(*columns))


def _cut_text(text: str | None, cuts) -> str | None:
    if text is None or cuts is None:
        return text
    out, at = [], 0
    for cut in sorted(cuts, key=lambda c: (c["start"], -c["stop"])):
        if cut["start"] >= at:  # of overlapping spans the first and longest is replaced
            out += [text[at:cut["start"]], cut["by"]]
        at = max(at, cut["stop"])
    return "".join(out) + text[at:]

