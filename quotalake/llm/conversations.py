"""Conversation structure repair: faults, cheapest edits and the repaired messages.

A conversation's rows stand in the order of turn (nulls first); rows of one turn
in the order of a hash of role and text, so that equal rows are neighbours and
any others have a fixed order.  A row's first fault counts: blank, duplicate
(role and text seen earlier) or truncated (the last visible character is no mark
that ends a sentence).  ``grammar`` finds the cheapest edits that leave the role
initials ``(s?(ua)+)?``.

Usual conversations, up to ``MAX_ROWS`` rows and ``MAX_BYTES`` of text, are sent
to tasks by their id and sorted; a task works on blocks of whole conversations,
whose symbol strings share one grammar and its matrices.  A first, narrow
aggregate finds the others, at most one in ``MAX_ROWS`` rows: these are cut.  Their
rows are dealt out by ranges of (id, turn, ...), so one conversation may lie in any
number of tasks, and written as fragments of at most ``FRAGMENT_ROWS`` rows.
Duplicates are found by an aggregate over (id, message digest); each fragment
gives the matrix of its string; one pass over the matrices of a conversation, in
order, multiplies them and cuts the audit into the fragments' parts; and every
fragment is repaired by itself.  Only the digest of all repaired messages reads a
conversation's fragments in order in one task: SHA-256 cannot be put together
from parts.  That task holds one fragment at a time.

Cases: a null role or text is one space.  A null conversation id is a
conversation of its own, null turns count for no gap.  An empty role has no legal
initial.  Repeated rows are duplicates.  Only the four named columns (and
``absent``) are read.  A conversation whose rows are all ``absent`` has zeros and
an empty audit; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quotalake.llm import common as C
from quotalake.llm import grammar as G

MAX_ROWS = 8192
MAX_BYTES = 32 << 20
FRAGMENT_ROWS = 4096
FRAGMENT_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 16 << 20

SPACE = "\x20\t\n\x0b\f\r"
COLUMNS = ("conv_id", "turn", "role", "text")


def damage(rows: DataFrame) -> DataFrame:
    """Known faults, drawn by crc32 of ``conv_id:turn``: (conv_id, turn, role, text, absent)."""
    def or_space(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = (F.when(draw == 1, F.lit("")).when(draw == 2, F.translate(or_space("text"), ".!?", ""))
            .otherwise(or_space("text")))
    copies = F.when(draw == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(rows["conv_id"], rows["turn"], F.when(draw == 4, F.lit("user")).otherwise(or_space("role")).alias("role"),
                       text.alias("text"), (draw == 0).alias("absent"), F.explode(copies).alias("copy")).drop("copy")


def _prepared(rows: DataFrame, absent: str | None) -> DataFrame:
    """The columns that the tasks need; ``name`` stands for the id and is never null."""
    text = F.coalesce(rows["text"].cast("string"), F.lit(" "))
    role = F.coalesce(rows["role"].cast("string"), F.lit(" "))
    seen = F.rtrim(text, F.lit(SPACE))
    fault = (F.when(seen == "", G.BLANK).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), G.OK).otherwise(G.TRUNCATED))
    gone = F.coalesce(rows[absent], F.lit(False)) if absent else F.lit(False)
    name = F.coalesce(F.concat(F.lit("="), rows["conv_id"].cast("string")), F.lit(""))
    return rows.select(name.alias("name"), rows["conv_id"], rows["turn"].cast("long").alias("turn"), role.alias("role"),
                       text.alias("text"), fault.alias("fault"), gone.alias("absent"), F.xxhash64(role, text).alias("tie"))


# --- what both ways share ----------------------------------------------------

@dataclass
class Conversation:
    """Rows of one conversation (or of one fragment), in order."""

    conv_id: object
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    faults: list = field(default_factory=list)

    def mark_duplicates(self) -> None:
        seen = set()
        for i, message in enumerate(zip(self.roles, self.texts)):
            if message in seen and self.faults[i] != G.BLANK:
                self.faults[i] = G.DUPLICATE
            seen.add(message)

    def kinds(self) -> list[int]:
        return [G.role_class(r) for r in self.roles]

    def symbols(self) -> bytes:
        return bytes(G.terminal(k, f) for k, f in zip(self.kinds(), self.faults))

    def counts(self) -> list[int]:
        return [self.faults.count(f) for f in (G.BLANK, G.DUPLICATE, G.TRUNCATED)]

    def gaps(self) -> int:
        turns = {t for t in self.turns if t is not None}
        return max(turns) - min(turns) + 1 - len(turns) if turns else 0

    def repaired(self, audit: str, state: int = G.START) -> list[tuple[str, str]]:
        return list(G.apply(audit, zip(self.roles, self.texts), state))


def _lines(messages: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in messages)


_RESULT = "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, {out}"
_MESSAGES = "messages array<struct<role: string, text: string>>"


def _message_rows(messages: list[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in messages]


def _record(c: Conversation, cost: int, audit: str) -> dict:
    blank, duplicate, truncated = c.counts()
    return {"conv_id": c.conv_id, "gaps": c.gaps(), "blank": blank, "duplicate": duplicate, "truncated": truncated,
            "illegal": G.illegal_pairs(c.kinds()), "cost": cost, "audit": audit}


def _batches(rows: Iterator[dict], schema: pa.Schema, limit: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(columns: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(columns))


def _values(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


# --- usual conversations -----------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Conversation]]:
    """Whole conversations of sorted rows, about ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` at a time."""
    block: list[Conversation] = []
    name, rows, size = None, 0, 0
    for key, conv_id, turn, role, text, fault, absent in _values(
            batches, "name", "conv_id", "turn", "role", "text", "fault", "absent"):
        if key != name or not block:
            if rows >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield block
                block, rows, size = [], 0, 0
            name = key
            block.append(Conversation(conv_id))
        if not absent:
            c = block[-1]
            c.turns.append(turn)
            c.roles.append(role)
            c.texts.append(text)
            c.faults.append(fault)
            rows, size = rows + 1, size + len(text)
    if block:
        yield block


def _usual(rows: DataFrame, kind: str, messages: bool) -> DataFrame:
    columns = _RESULT.format(kind=kind, out=_MESSAGES if messages else "repaired_sha256 string")
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for block in _blocks(batches):
                for c in block:
                    c.mark_duplicates()
                for c, (cost, audit) in zip(block, G.cheapest([c.symbols() for c in block])):
                    done = c.repaired(audit)
                    out = ({"messages": _message_rows(done)} if messages
                           else {"repaired_sha256": hashlib.sha256(_lines(done).encode()).hexdigest()})
                    yield _record(c, cost, audit) | out

        yield from _batches(found(), schema, 256 if messages else 4096)

    return rows.repartition("name").sortWithinPartitions("name", F.asc_nulls_first("turn"), "tie").mapInArrow(run, columns)


# --- conversations of any size -----------------------------------------------

_KEY = ("name", "part", "number")
_FRAGMENT = ("name string, conv_id {kind}, part long, number long, roles array<string>, texts array<string>, "
             "faults array<int>, digests array<binary>")


def _fragments(rows: DataFrame, kind: str) -> DataFrame:
    """Runs of rows of one conversation; (part, number) is their order."""
    columns = _FRAGMENT.format(kind=kind)
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, name, size = TaskContext.get().partitionId(), 0, None, None, 0

        def row() -> dict:
            return {"name": name, "conv_id": held.conv_id, "part": part, "number": number, "roles": held.roles,
                    "texts": held.texts, "faults": held.faults,
                    "digests": [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(held.roles, held.texts)]}

        for key, conv_id, role, text, fault in _values(batches, "name", "conv_id", "role", "text", "fault"):
            if held is None or key != name or len(held.roles) >= FRAGMENT_ROWS or size >= FRAGMENT_BYTES:
                if held is not None:
                    yield pa.RecordBatch.from_pylist([row()], schema)
                    number += 1
                held, name, size = Conversation(conv_id), key, 0
            held.roles.append(role)
            held.texts.append(text)
            held.faults.append(fault)
            size += len(text)
        if held is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    order = [F.col("name"), F.asc_nulls_first("turn"), F.col("tie")]
    # equal rows may be told apart by any number: it only lets a range end among them
    dealt = rows.withColumn("any", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("any"))
    return C.materialise(dealt.sortWithinPartitions(*order, "any").mapInArrow(run, columns))


def _with_duplicates(fragments: DataFrame) -> DataFrame:
    """Fragments with their rows' first faults; an earlier row may stand in any fragment."""
    place = F.struct("part", "number", "at")
    rows = fragments.select(*_KEY, F.posexplode("digests").alias("at", "digest"))
    repeated = (rows.groupBy("name", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                .where("n > 1").drop("n"))
    later = (rows.join(repeated, ["name", "digest"]).where(place != F.col("first"))
             .groupBy(*_KEY).agg(F.collect_list("at").alias("later")))
    marked = F.transform("faults", lambda f, i: F.when(
        (f != G.BLANK) & F.array_contains(F.coalesce("later", F.array().cast("array<int>")), i), G.DUPLICATE).otherwise(f))
    return C.materialise(fragments.drop("digests").join(later, list(_KEY), "left").withColumn("faults", marked).drop("later"))


_MATRIX = ("name string, conv_id {kind}, part long, number long, n long, blank long, duplicate long, truncated long, "
           "illegal long, kinds binary, costs array<long>, audits array<string>")


def _matrices(fragments: DataFrame, kind: str) -> DataFrame:
    """Counts and matrix of every fragment."""
    columns = _MATRIX.format(kind=kind)
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, conv_id, part, number, roles, faults in _values(
                batches, "name", "conv_id", "part", "number", "roles", "faults"):
            c = Conversation(conv_id, roles=roles, faults=faults)
            cells = G.Programme([c.symbols()]).product(0)
            blank, duplicate, truncated = c.counts()
            kinds = c.kinds()
            yield pa.RecordBatch.from_pylist([{
                "name": name, "conv_id": conv_id, "part": part, "number": number, "n": len(roles), "blank": blank,
                "duplicate": duplicate, "truncated": truncated, "illegal": G.illegal_pairs(kinds), "kinds": bytes(kinds),
                "costs": [None if x is None else x[0] for x in cells],
                "audits": [None if x is None else G.text(x[1]) for x in cells]}], schema)

    return fragments.select("name", "conv_id", "part", "number", "roles", "faults").mapInArrow(run, columns)


_PART = ("name string, conv_id {kind}, part long, number long, state int, piece string, last boolean, blank long, "
         "duplicate long, truncated long, illegal long, cost long, audit string")


def _pieces(audit: str, rows: list[int]) -> Iterator[str]:
    """The audit cut behind the last edit of each run of rows; inserts at the end go to the last run."""
    at = 0
    for i, n in enumerate(rows):
        stop = at
        while n:
            n -= audit[stop] != G.INSERT
            stop += 1
        yield audit[at:] if i == len(rows) - 1 else audit[at:stop]
        at = stop


def _parts(matrices: DataFrame, kind: str) -> DataFrame:
    """Each fragment's part of its conversation's audit; the last one carries the conversation's result."""
    columns = _PART.format(kind=kind)
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(runs: list[dict], vector: list[G.Cell], counts: list[int]) -> Iterator[dict]:
            cost, rope = G.finish(vector)
            audit = G.text(rope)
            totals = dict(zip(("blank", "duplicate", "truncated", "illegal"), counts)) | {"cost": cost, "audit": audit}
            state = G.START
            for i, (key, piece) in enumerate(zip(runs, _pieces(audit, [len(r["kinds"]) for r in runs]))):
                end = i == len(runs) - 1
                kinds = key.pop("kinds")
                yield key | {"state": state, "piece": piece, "last": end, **(totals if end else {})}
                state = G.state_behind(piece, kinds, state)

        def found() -> Iterator[dict]:
            runs: list[dict] = []
            vector, counts = G.BEGIN, [0] * 4
            for name, conv_id, part, number, *faults, kinds, costs, audits in _values(
                    batches, "name", "conv_id", "part", "number", "blank", "duplicate", "truncated", "illegal",
                    "kinds", "costs", "audits"):
                if runs and runs[-1]["name"] != name:
                    yield from results(runs, vector, counts)
                    runs, vector, counts = [], G.BEGIN, [0] * 4
                vector = G.row_times(vector, [None if x is None else (x, a) for x, a in zip(costs, audits)])
                counts = [a + b for a, b in zip(counts, faults)]
                if runs:
                    counts[3] += G.illegal_pairs([runs[-1]["kinds"][-1], kinds[0]])
                runs.append({"name": name, "conv_id": conv_id, "part": part, "number": number, "kinds": kinds})
            if runs:
                yield from results(runs, vector, counts)

        yield from _batches(found(), schema, 64)

    return C.materialise(matrices.repartition("name").sortWithinPartitions(*_KEY).mapInArrow(run, columns))


def _repaired(fragments: DataFrame, parts: DataFrame, kind: str, messages: bool) -> DataFrame:
    """(name, conv_id, part, number, last, messages or lines): every fragment repaired by itself."""
    columns = f"name string, conv_id {kind}, part long, number long, last boolean, {_MESSAGES if messages else 'lines string'}"
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for name, conv_id, part, number, last, roles, texts, state, piece in _values(
                    batches, "name", "conv_id", "part", "number", "last", "roles", "texts", "state", "piece"):
                done = Conversation(conv_id, roles=roles, texts=texts).repaired(piece, state)
                out = {"messages": _message_rows(done)} if messages else {"lines": _lines(done) if done else None}
                yield {"name": name, "conv_id": conv_id, "part": part, "number": number, "last": last} | out

        yield from _batches(found(), schema, 1)

    return (fragments.select(*_KEY, "conv_id", "roles", "texts")
            .join(parts.select(*_KEY, "state", "piece", "last"), list(_KEY)).mapInArrow(run, columns))


def _digests(lines: DataFrame) -> DataFrame:
    """(name, repaired_sha256): reads each conversation's fragments in order, one at a time."""
    columns = "name string, repaired_sha256 string"
    schema = _arrow(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            digest, begun = hashlib.sha256(), False
            for name, last, text in _values(batches, "name", "last", "lines"):
                if text is not None:
                    digest.update((("\n" if begun else "") + text).encode())
                    begun = True
                if last:
                    yield {"name": name, "repaired_sha256": digest.hexdigest()}
                    digest, begun = hashlib.sha256(), False

        yield from _batches(found(), schema)

    return (lines.repartition("name").sortWithinPartitions(*_KEY).select("name", "last", "lines")
            .mapInArrow(run, columns))


def _gaps(rows: DataFrame) -> DataFrame:
    turns = rows.where("turn IS NOT NULL").select("name", "turn").distinct()
    return turns.groupBy("name").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))


# --- the operator ------------------------------------------------------------

def _split(rows: DataFrame, max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of usual conversations, rows of the larger ones without the absent, if there are any)."""
    size = (F.octet_length("role") + F.octet_length("text")).cast("long")
    large = C.materialise(rows.where("NOT absent").groupBy("name").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
                          .where((F.col("n") > max_rows) | (F.col("bytes") > max_bytes)).select("name"))
    if large.isEmpty():
        return rows, None
    return rows.join(large, "name", "left_anti"), rows.where("NOT absent").join(large, "name", "left_semi")


def _cut(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(fragments, parts) of conversations of any size."""
    fragments = _with_duplicates(_fragments(rows, kind))
    return fragments, _parts(_matrices(fragments, kind), kind)


def repair(rows: DataFrame, absent: str | None = None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per conversation: conv_id, gaps, fault counts, illegal pairs, cost, audit, repaired_sha256.

    ``absent`` names a boolean column: where it is true the row is no message,
    but its conversation still has a result.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    usual, large = _split(_prepared(rows, absent), max_rows, max_bytes)
    done = _usual(usual, kind, messages=False)
    if large is None:
        return done
    fragments, parts = _cut(large, kind)
    whole = (parts.where("last").join(_digests(_repaired(fragments, parts, kind, messages=False)), "name")
             .join(_gaps(large), "name", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0))))
    return done.unionByName(whole.select(*done.columns))


def repaired_messages(rows: DataFrame, absent: str | None = None, max_rows: int = MAX_ROWS,
                      max_bytes: int = MAX_BYTES) -> DataFrame:
    """(conv_id, part, number, messages): the repaired messages; a larger conversation in runs, in this order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    usual, large = _split(_prepared(rows, absent), max_rows, max_bytes)
    zero = F.lit(0).cast("long")
    done = _usual(usual, kind, messages=True).select("conv_id", zero.alias("part"), zero.alias("number"), "messages")
    if large is None:
        return done
    return done.unionByName(_repaired(*_cut(large, kind), kind, messages=True).select(*done.columns))
