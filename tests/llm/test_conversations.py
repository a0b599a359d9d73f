"""Conversation repair: against a shortest-path search, and every edit script of tiny conversations."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotalake.llm import common as C
from quotalake.llm import conversations as V
from quotalake.llm import grammar as G

SCHEMA = "conv_id long, turn long, role string, text string, name string, part string, cost int, tie string"
SPACE = " \t\n\x0b\f\r"


@pytest.fixture(scope="module")
def talk(spark):
    C.ship_code(spark)

    def make(rows, partitions=3):
        df = spark.createDataFrame([(*r, "n", "p", 1, "t") for r in rows], SCHEMA)
        return df.repartition(partitions) if rows else df

    return make


# --- plain versions ----------------------------------------------------------

def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        left = text.rstrip(SPACE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """(cost, audit, repaired rows) by Dijkstra over (row, last initials); ties by audit."""
    wrong = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(kept)

        def go(initial, more, letter, step, message):
            ok = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if initial and initial in ok:
                heapq.heappush(heap, (cost + more, audit + letter, i + step, initial, (*kept, message)))

        go("u", 2, "I", 0, ("user", ""))
        go("a", 2, "I", 0, ("assistant", ""))
        if i == len(rows):
            continue
        role, text = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, kept))
        if wrong[i] in ("blank", "duplicate"):
            continue
        late = wrong[i] == "truncated"
        go(role[:1], late, "K", 1, (role, text))
        go("u", 2 + late, "R", 1, ("user", text))
        go("a", 2 + late, "R", 1, ("assistant", text))


def every_script(rows):
    """(cost, audit) over all scripts with at most two inserts in a row."""
    wrong = faults(rows)
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    best = None
    ways = [([("D", 3, "")] + ([] if w in ("blank", "duplicate") else
             [("K", w == "truncated", role[:1]), ("R", 2 + (w == "truncated"), "u"), ("R", 2 + (w == "truncated"), "a")]))
            for (role, _), w in zip(rows, wrong)]
    for edits in itertools.product(*ways):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, initials = 0, "", ""
            for i, extra in enumerate(added):
                cost, audit, initials = cost + 2 * len(extra), audit + "I" * len(extra), initials + "".join(extra)
                if i < len(edits):
                    letter, more, initial = edits[i]
                    if letter == "K" and not initial:
                        break
                    cost, audit, initials = cost + more, audit + letter, initials + initial
            else:
                if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def ordered(rows):
    """Rows with one turn must be equal here: any order of them is the same."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def brute(rows):
    """Full result for (conv_id, turn, role, text, absent) rows."""
    talks = defaultdict(list)
    for conv, turn, role, text, absent in rows:
        talks[conv]
        if not absent:
            talks[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, messages in talks.items():
        messages = ordered(messages)
        plain = [m[1:] for m in messages]
        wrong = faults(plain)
        turns = {m[0] for m in messages} - {None}
        cost, audit, kept = search(plain)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(plain, plain[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, wrong.count("blank"), wrong.count("duplicate"),
                     wrong.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(), kept)
    return out


def got(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def messages(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.part, r.number)):
        out[r.conv_id] += [(m.role, m.text) for m in r.messages]
    return dict(out)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text, d == 0)] * (2 if d == 3 else 1)
    return out


# --- the programme -----------------------------------------------------------

ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "usher", "System"]),
                          st.sampled_from(["a.", "b!", "c", "", " \n", "d? "])), max_size=9)


def symbols(rows):
    code = {"": G.OK, "blank": G.BLANK, "duplicate": G.DUPLICATE, "truncated": G.TRUNCATED}
    return bytes(G.terminal(G.role_class(r), code[f]) for (r, _), f in zip(rows, faults(rows)))


@given(st.lists(ROWS, min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_blocks_of_any_conversations(talks):
    found = G.cheapest([symbols(t) for t in talks])
    for rows, (cost, audit) in zip(talks, found):
        want = search(rows)
        assert (cost, audit) == want[:2]
        assert list(G.apply(audit, iter(rows))) == want[2]


@pytest.mark.parametrize("seed", range(25))
def test_search_agrees_with_every_script(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", "", "c."])) for _ in range(rng.randint(0, 2))]
    assert search(rows)[:2] == every_script(rows) == G.cheapest([symbols(rows)])[0]


@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % G.TERMINALS for x in b)), max_size=20))
@settings(max_examples=200, deadline=None)
def test_grammar_derives_its_strings_and_no_pair_is_left(strings):
    rules, rest = G.re_pair(strings)

    def derive(symbol):
        if symbol < G.TERMINALS:
            return bytes([symbol])
        a, b = rules[symbol - G.TERMINALS]
        return derive(a) + derive(b)

    assert [b"".join(map(derive, r)) for r in rest] == strings
    seen = defaultdict(set)
    for k, r in enumerate(rest):
        for i, pair in enumerate(zip(r, r[1:])):
            seen[pair].add((k, i))
    for (a, b), places in seen.items():
        assert len(places) == 1 or (a == b and len(places) <= 2)


def test_long_strings_are_fast_and_right():
    rng = random.Random(5)
    rows = [(rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", "", "c."])) for _ in range(600)]
    assert G.cheapest([symbols(rows)])[0] == search(rows)[:2]
    (cost, audit), = G.cheapest([bytes(rng.randrange(9) for _ in range(60_000))])
    assert len(audit) >= 60_000 and cost > 60_000


@given(ROWS, st.lists(st.integers(0, 8), max_size=3))
@settings(max_examples=100, deadline=None)
def test_pieces_of_an_audit_go_on_where_the_last_one_ended(rows, cuts):
    cost, audit, kept = search(rows)
    edges = sorted({0, len(rows), *[c for c in cuts if c < len(rows)]})
    runs = [rows[a:b] for a, b in zip(edges, edges[1:])]
    state, out = G.START, []
    for run, piece in zip(runs, V._pieces(audit, [len(r) for r in runs])):
        out += G.apply(piece, iter(run), state)
        state = G.state_behind(piece, [G.role_class(r) for r, _ in run], state)
    if rows:
        assert out == kept


# --- the operator ------------------------------------------------------------

ODD = [
    (1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A."),
    (2, 0, "user", "Q?"), (2, 1, "user", "Q?"), (2, 5, "assistant", "no end"),
    (3, None, "assistant", "A."), (3, None, "assistant", "A."), (3, 4, "user", "x!"),
    (4, 0, None, None), (4, 1, "user", None), (4, 2, None, "text."),
    (5, 0, "", "empty role."), (5, 1, "usher", "other u."), (5, 2, "aide", "other a."),
    (None, 0, "user", "Q?"), (None, None, "assistant", "A."),
    (6, 3, "system", "only a system message."), (7, 7, "user", "日本語。"), (7, 8, "assistant", "end.  "),
    (8, 0, "user", "a:b\nc."), (8, 1, "assistant", "x" * 100_000 + "."), (9, 0, "user", "\x00."), (9, 2, "user", "\x0b"),
]


def long_talks():
    rng = random.Random(11)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    return [(100 + c, t, rng.choice(roles), rng.choice(["Hello.", "so", "Why?", "", f"text {t % 7}!", f"n{t}."]))
            for c in range(3) for t in range(0, 700, 1 + c) if rng.random() < 0.9]


def check(df, rows, **limits):
    want = brute([(*r, False) if len(r) == 4 else r for r in rows])
    absent = "absent" if "absent" in df.columns else None
    assert got(V.repair(df, absent, **limits)) == {c: w[:8] for c, w in want.items()}
    assert messages(V.repaired_messages(df, absent, **limits)) == {c: w[8] for c, w in want.items()}


def test_odd_rows(talk):
    check(talk(ODD), ODD)


def test_damaged_rows_with_conversations_that_lose_all(talk):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c}.") for c in range(1000, 1150) for t in range(1 + c % 3)] + ODD
    spoilt = damaged(rows)
    assert any(all(r[4] for r in spoilt if r[0] == c) for c in range(1000, 1150))
    check(V.damage(talk(rows)), spoilt)


def test_cut_conversations_equal_whole_ones(talk, monkeypatch):
    monkeypatch.setattr(V, "FRAGMENT_ROWS", 7)
    rows = long_talks() + ODD
    check(talk(rows, 5), rows, max_rows=20)
    check(V.damage(talk(rows, 5)), damaged(rows), max_rows=0)


def test_large_by_bytes(talk):
    check(talk(ODD), ODD, max_bytes=50_000)


def test_a_conversation_of_one_row_many_times(talk):
    rows = [(1, 0, "user", "same.")] * 3000 + [(1, 1, "assistant", "answer.")]
    check(talk(rows, 4), rows, max_rows=100)


def test_sf_table(spark):
    C.ship_code(spark)
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    check(V.damage(df), damaged([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]))


def test_empty_table(talk):
    assert V.repair(V.damage(talk([])), "absent").count() == 0
    assert V.repair(talk([]), max_rows=0).count() == 0
