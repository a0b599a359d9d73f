"""Cheapest role/fault repair by a grammar-compressed min-plus dynamic programme.

A conversation is a string of terminals, one per row: its role class and what is
wrong with it.  Edit scripts move through the states of ``(s?(ua)+)?`` (``START``,
behind the system message, behind a user, behind an assistant message), so a row
is a 4 x 4 matrix: the cheapest way from one state to another over this row and
the inserts before it.  A cell holds the cost and the audit, the edits' initials,
as a rope; strings of rows are products in the min-plus semiring whose ties go to
the ASCII-least audit.  Two different audits of one cost for the same rows never
begin one another (each insert costs), so the least of a product comes from least
factors.

Re-Pair replaces the pairs of symbols that stand most often side by side by rule
symbols, until no pair stands twice; all strings share one grammar.  A rule's
matrix is one product of its two halves' matrices, evaluated once, bottom-up; a
string is what remains of it, a short product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Costs and initials of the edits.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state behind the message that may be put in (or made by a rerole) in each state, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = (None, "system", "user", "assistant")

OK, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Role classes 0 to 2 are the initials s, u, a; every other role is of class 3.
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER = 3
_KEPT_FROM = {0: (START,), 1: (START, SYSTEM, ASSISTANT), 2: (USER,), 3: ()}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
GONE = 8
TERMINALS = 9

# A rope is a string or a pair of ropes; a cell is (cost, rope) or None, a matrix 16 cells.
Rope = str | tuple
Cell = tuple[int, Rope] | None


def role_class(role: str) -> int:
    return CLASSES.get(role[:1], OTHER)


def terminal(kind: int, fault: int) -> int:
    """The symbol of a row; rows that must go are all the same."""
    return GONE if fault in (BLANK, DUPLICATE) else 2 * kind + (fault == TRUNCATED)


def illegal_pairs(kinds: Sequence[int]) -> int:
    """Adjacent rows whose role initials are none of su, ua, au."""
    return sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:]))


# --- ropes -------------------------------------------------------------------

def join(a: Rope, b: Rope) -> Rope:
    if not a:
        return b
    return (a, b) if b else a


def leaves(rope: Rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top[1], top[0])


def text(rope: Rope) -> str:
    return "".join(leaves(rope))


def less(a: Rope, b: Rope) -> bool:
    """Whether ``a`` is ASCII-less than ``b``; parts that both share are passed over at once."""
    left, right, x, y = [a], [b], "", ""
    while True:
        while not x and not y and left and right and left[-1] is right[-1]:
            left.pop()
            right.pop()
        x, y = _more(x, left), _more(y, right)
        if x is None or y is None:  # a pair of ropes lies open: look again for shared parts
            x, y = x or "", y or ""
            continue
        n = min(len(x), len(y))
        if not n:
            return len(x) < len(y)
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _more(held: str, stack: list[Rope]) -> str | None:
    """``held``, or the next leaf of ``stack``; None if a pair was opened instead."""
    if held or not stack:
        return held
    top = stack.pop()
    if isinstance(top, str):
        return top
    stack += (top[1], top[0])
    return None


def _better(new: Cell, old: Cell) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and less(new[1], old[1]))


# --- matrices ----------------------------------------------------------------

def _inserts(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, audit) of putting in no, one or two messages; more would come back to a state."""
    seen, cost, audit = set(), 0, ""
    while state not in seen:
        yield state, cost, audit
        seen.add(state)
        state, cost, audit = NEXT[state], cost + INSERT_COST, audit + INSERT


def _terminal_matrix(symbol: int) -> list[Cell]:
    cells: list[Cell] = [None] * 16
    for begin in STATES:
        for state, cost, audit in _inserts(begin):
            ways = [(state, DELETE_COST, DELETE)]
            if symbol != GONE:
                kind, worse = symbol // 2, TRUNCATED_COST * (symbol % 2)
                ways.append((NEXT[state], REROLE_COST + worse, REROLE))
                if state in _KEPT_FROM[kind]:
                    ways.append((kind + 1, worse, KEEP))
            for end, more, letter in ways:
                new = (cost + more, audit + letter)
                if _better(new, cells[4 * begin + end]):
                    cells[4 * begin + end] = new
    return cells


TERMINAL_MATRICES = [_terminal_matrix(symbol) for symbol in range(TERMINALS)]


def row_times(vector: Sequence[Cell], matrix: Sequence[Cell]) -> list[Cell]:
    """A row of cells times a matrix."""
    out: list[Cell] = [None] * 4
    for mid, first in enumerate(vector):
        if first is None:
            continue
        for end in STATES:
            second = matrix[4 * mid + end]
            if second is None:
                continue
            new = (first[0] + second[0], join(first[1], second[1]))
            if _better(new, out[end]):
                out[end] = new
    return out


def times(left: Sequence[Cell], right: Sequence[Cell]) -> list[Cell]:
    return [cell for begin in STATES for cell in row_times(left[4 * begin:4 * begin + 4], right)]


BEGIN: list[Cell] = [(0, ""), None, None, None]
ONE: list[Cell] = [(0, "") if i % 5 == 0 else None for i in range(16)]
#: Strings of up to so many symbols are multiplied from left to right.
SHORT = 24


def finish(vector: Sequence[Cell]) -> tuple[int, Rope]:
    """The cheapest way on to a whole conversation: nothing at all, or one that ends with an assistant message."""
    best: Cell = None
    for begin, cell in enumerate(vector):
        for state, cost, audit in _inserts(begin) if cell is not None else ():
            if state in (START, ASSISTANT):
                new = (cell[0] + cost, join(cell[1], audit))
                if _better(new, best):
                    best = new
    return best


# --- Re-Pair -----------------------------------------------------------------

def re_pair(strings: Sequence[bytes]) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """(rules, what remains of each string); rule i is symbol ``TERMINALS + i``.

    Each round takes the most frequent pairs of which no two share a symbol, so
    that their places cannot overlap; in a run of one symbol every other place counts.
    """
    flat = np.frombuffer(b"".join(s + b"\xff" for s in strings), np.uint8).astype(np.int64)
    flat[flat == 0xFF] = -1
    rules: list[tuple[int, int]] = []
    while len(flat) > 1:
        left, right = flat[:-1], flat[1:]
        runs = np.flatnonzero(np.diff(flat, prepend=-2))
        inside = np.arange(len(flat)) - np.repeat(runs, np.diff(np.append(runs, len(flat))))
        at = np.flatnonzero((left >= 0) & (right >= 0) & ((left != right) | (inside[:-1] % 2 == 0)))
        symbols = TERMINALS + len(rules)
        pair = left[at] * symbols + right[at]
        found, n = np.unique(pair, return_counts=True)
        chosen, used = {}, set()
        for i in np.lexsort((found, -n)):
            if n[i] < 2:
                break
            a, b = divmod(int(found[i]), symbols)
            if a not in used and b not in used:
                used |= {a, b}
                chosen[int(found[i])] = TERMINALS + len(rules)
                rules.append((a, b))
        if not chosen:
            break
        taken = np.isin(pair, list(chosen))
        at, pair = at[taken], pair[taken]
        codes = np.array(sorted(chosen))
        flat[at] = np.array([chosen[c] for c in codes.tolist()])[np.searchsorted(codes, pair)]
        flat = np.delete(flat, at + 1)
    ends = np.flatnonzero(flat < 0)
    return rules, [flat[b:e].tolist() for b, e in zip(np.concatenate([[0], ends[:-1] + 1]), ends)]


class Programme:
    """The matrices of one grammar over all ``strings``, and each string's own result."""

    def __init__(self, strings: Sequence[bytes]):
        rules, self.rest = re_pair(strings)
        self.matrices = list(TERMINAL_MATRICES)
        for a, b in rules:
            self.matrices.append(times(self.matrices[a], self.matrices[b]))

    def product(self, index: int) -> list[Cell]:
        """The matrix of string ``index``: a balanced product, so its ropes stay flat."""
        level = [self.matrices[symbol] for symbol in self.rest[index]]
        while len(level) > 1:
            level = [times(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0] if level else ONE

    def row(self, index: int) -> Sequence[Cell]:
        """The cells of string ``index`` from the start state on."""
        if len(self.rest[index]) > SHORT:
            return row_times(BEGIN, self.product(index))
        vector = BEGIN
        for symbol in self.rest[index]:
            vector = row_times(vector, self.matrices[symbol])
        return vector


def cheapest(strings: Sequence[bytes]) -> list[tuple[int, str]]:
    """(cost, audit) of every string of terminals; equal strings are worked out once."""
    once = {s: i for i, s in enumerate(dict.fromkeys(strings))}
    shared = Programme(list(once))
    done = []
    for i in range(len(once)):
        cost, audit = finish(shared.row(i))
        done.append((cost, text(audit)))
    return [done[once[s]] for s in strings]


# --- applying an audit -------------------------------------------------------

def apply(audit: str, messages: Iterator[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired messages: ``audit`` from ``state`` on over the rows' messages."""
    for letter in audit:
        if letter == INSERT:
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        role, body = next(messages)
        if letter == KEEP:
            state = CLASSES[role[:1]] + 1
            yield role, body
        elif letter == REROLE:
            state = NEXT[state]
            yield ROLE[state], body


def state_behind(audit: str, kinds: Sequence[int], state: int = START) -> int:
    """The state behind a part of an audit over rows of these role classes."""
    row = 0
    for letter in audit:
        if letter in (INSERT, REROLE):
            state = NEXT[state]
        elif letter == KEEP:
            state = kinds[row] + 1
        row += letter != INSERT
    return state
