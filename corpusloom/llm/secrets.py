"""Secrets in texts, found by one pass of a combined automaton over the bytes.

The regular expression of each rule becomes a deterministic automaton by subset
construction over classes of bytes that it does not tell apart, and minimisation. By the
same two steps all of them become one, which starts every rule anew at every byte. Its
transition array has one row per state and one column per byte; a scan takes one step per
byte, whatever the number of rules. Where a rule first accepts, two small automata of that
rule settle the span: one over the reversed rule finds the start, one over the rule the end.

A rule is a regular expression of literals, classes, groups, alternatives and repeats.
Matches of a rule are leftmost, longest and non-overlapping. That needs rules where of
two overlapping matches the one that starts first can be recognised no later than the
other; all rules here are of that kind.

Defined cases: a NULL or empty text has no span, every input row gives one output row
(also rows of equal key), and columns besides key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCEPT = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` as in ``re``; a match whose ``group`` has fewer than ``least`` bytes is dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base rules, and public formats of service credentials.
_VALUE = "[A-Za-z0-9+/_.=-]+"
_NAME = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
BASE_RULES = (
    Rule("assign", rf"({_NAME})[\"']?\x20*[:=]\x20*[\"']?({_VALUE})", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class _Nfa:
    """States with byte sets as bit masks. A fragment is (first state, last state)."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def chain(self, parts: Sequence[tuple[int, int]]) -> tuple[int, int]:
        if not parts:
            s = self.state()
            return s, s
        for (_, end), (start, _) in zip(parts, parts[1:], strict=False):
            self.free[end].append(start)
        return parts[0][0], parts[-1][1]

    def on(self, mask: int) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.moves[a].append((mask, b))
        return a, b

    def either(self, parts: Sequence[tuple[int, int]]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        for start, end in parts:
            self.free[a].append(start)
            self.free[end].append(b)
        return a, b

    def loop(self, part: tuple[int, int]) -> tuple[int, int]:
        """No, one or several times."""
        s = self.state()
        self.free[s].append(part[0])
        self.free[part[1]].append(s)
        return s, s

    def build(self, items, backwards: bool) -> tuple[int, int]:
        parts = [self._item(kind, value, backwards) for kind, value in items]
        return self.chain(parts[::-1] if backwards else parts)

    def _item(self, kind, value, backwards: bool) -> tuple[int, int]:
        if kind is op.LITERAL:
            return self.on(1 << value)
        if kind is op.IN:
            return self.on(_class(value))
        if kind is op.SUBPATTERN:
            return self.build(value[-1], backwards)
        if kind is op.BRANCH:
            return self.either([self.build(branch, backwards) for branch in value[1]])
        if kind is op.MAX_REPEAT:
            least, most, items = value
            parts = [self.build(items, backwards) for _ in range(least)]
            if most is op.MAXREPEAT:
                parts.append(self.loop(self.build(items, backwards)))
            else:
                parts += [self.either([self.build(items, backwards), self.chain([])]) for _ in range(most - least)]
            return self.chain(parts)
        raise ValueError(f"not supported in a rule: {kind}")

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def _class(items) -> int:
    mask = 0
    for kind, value in items:
        if kind is op.LITERAL:
            mask |= 1 << value
        elif kind is op.RANGE:
            mask |= (1 << value[1] + 1) - (1 << value[0])
        elif kind is not op.NEGATE:
            raise ValueError(f"not supported in a class: {kind}")
    return mask ^ (1 << 256) - 1 if items[0][0] is op.NEGATE else mask


def _determinise(start: frozenset, step, accepts, of_byte: np.ndarray) -> np.ndarray:
    """Subset construction: ``step(set, byte)`` is the next set, ``accepts(set)`` its accept bits."""
    one_byte = [int(np.flatnonzero(of_byte == k)[0]) for k in range(of_byte.max() + 1)]
    number, todo, table, accept = {start: 0}, [start], [], []
    for current in todo:
        row = []
        for byte in one_byte:
            goal = step(current, byte)
            if goal not in number:
                number[goal] = len(number)
                todo.append(goal)
            row.append(number[goal])
        table.append(row)
        accept.append(accepts(current))
    return _minimal(np.array(table), np.array(accept))[:, [*of_byte, -1]]


def _byte_kinds(signature: np.ndarray) -> np.ndarray:
    """Number bytes so that those with equal rows of ``signature`` share a number."""
    return np.unique(signature, axis=0, return_inverse=True)[1].ravel()


def compile_rule(pattern: str, *, backwards: bool = False) -> np.ndarray:
    """Transition array of the minimal automaton of one rule, row 0 the start.

    Matches begin at the first byte; column ``ACCEPT`` is 1 where one ends.
    """
    nfa = _Nfa()
    start, end = nfa.build(_parser.parse(pattern), backwards)
    masks = sorted({mask for moves in nfa.moves for mask, _ in moves})
    kinds = _byte_kinds(np.array([[m >> b & 1 for m in masks] for b in range(256)]))

    def step(states: frozenset, byte: int) -> frozenset:
        return nfa.closure([t for s in states for mask, t in nfa.moves[s] if mask >> byte & 1])

    return _determinise(nfa.closure([start]), step, lambda states: int(end in states), kinds)


def combine(tables: Sequence[np.ndarray]) -> np.ndarray:
    """One automaton that runs all rules from every byte and tells where each first accepts.

    Column ``ACCEPT`` has a bit per rule. A run of a rule ends where it accepts, so that
    long matches keep no states alive.
    """
    kinds = _byte_kinds(np.column_stack([t[:, :ACCEPT].T for t in tables]))
    dead = [{s for s in range(len(t)) if not t[s, ACCEPT] and (t[s, :ACCEPT] == s).all()} for t in tables]
    begin = [(k, 0) for k in range(len(tables))]

    def step(states: frozenset, byte: int) -> frozenset:
        goals = ((k, int(tables[k][s, byte])) for k, s in (*states, *begin) if not tables[k][s, ACCEPT])
        return frozenset((k, s) for k, s in goals if s not in dead[k])

    def accepts(states: frozenset) -> int:
        return sum({1 << k for k, s in states if tables[k][s, ACCEPT]})

    return _determinise(frozenset(), step, accepts, kinds)


def _minimal(table: np.ndarray, accept: np.ndarray) -> np.ndarray:
    """Merge states until all that are left differ in what they accept later; last column: accept."""
    _, group = np.unique(accept, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(group, return_index=True)[1]
    order = np.argsort(first)  # the group of the start state is the first one
    name = np.empty(len(order), int)
    name[order] = np.arange(len(order))
    kept = first[order]
    return np.column_stack([name[group[table[kept]]], accept[kept]])


def _rows(table: np.ndarray) -> list[list]:
    """The transition array as lists that hold the next list, so that a step is one index."""
    rows = [row.tolist() for row in table]
    for row in rows:
        row[:ACCEPT] = [rows[i] for i in row[:ACCEPT]]
    return rows


class Scanner:
    """The compiled rules. Arrays go to the executors; lists are made from them once per worker."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        self.forward = [compile_rule(r.pattern) for r in rules]
        self.backward = [compile_rule(r.pattern, backwards=True) for r in rules]
        self.combined = combine(self.forward)
        self._lists = None

    def __getstate__(self):
        return self.__dict__ | {"_lists": None}

    def _ready(self):
        if self._lists is None:
            self._lists = (
                _rows(self.combined)[0],
                [_rows(t)[0] for t in self.forward],
                [_rows(t)[0] for t in self.backward],
                [re.compile(r.pattern.encode()) for r in self.rules],
            )
        return self._lists

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, sorted."""
        row, forward, backward, exact = self._ready()
        found = []
        after = [0] * len(self.rules)
        for i, byte in enumerate(data):
            row = row[byte]
            if row[ACCEPT]:
                for k, rule in enumerate(self.rules):
                    if row[ACCEPT] >> k & 1 and i >= after[k]:
                        size = _longest(backward[k], data[after[k] : i + 1][::-1])
                        if size:
                            start = i + 1 - size
                            after[k] = start + _longest(forward[k], data[start:])
                            match = exact[k].fullmatch(data, start, after[k])
                            if len(match.group(rule.group)) >= rule.least:
                                found.append((start, k, after[k]))
        return sorted(found)

    def spans_of_text(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and then by the order of the rules."""
        data = (text or "").encode()
        spans = self.spans(data)
        if spans and len(data) != len(text):
            spans = [(len(data[:a].decode()), k, len(data[:b].decode())) for a, k, b in spans]
        return [(self.rules[k].kind, a, b) for a, k, b in spans]


def _longest(row: list, data: bytes) -> int:
    """Length of the longest match that begins at the first byte."""
    size, start = 0, row
    for i, byte in enumerate(data, 1):
        row = row[byte]
        if row[ACCEPT]:
            size = i
        elif row[byte] is row and row is not start and all(x is row for x in row[:ACCEPT]):
            break
    return size


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = BASE_RULES + MORE_RULES,
    *,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Key and spans of every row. No shuffle; the automata are a bounded constant of the plan."""
    scanner = Scanner(rules)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans_of_text(t.as_py())]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN)], ["key", "spans"])

    return narrow.mapInArrow(run, f"key {narrow.schema['key'].dataType.simpleString()}, spans {SPANS}")
