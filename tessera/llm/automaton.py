"""Regular expressions of several rules as one deterministic byte automaton.

Each rule becomes a nondeterministic automaton and, by subset construction, a
deterministic one that searches for its leftmost longest matches one after the
other: a state holds sets of NFA states, the set of the earliest start first.
The product of all rules is minimised and laid out as one transition array; an
edge on which a match ends (the byte after it) is marked and names its rules.
A second, reversed automaton per rule walks back from an end to the start.

One pass without going back is possible if a match that has been accepted is
either extended by the next byte or over, and if no later start is accepted
while an earlier one is open. ``compiled`` checks this and refuses other rules.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Byte that stands behind a text; no UTF-8 text holds it and no rule matches it.
END = 0xFF
_ANY = frozenset(range(END))


@dataclass(frozen=True)
class Rule:
    """Matches of ``keep`` count if they have ``least`` bytes; those of
    ``drop`` and shorter ones do not, but what they cover is used up."""
    kind: str
    keep: str
    drop: str | None = None
    least: int = 0


class _Parser:
    """Literals, ``\\xHH`` and escaped marks, classes, groups, ``(?i:...)``,
    ``|``, ``?``, ``*``, ``+`` and ``{m,n}``, to nested tuples."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def more(self) -> bool:
        return self.i < len(self.p)

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def accept(self, mark: str) -> bool:
        if self.p.startswith(mark, self.i):
            self.i += len(mark)
            return True
        return False

    def branches(self, fold: bool):
        out = [self.sequence(fold)]
        while self.accept("|"):
            out.append(self.sequence(fold))
        return ("or", out)

    def sequence(self, fold: bool):
        out = []
        while self.more() and self.p[self.i] not in "|)":
            out.append(self.repeated(self.atom(fold)))
        return ("seq", out)

    def repeated(self, node):
        if self.accept("?"):
            return ("times", node, 0, 1)
        if self.accept("*"):
            return ("times", node, 0, None)
        if self.accept("+"):
            return ("times", node, 1, None)
        if self.accept("{"):
            end = self.p.index("}", self.i)
            low, comma, high = self.p[self.i:end].partition(",")
            self.i = end + 1
            return ("times", node, int(low), int(high) if high else None if comma else int(low))
        return node

    def char(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2:self.i], 16)
        return ord(c)

    def atom(self, fold: bool):
        if self.accept("("):
            node = self.branches(True if self.accept("?i:") else fold)
            if not self.accept(")"):
                raise ValueError(f"unclosed group in {self.p}")
            return node
        if self.accept("["):
            negated, out = self.accept("^"), set()
            while not self.accept("]"):
                low = high = self.char()
                if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    high = self.char()
                out |= set(range(low, high + 1))
            return ("set", _ANY - out if negated else frozenset(out))
        c = chr(self.char())
        return ("set", frozenset({ord(c.lower()), ord(c.upper())} if fold and c.isalpha() else {ord(c)}))


class _Nfa:
    """States with empty moves and moves on byte sets; final states keep and drop."""

    def __init__(self, rule: Rule):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.start = self.state()
        self.keep = self.add(_Parser(rule.keep).branches(False), self.start)
        self.drop = -1 if rule.drop is None else self.add(_Parser(rule.drop).branches(False), self.start)

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, at: int) -> int:
        """Append ``node`` behind state ``at``; the state behind it."""
        kind, what = node[0], node[1]
        if kind == "set":
            end = self.state()
            self.moves[at].append((what, end))
            return end
        if kind == "seq":
            for part in what:
                at = self.add(part, at)
            return at
        end = self.state()
        if kind == "or":
            for part in what:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        low, high = node[2], node[3]
        for _ in range(low):
            at = self.add(what, at)
        if high is None:
            loop = self.state()
            self.empty[at].append(loop)
            self.empty[self.add(what, loop)].append(loop)
            at = loop
        else:
            for _ in range(high - low):
                self.empty[at].append(end)
                at = self.add(what, at)
        self.empty[at].append(end)
        return end

    def reversed_moves(self):
        empty = [[] for _ in self.empty]
        moves = [[] for _ in self.moves]
        for s, targets in enumerate(self.empty):
            for t in targets:
                empty[t].append(s)
        for s, pairs in enumerate(self.moves):
            for chars, t in pairs:
                moves[t].append((chars, s))
        return empty, moves


def _closure(states, empty) -> frozenset:
    out, todo = set(states), list(states)
    while todo:
        for t in empty[todo.pop()]:
            if t not in out:
                out.add(t)
                todo.append(t)
    return frozenset(out)


def _after(states, byte: int, moves, empty) -> frozenset:
    return _closure({t for s in states for chars, t in moves[s] if byte in chars}, empty)


class _Search:
    """The deterministic search of one rule, by subset construction."""

    def __init__(self, rule: Rule, classes: list[int]):
        nfa = _Nfa(rule)
        begin = _closure([nfa.start], nfa.empty)
        finals = {nfa.keep, nfa.drop}
        if begin & finals:
            raise ValueError(f"{rule.kind} matches the empty text")

        def step(groups: tuple, byte: int):
            accepted = bool(groups) and bool(groups[0] & finals)
            new, seen = [], set()
            for g in groups if accepted else (*groups, begin):
                t = _after(g, byte, nfa.moves, nfa.empty) - seen
                if t:
                    new.append(frozenset(t))
                    seen |= t
                    if t & finals:
                        break
            if accepted and not new:  # over; the byte belongs to a new search
                return step((), byte)[0], 1 + (nfa.keep in groups[0])
            if (accepted and not new[0] & finals) or any(g & finals for g in new[1:]):
                raise ValueError(f"{rule.kind} cannot be scanned in one pass")
            return tuple(new), 0

        known, self.next, self.ended = {(): 0}, [], []
        todo = [()]
        while todo:
            batch, todo = todo, []
            for groups in batch:
                row, over = [], []
                for byte in classes:
                    target, end = step(groups, byte)
                    if target not in known:
                        known[target] = len(known)
                        todo.append(target)
                    row.append(known[target])
                    over.append(end)
                self.next.append(row)
                self.ended.append(over)


def _minimised(nxt: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge states that no input tells apart: split by outputs, then by the
    parts of their targets until nothing splits. (part of each state, arrays)"""
    part = np.unique(out, axis=0, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([part, part[nxt]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    first = np.unique(part, return_index=True)[1]
    return part, part[nxt[first]], out[first]


@dataclass
class Automaton:
    """``table[state + byte]`` is the next state (states are multiples of 256),
    or its complement where matches end: ``names[ends[state + byte]]`` has them
    as (rule, kept). ``back[rule]`` is (table, accepting) of the reversed rule."""
    rules: tuple[Rule, ...]
    start: int
    table: np.ndarray
    ends: np.ndarray
    names: list[tuple[tuple[int, bool], ...]]
    back: list[tuple[np.ndarray, list[bool]]]


def _backward(rule: Rule, of_byte: np.ndarray, classes: list[int]) -> tuple[np.ndarray, list[bool]]:
    nfa = _Nfa(rule)
    empty, moves = nfa.reversed_moves()
    begin = _closure([s for s in (nfa.keep, nfa.drop) if s >= 0], empty)
    known, order, rows = {begin: 0}, [begin], []
    while len(rows) < len(order):
        row = []
        for byte in classes:
            t = _after(order[len(rows)], byte, moves, empty)
            if t and t not in known:
                known[t] = len(order)
                order.append(t)
            row.append(known[t] * 256 if t else -1)
        rows.append(row)
    return np.array(rows, dtype=np.int64)[:, of_byte].reshape(-1), [nfa.start in s for s in order]


def compiled(rules) -> Automaton:
    """All rules in one automaton."""
    rules = tuple(rules)
    sets = {chars for r in rules for pairs in _Nfa(r).moves for chars, _ in pairs}
    kinds: dict[tuple, int] = {}
    of_byte = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
    classes = [int(np.flatnonzero(of_byte == k)[0]) for k in range(len(kinds))]
    searches = [_Search(r, classes) for r in rules]
    known, order, nxt, out = {(0,) * len(rules): 0}, [(0,) * len(rules)], [], []
    outputs: dict[tuple, int] = {(): 0}
    while len(nxt) < len(order):
        state = order[len(nxt)]
        row, marks = [], []
        for c in range(len(classes)):
            target = tuple(s.next[x][c] for s, x in zip(searches, state))
            if target not in known:
                known[target] = len(order)
                order.append(target)
            row.append(known[target])
            over = tuple((r, s.ended[x][c] == 2) for r, (s, x) in enumerate(zip(searches, state)) if s.ended[x][c])
            marks.append(outputs.setdefault(over, len(outputs)))
        nxt.append(row)
        out.append(marks)
    part, nxt, out = _minimised(np.array(nxt), np.array(out))
    table = nxt[:, of_byte].astype(np.int32) * 256
    marked = out[:, of_byte].astype(np.int16)
    return Automaton(rules, int(part[0]) * 256, np.where(marked > 0, ~table, table).reshape(-1), marked.reshape(-1), list(outputs),
                     [_backward(r, of_byte, classes) for r in rules])


def _rows(table: np.ndarray) -> list[list]:
    """The array as one list for each state, whose entries are the next states'
    lists (no arithmetic in the loop over bytes); None where the entry is
    negative, and the state's number at the end."""
    rows: list[list] = [[] for _ in range(len(table) // 256)]
    for number, (row, targets) in enumerate(zip(rows, (table.reshape(-1, 256) >> 8).tolist())):
        row += [None if t < 0 else rows[t] for t in targets]
        row.append(number)
    return rows


class Scanner:
    """An automaton laid out for the loop over bytes."""

    def __init__(self, a: Automaton):
        self.automaton, self.rules = a, a.rules
        self.rows = _rows(a.table)
        self.back = [(_rows(t), accepting) for t, accepting in a.back]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) of all kept matches in bytes, by start, then rule."""
        rows, table, marks = self.rows, self.automaton.table, self.automaton.ends
        row, over = rows[self.automaton.start >> 8], []
        for i, b in enumerate(data + bytes([END])):
            after = row[b]
            if after is None:
                edge = row[256] * 256 + b
                over.append((i, marks[edge]))
                after = rows[~table[edge] >> 8]
            row = after
        out, low = [], [0] * len(self.rules)
        for end, mark in over:
            for rule, kept in self.automaton.names[mark]:
                if kept:
                    start = self._start(rule, data, low[rule], end)
                    if end - start >= self.rules[rule].least:
                        out.append((start, end, rule))
                low[rule] = end
        return sorted(out, key=lambda x: (x[0], x[2]))

    def _start(self, rule: int, data: bytes, low: int, end: int) -> int:
        """The earliest start, not before ``low``, of a match that ends there."""
        rows, accepting = self.back[rule]
        row, start = rows[0], end
        for i in range(end - 1, low - 1, -1):
            row = row[data[i]]
            if row is None:
                break
            if accepting[row[256]]:
                start = i
        return start
