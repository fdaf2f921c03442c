"""Regular expressions to one minimal deterministic automaton, and scanning bytes with it.

The syntax is what scan rules need: literals, escapes, classes, groups, alternation and the repeats
? * + {n} {n,} {n,m}. Rules share one automaton, whose states say which rules end at a byte; read backwards, the
automaton of the reversed rules says which rules start at a byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np


class _Parser:
    """A rule's syntax tree as nested tuples: ("set", bytes), ("cat", ...), ("or", ...), ("rep", x, low, high)."""

    def __init__(self, pattern: str, fold: bool):
        self.p, self.i, self.fold = pattern, 0, fold

    def parse(self):
        tree = self.either()
        if self.i != len(self.p):
            raise ValueError(f"cannot read {self.p!r} at {self.i}")
        return tree

    def peek(self) -> str:
        return self.p[self.i : self.i + 1]

    def either(self):
        parts = [self.row()]
        while self.peek() == "|":
            self.i += 1
            parts.append(self.row())
        return parts[0] if len(parts) == 1 else ("or", *parts)

    def row(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("cat", *parts)

    def repeated(self, x):
        while self.peek() and self.peek() in "?*+{":
            c = self.peek()
            if c == "{":
                m = re.compile(r"\{(\d+)(,?)(\d*)\}").match(self.p, self.i)
                if not m:
                    raise ValueError(f"bad repeat in {self.p!r}")
                self.i = m.end()
                low = int(m[1])
                x = ("rep", x, low, int(m[3]) if m[3] else (None if m[2] else low))
            else:
                self.i += 1
                x = ("rep", x, {"?": 0, "*": 0, "+": 1}[c], {"?": 1, "*": None, "+": None}[c])
        return x

    def atom(self):
        c = self.peek()
        self.i += 1
        if c == "(":
            if self.p.startswith("?:", self.i):
                self.i += 2
            x = self.either()
            self.i += 1
            return x
        if c == "[":
            return ("set", self.folded(self.members()))
        if c == "\\":
            return ("set", self.folded({self.escape()}))
        return ("set", self.folded({ord(c)}))

    def escape(self) -> int:
        c = self.peek()
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def members(self) -> set[int]:
        out: set[int] = set()
        while self.peek() != "]":
            c = self.peek()
            self.i += 1
            low = self.escape() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                c = self.peek()
                self.i += 1
                out |= set(range(low, (self.escape() if c == "\\" else ord(c)) + 1))
            else:
                out.add(low)
        self.i += 1
        return out

    def folded(self, x: set[int]) -> frozenset[int]:
        if self.fold:
            x = x | {b ^ 32 for b in x if chr(b).isalpha() and b < 128}
        return frozenset(x)


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append(None)
        return len(self.free) - 1

    def add(self, tree, at: int) -> int:
        """Append tree after state at; the state where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            if self.moves[at] is not None:
                fresh = self.state()
                self.free[at].append(fresh)
                at = fresh
            self.moves[at] = (tree[1], end)
            return end
        if kind == "cat":
            for x in tree[1:]:
                at = self.add(x, at)
            return at
        if kind == "or":
            end = self.state()
            for x in tree[1:]:
                start = self.state()
                self.free[at].append(start)
                self.free[self.add(x, start)].append(end)
            return end
        _, x, low, high = tree
        for _ in range(low):
            at = self.add(x, at)
        if high is None:
            loop, end = self.state(), self.state()
            self.free[at].append(loop)
            self.free[self.add(x, loop)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        for _ in range(high - low):
            self.free[at].append(end)
            start = self.state()
            self.free[at].append(start)
            at = self.add(x, start)
        self.free[at].append(end)
        return end


def _reversed(tree):
    if tree[0] == "cat":
        return ("cat", *(_reversed(x) for x in tree[:0:-1]))
    if tree[0] == "or":
        return ("or", *(_reversed(x) for x in tree[1:]))
    if tree[0] == "rep":
        return ("rep", _reversed(tree[1]), *tree[2:])
    return tree


class Automaton:
    """next: (states, 256) transitions from state 0; ends: for each state, a bit for each rule that may end there.

    Rules start anywhere, or with anchored at the first byte only; backward automata read rules from their ends.
    """

    #: Lanes below which bytes are read one by one instead of a byte of every lane at once.
    FEW_LANES = 12

    def __init__(self, rules: Iterable[tuple[str, bool]], anchored: bool = False, backward: bool = False):
        nfa = _Nfa()
        start = nfa.state()
        goals: dict[int, int] = {}
        for k, (pattern, fold) in enumerate(rules):
            own = nfa.state()
            nfa.free[start].append(own)
            tree = _Parser(pattern, fold).parse()
            end = nfa.add(_reversed(tree) if backward else tree, own)
            goals[end] = goals.get(end, 0) | 1 << k
        self.next, self.ends = self._minimal(*self._subsets(nfa, start, goals, anchored))
        #: Bytes after which the state is the same wherever it was.
        self.resets = (self.next == self.next[0]).all(0)
        self.flat = np.ascontiguousarray(self.next.reshape(-1))
        self.rows, self.marks = self.next.tolist(), self.ends.tolist()
        #: States that no rule is in the middle of or can end after, for anchored automata.
        self.dead = [not e and all(y == x for y in row) for x, (row, e) in enumerate(zip(self.rows, self.marks))]

    @staticmethod
    def _subsets(nfa: _Nfa, start: int, goals: dict[int, int], anchored: bool):
        def closed(states) -> frozenset[int]:
            todo, seen = list(states), set(states)
            while todo:
                for y in nfa.free[todo.pop()]:
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            return frozenset(x for x in seen if nfa.moves[x] is not None or x in goals)

        sets = sorted({m[0] for m in nfa.moves if m is not None}, key=sorted)
        kinds: dict[tuple, int] = {}  # bytes that no set tells apart
        kind = np.array([kinds.setdefault(tuple(b in x for x in sets), len(kinds)) for b in range(256)])
        of_set = {x: sorted({int(kind[b]) for b in x}) for x in sets}
        first = closed([start])
        restart = frozenset() if anchored else first  # a rule may start at every byte
        number, todo, rows, ends = {first: 0}, [first], [], []
        while todo:
            now = todo.pop(0)
            ends.append(sum({goals[x] for x in now if x in goals}))
            to: list[set[int]] = [set() for _ in kinds]
            for x in now:
                if nfa.moves[x] is not None:
                    for k in of_set[nfa.moves[x][0]]:
                        to[k].add(nfa.moves[x][1])
            row = np.zeros(len(kinds), np.int32)
            for k, states in enumerate(to):
                after = closed(states) | restart
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                    if len(number) > 30_000:
                        raise ValueError("the rules need too many states")
                row[k] = number[after]
            rows.append(row)
        return np.array(rows)[:, kind], np.array(ends, np.int64)

    @staticmethod
    def _minimal(moves: np.ndarray, ends: np.ndarray):
        """Merge states that no input tells apart: refine classes until they are stable."""
        kind = np.unique(ends, return_inverse=True)[1]
        count = kind.max() + 1
        while True:
            table = np.column_stack([kind, kind[moves]])
            kind = np.unique(table, axis=0, return_inverse=True)[1].reshape(-1)
            if kind.max() + 1 == count:
                break
            count = kind.max() + 1
        order = np.full(count, -1)
        order[kind[0]] = 0
        order[order < 0] = np.arange(1, count)
        kind = order[kind]
        first = np.zeros(count, np.int64)
        first[kind[::-1]] = np.arange(len(kind))[::-1]
        return kind[moves[first]].astype(np.int32), ends[first]

    def chunks_with_hits(self, data: np.ndarray, offsets: np.ndarray, length: int = 384) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the chunks of data in which a rule may end.

        Chunks begin at a text or after a byte that resets the automaton, so all of them run at once,
        each from the start state, and no byte is looked at twice; what few very long chunks have left goes byte by byte.
        """
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        after = np.flatnonzero(self.resets[data]) + 1
        wanted = np.arange(length, n, length)
        at = np.searchsorted(after, wanted)
        cuts = np.unique(np.concatenate([offsets[:-1], after[at[at < len(after)]]]))
        cuts = cuts[cuts < n]
        sizes = np.diff(np.append(cuts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = cuts[order], sizes[order]
        state = np.zeros(len(starts), np.int32)
        hit = np.zeros(len(starts), bool)
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
        ends = self.ends != 0
        for t in range(int(sizes[0])):
            a = active[t]
            if a < self.FEW_LANES:
                for i in range(a):
                    hit[i] = hit[i] or self._ends_in(data[starts[i] + t : starts[i] + sizes[i]].tobytes(), int(state[i]))
                break
            now = self.flat[state[:a] * 256 + data[starts[:a] + t]]
            state[:a] = now
            hit[:a] |= ends[now]
        return starts[hit], starts[hit] + sizes[hit]

    def _ends_in(self, data: bytes, state: int) -> bool:
        rows, marks = self.rows, self.marks
        for b in data:
            state = rows[state][b]
            if marks[state]:
                return True
        return False

    def starts(self, data: bytes) -> list[tuple[int, int]]:
        """(place, bits of the rules that start there), last places first; for backward automata."""
        rows, marks, state, out, at = self.rows, self.marks, 0, [], len(data)
        for b in data[::-1]:
            at -= 1
            state = rows[state][b]
            if marks[state]:
                out.append((at, marks[state]))
        return out

    def longest(self, data: bytes, at: int, stop: int | None = None) -> int:
        """Where the longest match that begins at a place ends, at stop the latest; -1 without one. For anchored automata of one rule."""
        rows, marks, dead, state, end = self.rows, self.marks, self.dead, 0, -1
        if marks[0]:
            end = at
        for b in data[at:stop] if stop is not None else memoryview(data)[at:]:
            state = rows[state][b]
            at += 1
            if marks[state]:
                end = at
            elif dead[state]:
                break
        return end
