"""Regular expressions over bytes compiled to one minimal deterministic automaton.

The syntax is what secret rules need: literals, ``\\`` escapes (``\\xHH`` too), ``[classes]``,
groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``. A rule becomes a
non-deterministic automaton, all rules together become a deterministic one by subset
construction, and Moore's refinement merges its equivalent states.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Syntax:
    """A recursive-descent reader. Nodes: ("set", bytes), ("seq", [..]), ("alt", [..]), ("rep", node, m, n)."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def read(self):
        node = self._alternatives()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return node

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _alternatives(self):
        options = [self._sequence()]
        while self._peek() == "|":
            self._next()
            options.append(self._sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def _sequence(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated(self._single()))
        return ("seq", parts)

    def _single(self):
        c = self._next()
        if c == "(":
            node = self._alternatives()
            if self._next() != ")":
                raise ValueError("missing )")
            return node
        if c == "[":
            return ("set", self._class())
        return ("set", frozenset([self._byte(c)]))

    def _byte(self, c: str) -> int:
        if c == "\\":
            c = self._next()
            if c == "x":
                return int(self._next() + self._next(), 16)
        return ord(c)

    def _class(self) -> frozenset[int]:
        inside: set[int] = set()
        while (c := self._next()) != "]":
            low = high = self._byte(c)
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self._next()
                high = self._byte(self._next())
            inside.update(range(low, high + 1))
        return frozenset(inside)

    def _repeated(self, node):
        while (c := self._peek()) and c in "?*+{":
            self._next()
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, None)}[c]
            if c == "{":
                end = self.text.index("}", self.at)
                first, comma, second = self.text[self.at : end].partition(",")
                low, high = int(first), int(second) if second else (None if comma else int(first))
                self.at = end + 1
            node = ("rep", node, low, high)
        return node


def any_case(node):
    """The same pattern with letters in either case."""
    kind = node[0]
    if kind == "set":
        return ("set", frozenset(b for x in node[1] for b in (bytes([x]).lower()[0], bytes([x]).upper()[0])))
    if kind == "rep":
        return ("rep", any_case(node[1]), *node[2:])
    return (kind, [any_case(x) for x in node[1]])


class Graph:
    """A non-deterministic automaton: moves on byte sets, and empty moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, node, start: int, backwards: bool) -> int:
        """Append what ``node`` matches after ``start``; the state reached."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "seq":
            for part in reversed(node[1]) if backwards else node[1]:
                start = self.add(part, start, backwards)
            return start
        if kind == "alt":
            end = self.state()
            for option in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(option, first, backwards)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start, backwards)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop, backwards)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.add(inner, start, backwards)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Machine:
    """Transition array of a deterministic automaton.

    ``classes`` maps a byte to its column, ``table[state + column]`` is the next state (states
    are multiples of ``width``), ``accepts[state // width]`` has the numbers of the patterns
    that end there. Accepting states are those from ``accepting`` on. 0 is the state in which
    nothing can match, unless the machine searches; ``start`` is the first one.
    """

    classes: bytes
    table: list[int]
    accepts: list[tuple[int, ...]]
    accepting: int
    start: int
    width: int

    @property
    def states(self) -> int:
        return len(self.accepts)

    def rows(self) -> list:
        """The array as lists that hold the next state's list at each column; the first one.

        Every state is there twice: once an accepting state has been passed, the second of
        each pair is used. So ``reduce(getitem, columns, first)`` reads a text at the speed of
        C, and the last item of the list it ends in tells whether anything was accepted.
        """
        width = self.width
        plain: list[list] = [[] for _ in self.accepts]
        passed: list[list] = [[] for _ in self.accepts]
        for k in range(self.states):
            following = [t // width for t in self.table[k * width : (k + 1) * width]]
            plain[k] += [passed[t] if self.accepts[t] else plain[t] for t in following]
            passed[k] += [passed[t] for t in following]
            plain[k].append(False)
            passed[k].append(True)
        return plain[self.start // width]


def compile_patterns(nodes: list, *, search: bool, backwards: bool) -> Machine:
    """One machine for all patterns. ``search``: a match may begin anywhere; ``backwards``: it reads from the end."""
    graph = Graph()
    root = graph.state()
    ends: dict[int, int] = {}
    for k, node in enumerate(nodes):
        first = graph.state()
        graph.empty[root].append(first)
        ends[graph.add(node, first, backwards)] = k
    sets = sorted({s for moves in graph.moves for s, _ in moves}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in range(256)]
    columns = {sig: i for i, sig in enumerate(dict.fromkeys(signature))}
    member = {s: [i for sig, i in columns.items() if sig[j]] for j, s in enumerate(sets)}

    initial = graph.closure([root])
    known = {frozenset(): 0, initial: 1}
    todo, rows, accepts = [frozenset(), initial], [], []
    for states in todo:
        accepts.append(tuple(sorted({ends[s] for s in states if s in ends})))
        targets: list[set[int]] = [set() for _ in columns]
        for s in states:
            for byte_set, t in graph.moves[s]:
                for i in member[byte_set]:
                    targets[i].add(t)
        row = []
        for target in targets:
            reached = graph.closure(target)
            if search:
                reached |= initial
            if reached not in known:
                known[reached] = len(known)
                todo.append(reached)
            row.append(known[reached])
        rows.append(row)
    return _minimal(np.array(rows), accepts, bytes(columns[s] for s in signature))


def _minimal(rows: np.ndarray, accepts: list[tuple[int, ...]], classes: bytes) -> Machine:
    kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    block = np.array([kinds[a] for a in accepts])
    while True:
        _, refined = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)
        refined = refined.reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    # One state for each block: those that accept last, the dead state first.
    first = {}
    for state, b in enumerate(block.tolist()):
        first.setdefault(b, state)
    order = sorted(first, key=lambda b: (bool(accepts[first[b]]), first[b]))
    place = {b: i for i, b in enumerate(order)}
    width = rows.shape[1]
    table = [place[b] * width for old in order for b in block[rows[first[old]]].tolist()]
    kept = [accepts[first[b]] for b in order]
    return Machine(classes, table, kept, sum(not a for a in kept) * width, place[block[1]] * width, width)
