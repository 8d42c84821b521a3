"""Regular expressions over bytes, compiled to one deterministic automaton.

A pattern is parsed to a tree, turned into a non-deterministic automaton, and
made deterministic by subset construction. ``combine`` runs the automata of many
rules side by side as one, minimises the product by partition refinement and
lays it out as a transition array of states by classes of bytes.

Supported syntax: literals, ``\\xHH`` and escaped literals, classes with ranges,
groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``, and ``(?i:...)`` for ASCII letters
in either case. All matching is greedy, and a rule's matches never overlap.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Trees: ("set", frozenset of bytes), ("cat", [..]), ("alt", [..]), ("rep", tree, least, most or None)


class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self, n: int = 1) -> str:
        out = self.text[self.at : self.at + n]
        self.at += n
        return out

    def parse(self):
        tree = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.peek()!r} at {self.at} of {self.text!r}")
        return tree

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        tree = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                bounds = ""
                while (d := self.take()) != "}":
                    bounds += d
                low, _, high = bounds.partition(",")
                tree = ("rep", tree, int(low), int(high) if high else None if "," in bounds else int(low))
            else:
                tree = ("rep", tree, int(c == "+"), 1 if c == "?" else None)
        return tree

    def atom(self):
        c = self.take()
        if c == "(":
            before = self.fold
            if self.text.startswith("?i:", self.at):
                self.take(3)
                self.fold = True
            elif self.text.startswith("?:", self.at):
                self.take(2)
            tree = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.fold = before
            return tree
        if c == "[":
            members: set[int] = set()
            while self.peek() != "]":
                low = self.byte(self.take())
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    members.update(range(low, self.byte(self.take()) + 1))
                else:
                    members.add(low)
            self.take()
            return self.set_of(members)
        return self.set_of({self.byte(c)})

    def byte(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            return int(self.take(2), 16) if c == "x" else ord(c)
        return ord(c)

    def set_of(self, members: set[int]):
        if self.fold:
            members = members | {ord(chr(b).swapcase()) for b in members if chr(b).isascii() and chr(b).isalpha()}
        return ("set", frozenset(members))


def parse(pattern: str):
    return _Parser(pattern).parse()


def backwards(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [backwards(t) for t in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [backwards(t) for t in tree[1]])
    if kind == "rep":
        return ("rep", backwards(tree[1]), *tree[2:])
    return tree


class _Nfa:
    """Thompson's construction: edges by state, on a set of bytes or, for None, on nothing."""

    def __init__(self, tree):
        self.edges: list[list[tuple[frozenset | None, int]]] = []
        self.start = self.state()
        self.end = self.build(tree, self.start)

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def build(self, tree, at: int) -> int:
        kind = tree[0]
        if kind == "set":
            to = self.state()
            self.edges[at].append((tree[1], to))
            return to
        if kind == "cat":
            for part in tree[1]:
                at = self.build(part, at)
            return at
        if kind == "alt":
            to = self.state()
            for option in tree[1]:
                begin = self.state()
                self.edges[at].append((None, begin))
                self.edges[self.build(option, begin)].append((None, to))
            return to
        _, part, least, most = tree
        for _ in range(least):
            at = self.build(part, at)
        if most is None:
            loop, to = self.state(), self.state()
            self.edges[at].append((None, loop))
            self.edges[self.build(part, loop)].append((None, loop))
            self.edges[loop].append((None, to))
            return to
        to = self.state()
        self.edges[at].append((None, to))
        for _ in range(most - least):
            at = self.build(part, at)
            self.edges[at].append((None, to))
        return to

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for over, to in self.edges[todo.pop()]:
                if over is None and to not in found:
                    found.add(to)
                    todo.append(to)
        return frozenset(found)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.closure({to for s in states for over, to in self.edges[s] if over is not None and byte in over})


def byte_classes(trees) -> np.ndarray:
    """Number of the class of each byte: bytes that lie in the same sets of all trees are alike."""
    sets: set[frozenset] = set()

    def visit(tree) -> None:
        if tree[0] == "set":
            sets.add(tree[1])
        else:
            for part in tree[1] if tree[0] in ("cat", "alt") else tree[1:2]:
                visit(part)

    for tree in trees:
        visit(tree)
    kinds = np.array([[b in s for s in sets] for b in range(256)])
    return np.unique(kinds, axis=0, return_inverse=True)[1].ravel().astype(np.uint8)


@dataclass(frozen=True)
class Dfa:
    """next[state, class of byte] and, by state, a bit mask of the rules of which a match ends here. State 0 is the start."""

    next: np.ndarray
    accepts: np.ndarray


def determinise(tree, search: bool, classes: np.ndarray) -> Dfa:
    """Subset construction.

    With ``search`` a match may begin at any byte, and while a rule's match goes
    on, no later one of that rule is begun; else matching begins at the first
    byte and state 1 is the dead one.
    """
    nfa = _Nfa(tree)
    start = nfa.closure({nfa.start})
    names = {start: 0} if search else {start: 0, frozenset(): 1}
    order, rows = list(names), []
    examples = np.unique(classes, return_index=True)[1].tolist()
    for states in order:
        row = np.zeros(len(examples), np.int32)
        for kind, byte in enumerate(examples):
            to = nfa.step(states, byte)
            if search:
                going_on = nfa.end in states and nfa.end in to
                if nfa.end in states and not going_on:
                    to = nfa.step(start, byte)
                if not going_on:
                    to = to | start
                if nfa.end in to:
                    to = to - start if not going_on else to
            if to not in names:
                names[to] = len(names)
                order.append(to)
            row[kind] = names[to]
        rows.append(row)
    return Dfa(np.array(rows), np.array([int(nfa.end in s) for s in order], np.int64))


def minimise(dfa: Dfa) -> Dfa:
    """Merge states that accept alike and go on alike (partition refinement), numbering them anew."""
    _, block = np.unique(dfa.accepts, return_inverse=True)
    while True:
        kinds = np.column_stack([block, block[dfa.next]])
        _, refined = np.unique(kinds, axis=0, return_inverse=True)
        refined = refined.ravel()
        if refined.max() == block.max():
            break
        block = refined
    # Accepting blocks last, so that one comparison tells them; the start first.
    first = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    rank = sorted(range(len(first)), key=lambda b: (dfa.accepts[first[b]] != 0, b != block[0], first[b]))
    number = np.empty(len(first), np.int32)
    number[rank] = np.arange(len(first))
    return Dfa(number[block[dfa.next[first[rank]]]], dfa.accepts[first[rank]])


def combine(trees, classes: np.ndarray) -> Dfa:
    """All rules as one searching automaton; bit k of accepts is rule k."""
    parts = [minimise(determinise(t, True, classes)) for t in trees]
    names = {(0,) * len(parts): 0}
    order, rows = list(names), []
    for states in order:
        outs = np.stack([p.next[s] for p, s in zip(parts, states)], axis=1)
        row = np.empty(len(outs), np.int32)
        for kind, to in enumerate(map(tuple, outs.tolist())):
            if to not in names:
                names[to] = len(names)
                order.append(to)
            row[kind] = names[to]
        rows.append(row)
    accepts = [sum(1 << k for k, (p, s) in enumerate(zip(parts, states)) if p.accepts[s]) for states in order]
    return minimise(Dfa(np.array(rows), np.array(accepts, np.int64)))


class Scanner:
    """All matches of many rules in one pass over the bytes of a text.

    Built once on the driver; workers get the transition arrays.
    """

    def __init__(self, patterns: tuple[str, ...]):
        trees = [parse(p) for p in patterns]
        classes = byte_classes(trees)
        self.kind_of = classes.tobytes()
        self.forward = combine(trees, classes)
        self.reverse = [determinise(backwards(t), False, classes) for t in trees]
        self._unpack()

    def __getstate__(self):
        return self.kind_of, self.forward, self.reverse

    def __setstate__(self, state):
        self.kind_of, self.forward, self.reverse = state
        self._unpack()

    def _unpack(self) -> None:
        """The arrays as flat lists, which single look-ups are fastest in; states are multiplied by the number of classes."""
        self.width = self.forward.next.shape[1]
        self.flat = (self.forward.next * self.width).ravel().tolist()
        self.first_accepting = int(np.argmax(self.forward.accepts != 0)) * self.width
        rules = range(len(self.reverse))
        self.rules_of = [[k for k in rules if m >> k & 1] for m in self.forward.accepts.tolist()]
        self.back = [(d.next.tolist(), d.accepts.tolist()) for d in self.reverse]

    def ends(self, kinds: bytes) -> list[tuple[int, int]]:
        """(place, state) of every byte at which some rule accepts."""
        flat, first, state, found = self.flat, self.first_accepting, 0, []
        for place, kind in enumerate(kinds):
            state = flat[state + kind]
            if state >= first:
                found.append((place, state // self.width))
        return found

    def start(self, rule: int, kinds: bytes, last: int, least: int) -> int:
        """Where the match whose first accepting byte is at ``last`` begins, not before ``least``."""
        rows, accepts = self.back[rule]
        state, begin, at = 0, last, last
        while at >= least:
            state = rows[state][kinds[at]]
            if state == 1:
                break
            if accepts[state]:
                begin = at
            at -= 1
        return begin

    def matches(self, data: bytes) -> list[tuple[int, int, int, int]]:
        """(rule, start, first accepting byte, end) of every match, end exclusive, in byte places."""
        kinds = data.translate(self.kind_of)
        runs: dict[int, list[list[int]]] = defaultdict(list)
        for place, state in self.ends(kinds):
            for rule in self.rules_of[state]:
                if runs[rule] and runs[rule][-1][1] == place - 1:
                    runs[rule][-1][1] = place
                else:
                    runs[rule].append([place, place])
        found = []
        for rule, own in runs.items():
            least = 0
            for first, last in own:
                found.append((rule, self.start(rule, kinds, first, least), first, last + 1))
                least = last + 1
        return found


@lru_cache(maxsize=4)
def scanner(patterns: tuple[str, ...]) -> Scanner:
    return Scanner(patterns)
