"""A small regular-expression compiler: pattern -> NFA -> subset construction -> minimal
DFA as a transition array over bytes.

Pattern subset: literals, ``\\xHH`` and escaped literals, classes with ranges, groups,
alternation, ``?``, ``*``, ``+``, ``{m,n}`` and ``{m,}``. Classes hold ASCII only, so a
UTF-8 byte outside ASCII never matches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Nfa:
    """Numbered states with empty edges and byte-set edges."""

    empty: list[list[int]] = field(default_factory=list)
    edges: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1


class _Parser:
    """Recursive descent; every method returns a tree of tuples."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.text, self.at, self.ignore_case = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternation(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("or", options) if len(options) > 1 else options[0]

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated())
        return ("seq", items)

    def repeated(self):
        item = self.atom()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                close = self.text.index("}", self.at)
                low, _, high = self.text[self.at:close].partition(",")
                exact = "," not in self.text[self.at:close]
                self.at = close + 1
                item = ("rep", item, int(low), int(low) if exact else int(high) if high else None)
            else:
                item = ("rep", item, 1 if sign == "+" else 0, 1 if sign == "?" else None)
        return item

    def char(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def atom(self):
        if self.peek() == "(":
            self.take()
            inner = self.alternation()
            self.take()
            return inner
        if self.peek() != "[":
            return ("set", self.fold({self.char()}))
        self.take()
        chars: set[int] = set()
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.char()
            chars |= set(range(low, high + 1))
        self.take()
        return ("set", self.fold(chars))

    def fold(self, chars: set[int]) -> frozenset[int]:
        if max(chars) > 127:
            raise ValueError("patterns are ASCII")
        if self.ignore_case:
            both = (f(chr(c)) for c in chars for f in (str.lower, str.upper))
            chars = chars | {ord(c) for c in both}
        return frozenset(chars)


def parse(pattern: str, ignore_case: bool = False):
    return _Parser(pattern, ignore_case).alternation()


def reverse(tree):
    """The tree of the language's mirror image."""
    if tree[0] == "seq":
        return ("seq", [reverse(x) for x in tree[1][::-1]])
    if tree[0] == "or":
        return ("or", [reverse(x) for x in tree[1]])
    return ("rep", reverse(tree[1]), *tree[2:]) if tree[0] == "rep" else tree


def _build(nfa: _Nfa, tree, start: int) -> int:
    """Add ``tree`` behind ``start``; the state at its end."""
    if tree[0] == "set":
        end = nfa.state()
        nfa.edges[start].append((tree[1], end))
        return end
    if tree[0] == "seq":
        for item in tree[1]:
            start = _build(nfa, item, start)
        return start
    end = nfa.state()
    if tree[0] == "or":
        for option in tree[1]:
            nfa.empty[_build(nfa, option, start)].append(end)
        return end
    _, item, low, high = tree
    for _ in range(low):
        start = _build(nfa, item, start)
    if high is None:
        loop = nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, item, loop)].append(loop)
        nfa.empty[loop].append(end)
        return end
    for _ in range(high - low):
        nfa.empty[start].append(end)
        start = _build(nfa, item, start)
    nfa.empty[start].append(end)
    return end


@dataclass(frozen=True)
class Dfa:
    """``step[state, byte]`` is the next state, ``accepts[state]`` a bit mask of the rules
    that a match may end with; state 0 is the start."""

    step: np.ndarray
    accepts: np.ndarray

    def linked(self) -> list[list]:
        """The array as linked rows: row[byte] is the next row, row[256] the mask, row[257]
        whether the state can be left no more."""
        rows: list[list] = [[] for _ in self.accepts]
        for row, nxt, mask in zip(rows, self.step.tolist(), self.accepts.tolist(), strict=True):
            row.extend(rows[k] for k in nxt)
            row += [mask, all(rows[k] is row for k in nxt)]
        return rows


def compile_rules(trees: list, anywhere: bool) -> Dfa:
    """The minimal DFA of all rules together; ``anywhere`` lets a match start at any byte."""
    nfa = _Nfa()
    root = nfa.state()
    final: dict[int, int] = {}
    for k, tree in enumerate(trees):
        first = nfa.state()
        nfa.empty[root].append(first)
        final[_build(nfa, tree, first)] = 1 << k

    def closure(states) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for x in nfa.empty[stack.pop()]:
                if x not in seen:
                    seen.add(x)
                    stack.append(x)
        return frozenset(seen)

    start = closure([root])
    number, order, rows = {start: 0}, [start], []
    for states in order:  # grows while it is walked
        targets: list[set[int]] = [set() for _ in range(256)]
        for s in states:
            for chars, to in nfa.edges[s]:
                for c in chars:
                    targets[c].add(to)
        row, known = [], {}
        for to in map(frozenset, targets):
            if to not in known:
                full = closure(to) | (start if anywhere else frozenset())
                if full not in number:
                    number[full] = len(order)
                    order.append(full)
                known[to] = number[full]
            row.append(known[to])
        rows.append(row)
    accepts = np.array([sum({final[s] for s in states if s in final}) for states in order])
    return _minimal(np.array(rows), accepts)


def _minimal(step: np.ndarray, accepts: np.ndarray) -> Dfa:
    """Partition refinement: states stay together while their successors' classes agree."""
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        keys = np.column_stack([group, group[step]])
        _, first, new = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == group.max():
            break
        group = new
    # state 0 stays the start
    rank = np.argsort(np.argsort(first))
    new, first = rank[new], np.sort(first)
    return Dfa(new[step[first]], accepts[first])
