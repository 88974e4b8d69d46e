"""Regular expressions to one minimal deterministic automaton over bytes.

A rule is parsed into a tree, the trees into one nondeterministic automaton, that
by subset construction into a deterministic one over classes of equal bytes, and
that by partition refinement into the minimal one.  The result is arrays:
``step[state, byte]`` and ``accepts[state]``, a bit for each rule.

Understood: literals, ``.``, ``[...]`` with ranges and ``^``, escapes, groups,
``|``, ``? * +``, ``{m}``, ``{m,}``, ``{m,n}``, and ``(?i:...)`` for ASCII letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ANY = frozenset(range(256)) - {10}
ESCAPES = {"n": 10, "r": 13, "t": 9}
SETS = {
    "d": frozenset(range(48, 58)),
    "s": frozenset([9, 10, 11, 12, 13, 32]),
    "w": frozenset([*range(48, 58), *range(65, 91), *range(97, 123), 95]),
}


class _Parser:
    """Recursive descent to nested tuples: set, cat, alt, rep."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def expect(self, what: str) -> None:
        if self.take() != what:
            raise ValueError(f"{what!r} expected at {self.at - 1} of {self.text!r}")

    def parse(self):
        tree = self.either()
        if self.at < len(self.text):
            raise ValueError(f"unbalanced at {self.at} of {self.text!r}")
        return tree

    def either(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        tree = self.single()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                bounds = ""
                while self.peek() != "}":
                    bounds += self.take()
                self.take()
                low, comma, high = bounds.partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            tree = ("rep", tree, least, most)
        return tree

    def single(self):
        c = self.take()
        if c == "(":
            held = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            tree = self.either()
            self.expect(")")
            self.fold = held
            return tree
        if c == "[":
            return ("set", self.folded(self.bracket()))
        if c == ".":
            return ("set", ANY)
        if c == "\\":
            return ("set", self.folded(self.escape()))
        raw = c.encode()
        if len(raw) > 1:
            return ("cat", [("set", frozenset([b])) for b in raw])
        return ("set", self.folded(frozenset(raw)))

    def escape(self) -> frozenset[int]:
        c = self.take()
        if c == "x":
            self.at += 2
            return frozenset([int(self.text[self.at - 2 : self.at], 16)])
        if c in SETS:
            return SETS[c]
        return frozenset([ESCAPES.get(c, ord(c))])

    def bracket(self) -> frozenset[int]:
        negate, members = self.peek() == "^", set()
        if negate:
            self.take()
        while self.peek() != "]":
            low = self.escape() if (c := self.take()) == "\\" else frozenset([ord(c)])
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escape() if (c := self.take()) == "\\" else frozenset([ord(c)])
                members.update(range(min(low), max(high) + 1))
            else:
                members |= low
        self.take()
        return frozenset(range(256)) - members if negate else frozenset(members)

    def folded(self, members: frozenset[int]) -> frozenset[int]:
        if not self.fold:
            return members
        letters = {b for b in members if 65 <= (b & 0xDF) <= 90}
        return members | {b ^ 0x20 for b in letters}


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def node(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, tree, start: int, backward: bool) -> int:
        """Lay ``tree`` from ``start``; the node at which it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.node()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in reversed(tree[1]) if backward else tree[1]:
                start = self.add(part, start, backward)
            return start
        if kind == "alt":
            end = self.node()
            for part in tree[1]:
                first = self.node()
                self.empty[start].append(first)
                self.empty[self.add(part, first, backward)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start, backward)
        if most is None:
            loop = self.node()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop, backward)].append(loop)
            return loop
        end = self.node()
        self.empty[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start, backward)
            self.empty[start].append(end)
        return end

    def closure(self, nodes) -> frozenset[int]:
        found, todo = set(nodes), list(nodes)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in found:
                    found.add(n)
                    todo.append(n)
        return frozenset(found)


@dataclass(frozen=True)
class Dfa:
    step: np.ndarray  #: states x 256, the next state; state 0 is the start
    accepts: np.ndarray  #: by state, bit k set where rule k has a match that ends here

    @property
    def rows(self) -> list[list]:
        """A list for each state: the next state's list by byte, at 256 what it accepts.

        Follows references instead of indices, the quickest form for an interpreter.
        """
        rows: list[list] = [[] for _ in self.accepts]
        for row, targets, accepted in zip(rows, self.step.tolist(), self.accepts.tolist(), strict=True):
            row.extend([rows[t] for t in targets])
            row.append(accepted)
        return rows


def compile_rules(patterns: list[str], *, anywhere: bool = False, backward: bool = False) -> Dfa:
    """One automaton for all patterns.  anywhere: a match may start at any byte."""
    nfa = _Nfa()
    start, ends = nfa.node(), {}
    for k, pattern in enumerate(patterns):
        first = nfa.node()
        nfa.empty[start].append(first)
        ends[nfa.add(_Parser(pattern).parse(), first, backward)] = 1 << k
    if anywhere:
        nfa.moves[start].append((frozenset(range(256)), start))
    return _minimised(*_subsets(nfa, start, ends))


def _subsets(nfa: _Nfa, start: int, ends: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    # Bytes that every set holds or lacks alike behave alike.
    sets = list({members for moves in nfa.moves for members, _ in moves})
    kinds: dict[tuple[bool, ...], list[int]] = {}
    for b in range(256):
        kinds.setdefault(tuple(b in s for s in sets), []).append(b)
    classes = list(kinds.values())
    first = nfa.closure([start])
    number, todo, step = {first: 0}, [first], []
    closures: dict[frozenset[int], frozenset[int]] = {}
    while todo:
        batch, todo = todo, []
        for state in batch:
            row = np.zeros(256, np.int32)
            for members in classes:
                moved = frozenset(to for n in state for on, to in nfa.moves[n] if members[0] in on)
                if moved not in closures:
                    closures[moved] = nfa.closure(moved)
                target = closures[moved]
                if target not in number:
                    number[target] = len(number)
                    todo.append(target)
                row[members] = number[target]
            step.append(row)
    accepts = np.array([sum({ends[n] for n in state if n in ends}) for state in number], np.int64)
    return np.stack(step), accepts


def _minimised(step: np.ndarray, accepts: np.ndarray) -> Dfa:
    """Refine the partition by what states accept until their moves agree."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        seen = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if seen.max() == block.max():
            break
        block = seen
    # The start's block comes first.
    order = np.full(block.max() + 1, -1)
    first = np.unique(block, return_index=True)[1]
    order[block[0]] = 0
    rest = [b for b in range(len(order)) if b != block[0]]
    order[rest] = np.arange(1, len(order))
    members = first[np.argsort(order)]
    return Dfa(order[block[step[members]]].astype(np.int32), accepts[members])
