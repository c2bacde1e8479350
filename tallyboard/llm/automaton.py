"""Byte automata: regular expressions to one minimal deterministic automaton.

The syntax is literals, `\\xHH`, classes, groups, `|`, `?`, `*`, `+` and counted
repetition. `compile_rules` joins any number of rules: each becomes a nondeterministic
automaton, the subset construction (restarted at every byte, so that a match may begin
anywhere) makes them one deterministic automaton, bytes that no state tells apart become
one class, and partition refinement merges states that agree on all continuations.

An automaton that is not restarted reads one rule from a given place on, and one made of
the turned moves reads it from its end back; so the joined automaton tells where rules
end, and these tell where such a match starts and how far it goes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from operator import length_hint

import numpy as np


class _Parser:
    """Recursive descent straight into states: a fragment is (entry, exit)."""

    def __init__(self, pattern: str, nfa: _Nfa):
        self.p, self.i, self.nfa = pattern, 0, nfa

    def parse(self) -> tuple[int, int]:
        out = self._choice()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} at {self.i} in {self.p!r}")
        return out

    def _peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def _choice(self) -> tuple[int, int]:
        parts = [self._sequence()]
        while self._peek() == "|":
            self.i += 1
            parts.append(self._sequence())
        if len(parts) == 1:
            return parts[0]
        entry, leave = self.nfa.state(), self.nfa.state()
        for a, b in parts:
            self.nfa.free[entry].append(a)
            self.nfa.free[b].append(leave)
        return entry, leave

    def _sequence(self) -> tuple[int, int]:
        entry = leave = self.nfa.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._repeat()
            self.nfa.free[leave].append(a)
            leave = b
        return entry, leave

    def _repeat(self) -> tuple[int, int]:
        begun = self.i
        part = self._atom()
        after_atom = self.i
        low, high = self._count()
        if (low, high) == (1, 1):
            return part
        after_count = self.i
        entry = leave = self.nfa.state()

        def again() -> tuple[int, int]:
            self.i = begun
            out = self._atom()
            assert self.i == after_atom
            return out

        for _ in range(low):
            a, b = part if part else again()
            part = None
            self.nfa.free[leave].append(a)
            leave = b
        if high is None:
            a, b = part if part else again()
            turn = self.nfa.state()
            self.nfa.free[leave].append(turn)
            self.nfa.free[turn].append(a)
            self.nfa.free[b].append(turn)
            leave = turn
        else:
            end = self.nfa.state()
            for _ in range(high - low):
                self.nfa.free[leave].append(end)
                a, b = part if part else again()
                part = None
                self.nfa.free[leave].append(a)
                leave = b
            self.nfa.free[leave].append(end)
            leave = end
        self.i = after_count
        return entry, leave

    def _count(self) -> tuple[int, int | None]:
        c = self._peek()
        if c in ("?", "*", "+") and c:
            self.i += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            end = self.p.index("}", self.i)
            low, comma, high = self.p[self.i + 1 : end].partition(",")
            self.i = end + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def _atom(self) -> tuple[int, int]:
        c = self._peek()
        if c == "(":
            self.i += 1
            out = self._choice()
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            self.i += 1
            return out
        allowed = self._class() if c == "[" else {self._byte()}
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.moves[a].append((frozenset(allowed), b))
        return a, b

    def _byte(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def _class(self) -> set[int]:
        self.i += 1
        negated = self._peek() == "^"
        self.i += negated
        out: set[int] = set()
        while self._peek() != "]":
            low = high = self._byte()
            if self._peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                high = self._byte()
            out |= set(range(low, high + 1))
        self.i += 1
        return set(range(256)) - out if negated else out


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def turned(self) -> _Nfa:
        """All moves the other way round."""
        out = _Nfa()
        for _ in self.free:
            out.state()
        for s, targets in enumerate(self.free):
            for t in targets:
                out.free[t].append(s)
        for s, moves in enumerate(self.moves):
            for allowed, t in moves:
                out.moves[t].append((allowed, s))
        return out

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if self.moves[s] or not self.free[s])


@dataclass(frozen=True)
class Automaton:
    """step[state * n_classes + class_of[byte]] is the next state times n_classes.

    States are numbered with the accepting ones last, from `accepting` on; `rules` has the
    bit set of the rules that end in each of these.
    """

    class_of: np.ndarray
    step: np.ndarray
    n_classes: int
    start: int
    accepting: int
    rules: np.ndarray

    @property
    def n_states(self) -> int:
        return len(self.step) // self.n_classes

    def reader(self) -> Callable[[bytes, Callable[[int, int], None]], None]:
        """A function that reads bytes once and reports (position after the byte, bit set of rules) wherever rules end."""
        step, classes = self.step.tolist(), self.class_of.tobytes()
        least, n, rules, start = self.accepting * self.n_classes, self.n_classes, self.rules.tolist(), self.start

        def read(data: bytes, report: Callable[[int, int], None]) -> None:
            state, left = start, iter(data.translate(classes))
            for c in left:
                state = step[state + c]
                if state >= least:
                    report(len(data) - length_hint(left), rules[(state - least) // n])

        return read

    def scanner(self) -> Callable[[bytes], int]:
        """A function from bytes to the bit set of the rules that end anywhere in them; one pass."""
        read = self.reader()

        def scan(data: bytes) -> int:
            found = 0

            def report(_: int, rules: int) -> None:
                nonlocal found
                found |= rules

            read(data, report)
            return found

        return scan

    def reach(self) -> Callable[[bytes], int]:
        """A function from bytes to the length of the longest match that starts at the first, -1 if there is none.

        It stops where no match can follow, so it reads little more than the match; the bytes may come from any iterator.
        """
        step, classes, start = self.step.tolist(), self.class_of.tolist(), self.start
        least, n = self.accepting * self.n_classes, self.n_classes
        dead = {s * n for s in range(self.accepting) if (self.step[s * n : (s + 1) * n] == s * n).all()}

        def longest(data) -> int:
            state, best = start, 0 if start >= least else -1
            for at, c in enumerate(data, 1):
                state = step[state + classes[c]]
                if state >= least:
                    best = at
                elif state in dead:
                    break
            return best

        return longest


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that every move treats alike share a class; one member of each."""
    sets = sorted({m for moves in nfa.moves for m, _ in moves}, key=sorted)
    seen: dict[tuple, int] = {}
    class_of = np.zeros(256, dtype=np.uint8)
    members: list[int] = []
    for b in range(256):
        key = tuple(b in s for s in sets)
        if key not in seen:
            seen[key] = len(members)
            members.append(b)
        class_of[b] = seen[key]
    return class_of, members


def _subsets(nfa: _Nfa, entries: list[int], ends: dict[int, int], members: list[int], anywhere: bool):
    start = nfa.closure(entries)
    again = start if anywhere else frozenset()
    number, order, table, masks = {start: 0}, [start], [], []
    for states in order:
        row = []
        for b in members:
            target = nfa.closure([t for s in states for m, t in nfa.moves[s] if b in m]) | again
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
        mask = 0
        for s in states:
            mask |= ends.get(s, 0)
        masks.append(mask)
    return np.array(table, dtype=np.int64), np.array(masks, dtype=np.int64)


def _minimise(table: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Partition refinement from the accepted sets until no class splits; start is state 0's class."""
    part = np.unique(masks, return_inverse=True)[1].reshape(-1)
    while True:
        keys = np.column_stack([part, part[table]])
        refined = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == part.max():
            break
        part = refined
    first = np.unique(part, return_index=True)[1]
    return part[table[first]], masks[first], int(part[0])


def compile_rules(patterns: list[str], anywhere: bool = True, backward: bool = False) -> Automaton:
    """One automaton of all patterns; `anywhere` lets matches start at every byte, `backward` reads them from their ends."""
    nfa, entries, ends = _Nfa(), [], {}
    for k, pattern in enumerate(patterns):
        a, b = _Parser(pattern, nfa).parse()
        end = nfa.state()
        nfa.free[b].append(end)
        entries.append(end if backward else a)
        ends[a if backward else end] = 1 << k
    nfa = nfa.turned() if backward else nfa
    class_of, members = _byte_classes(nfa)
    table, masks, start = _minimise(*_subsets(nfa, entries, ends, members, anywhere))
    order = np.argsort(masks != 0, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    n = len(members)
    return Automaton(
        class_of=class_of,
        step=(place[table[order]] * n).reshape(-1).astype(np.int32),
        n_classes=n,
        start=int(place[start]) * n,
        accepting=int((masks == 0).sum()),
        rules=masks[order][masks[order] != 0],
    )
