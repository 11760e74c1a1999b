"""Rule patterns compiled into one minimal deterministic automaton over bytes.

Patterns know literals, ``\\xHH``, ``[a-z]`` sets, groups, ``|``, ``?``, ``*``,
``+`` and ``{m}``, ``{m,}``, ``{m,n}``.  A match of a rule is the leftmost one,
and of those the longest; matches of a rule do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SEPARATOR = 0xFF  # never a byte of UTF-8; takes the automaton to its start
CHUNK = 1024  # bytes that are scanned one after the other


class _Parser:
    """Recursive descent into (kind, ...) tuples."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.rest, self.ignore_case = list(pattern)[::-1], ignore_case

    def parse(self):
        node = self.choice()
        if self.rest:
            raise ValueError(f"unexpected {self.rest[-1]!r}")
        return node

    def choice(self):
        options = [self.sequence()]
        while self.rest and self.rest[-1] == "|":
            self.rest.pop()
            options.append(self.sequence())
        return ("choice", options)

    def sequence(self):
        items = []
        while self.rest and self.rest[-1] not in "|)":
            items.append(self.repeated(self.atom()))
        return ("sequence", items)

    def repeated(self, node):
        while self.rest and self.rest[-1] in "?*+{":
            sign = self.rest.pop()
            if sign == "{":
                text = ""
                while (char := self.rest.pop()) != "}":
                    text += char
                low, _, high = text.partition(",")
                most = int(low) if "," not in text else int(high) if high else None
                node = ("repeat", node, int(low), most)
            else:
                node = ("repeat", node, int(sign == "+"), 1 if sign == "?" else None)
        return node

    def atom(self):
        char = self.rest.pop()
        if char in "?*+{":
            raise ValueError(f"nothing to repeat before {char!r}")
        if char == "(":
            node = self.choice()
            if not self.rest or self.rest.pop() != ")":
                raise ValueError("a group is not closed")
            return node
        if char == "[":
            members = set()
            while self.rest[-1] != "]":
                low = high = self.byte(self.rest.pop())
                if self.rest[-1] == "-" and self.rest[-2] != "]":
                    self.rest.pop()
                    high = self.byte(self.rest.pop())
                members.update(range(low, high + 1))
            self.rest.pop()
            return ("bytes", self.both_cases(members))
        return ("bytes", self.both_cases({self.byte(char)}))

    def byte(self, char: str) -> int:
        if char == "\\":
            char = self.rest.pop()
            if char == "x":
                return int(self.rest.pop() + self.rest.pop(), 16)
        return ord(char)

    def both_cases(self, members: set[int]) -> frozenset[int]:
        if self.ignore_case:
            letters = {b for b in members if chr(b).isascii() and chr(b).isalpha()}
            members = members | {b ^ 0x20 for b in letters}
        return frozenset(members)


class _Nfa:
    """States with empty moves and byte moves; state 0 starts every rule."""

    def __init__(self, patterns: list[tuple[str, bool]]):
        self.empty: list[list[int]] = [[]]
        self.moves: list[list[tuple[frozenset[int], int]]] = [[]]
        self.owner = [0]  # bit of the rule of a state
        self.accepts: dict[int, int] = {}
        for i, (pattern, ignore_case) in enumerate(patterns):
            self.bit = 1 << i
            start = self.state()
            self.empty[0].append(start)
            end = self.build(_Parser(pattern, ignore_case).parse(), start)
            self.accepts[end] = self.bit

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        self.owner.append(self.bit)
        return len(self.owner) - 1

    def build(self, node, start: int) -> int:
        kind = node[0]
        if kind == "bytes":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "sequence":
            for item in node[1]:
                start = self.build(item, start)
            return start
        if kind == "choice":
            end = self.state()
            for option in node[1]:
                self.empty[self.build(option, start)].append(end)
            return end
        _, item, low, high = node
        for _ in range(low):
            start = self.build(item, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.build(item, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.build(item, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.empty[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state, class]`` with the rules each state accepts or is inside of.

    States are ordered so that those from ``first_accept`` on accept a rule.
    """

    table: np.ndarray
    classes: np.ndarray
    accepts: np.ndarray
    inside: np.ndarray
    start: int
    first_accept: int

    def longest(self, data: bytes, begin: int, end: int) -> int:
        """End of the longest anchored match from ``begin``, or -1."""
        state, last = self.start, -1
        for at in range(begin, end):
            state = self.table[state, self.classes[data[at]]]
            if not self.inside[state]:
                break
            if self.accepts[state]:
                last = at + 1
        return last


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """The class of each byte, and one byte of each class."""
    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    signatures: dict[tuple, int] = {("separator",): 0}
    classes, samples = np.zeros(256, np.uint8), [SEPARATOR]
    for byte in range(256):
        if byte == SEPARATOR:
            continue
        signature = tuple(byte in s for s in sets)
        if signature not in signatures:
            signatures[signature] = len(samples)
            samples.append(byte)
        classes[byte] = signatures[signature]
    return classes, samples


def compile_rules(
    patterns: list[tuple[str, bool]], anchored: bool = False
) -> Automaton:
    """Subset construction over all (pattern, ignore_case), then minimisation.

    Unanchored, a match may begin at every byte.  A state is the set of
    pattern states that the bytes so far have reached.
    """
    nfa = _Nfa(patterns)
    initial = nfa.closure([0])
    classes, samples = _byte_classes(nfa)
    closures = [nfa.closure([state]) for state in range(len(nfa.owner))]
    moves = [
        [([c for c, byte in enumerate(samples) if byte in members], closures[target])
         for members, target in of_state]
        for of_state in nfa.moves
    ]
    begin = initial if anchored else frozenset()
    numbers, sets, table = {begin: 0}, [begin], []
    for subset in sets:
        reached: list[set[int]] = [set() for _ in samples]
        for state in subset if anchored else subset | initial:
            for of_class, targets in moves[state]:
                for c in of_class:
                    reached[c] |= targets
        row = []
        for target in map(frozenset, reached):
            if target not in numbers:
                numbers[target] = len(sets)
                sets.append(target)
            row.append(numbers[target])
        table.append(row)
    accepts = [sum(nfa.accepts.get(s, 0) for s in subset) for subset in sets]
    inside = [np.bitwise_or.reduce([0, *(nfa.owner[s] for s in x)]) for x in sets]
    return _minimal(
        np.array(table), classes, np.array(accepts), np.array(inside), anchored
    )


def _minimal(table, classes, accepts, inside, anchored) -> Automaton:
    """Merge states that no continuation tells apart, by refining partitions.

    The start of an anchored automaton counts as inside, as it is alive.
    """
    outputs = np.stack([accepts, inside], 1)
    block = np.unique(outputs, axis=0, return_inverse=True)[1].ravel()
    while True:
        signature = np.column_stack([block, block[table]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, sample = np.unique(block, return_index=True)
    order = np.argsort(accepts[sample] != 0, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    sample = sample[order]
    return Automaton(
        table=rank[block[table[sample]]].astype(np.int32),
        classes=classes,
        accepts=accepts[sample],
        inside=inside[sample],
        start=int(rank[block[0]]),
        first_accept=int((accepts[sample] == 0).sum()),
    )


def scan(automaton: Automaton, data: np.ndarray) -> np.ndarray:
    """The state after each byte, as (place in the chunk, chunk).

    All chunks are scanned side by side from the start state.  A chunk whose
    true first state differs is scanned again, only as far as its states
    change, until every chunk continues the one before.
    """
    width = automaton.table.shape[1]
    flat = (automaton.table * width).ravel()
    start = automaton.start * width
    chunks = max(1, -(-len(data) // CHUNK))
    padded = np.zeros(chunks * CHUNK, np.uint8)
    padded[: len(data)] = automaton.classes[data]
    codes = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    states = np.empty(codes.shape, np.int32)
    state = np.full(chunks, start, np.int32)
    for at in range(CHUNK):
        state = flat[state + codes[at]]
        states[at] = state
    taken = np.full(chunks, start, np.int32)
    while True:
        entry = np.concatenate([[start], states[-1, :-1]]).astype(np.int32)
        live = np.flatnonzero(entry != taken)
        if not len(live):
            break
        state = entry[live]
        for at in range(CHUNK):
            state = flat[state + codes[at, live]]
            changed = state != states[at, live]
            if not changed.any():
                break
            live, state = live[changed], state[changed]
            states[at, live] = state
        taken = entry
    states //= width
    return states


def accepting_bytes(automaton: Automaton, states: np.ndarray) -> np.ndarray:
    """Positions after which a rule has matched, in order."""
    place, chunk = np.nonzero(states >= automaton.first_accept)
    return np.sort(chunk * CHUNK + place)


def states_between(states: np.ndarray, begin: int, end: int) -> np.ndarray:
    at = np.arange(begin, end)
    return states[at % CHUNK, at // CHUNK]


def candidate_runs(
    automaton: Automaton, states: np.ndarray, rule: int
) -> Iterator[tuple[int, int]]:
    """The stretches inside which a rule has matched; each match lies in one."""
    bit = 1 << rule
    ends = np.flatnonzero(automaton.accepts[states] & bit)
    if len(ends):
        outside = np.flatnonzero((automaton.inside[states] & bit) == 0)
        bounds = np.concatenate([[-1], outside, [len(states)]])
        for run in np.unique(np.searchsorted(outside, ends)):
            yield int(bounds[run]) + 1, int(bounds[run + 1])


def matches(
    anchored: Automaton, data: bytes, begin: int, end: int
) -> Iterator[tuple[int, int]]:
    """Leftmost-longest matches of one rule that do not overlap."""
    while begin < end:
        last = anchored.longest(data, begin, end)
        if last > begin:
            yield begin, last
            begin = last
        else:
            begin += 1
