"""Regular expressions over bytes, compiled by subset construction and minimisation into transition arrays.

The dialect has literals, escapes (\\xHH, \\., and the like), classes, groups, | and the quantifiers ? * + {m,n}. It works on
bytes; classes and letters are ASCII. Several expressions can be compiled into one automaton, whose states then tell
which of them match at that point.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

START = 0


# Syntax: a node is ("set", frozenset of bytes) | ("cat", [nodes]) | ("alt", [nodes]) | ("rep", node, least, most or None)
class _Parser:
    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        c = self.peek()
        if not c:
            raise ValueError(f"{self.text!r} ends too early")
        self.at += 1
        return c

    def alternatives(self):
        found = [self.sequence()]
        while self.peek() == "|":
            self.take()
            found.append(self.sequence())
        return found[0] if len(found) == 1 else ("alt", found)

    def sequence(self):
        found = []
        while self.peek() and self.peek() not in "|)":
            found.append(self.quantified())
        return ("cat", found)

    def quantified(self):
        node = self.single()
        while (q := self.peek()) and q in "?*+{":
            self.take()
            if q == "{":
                least, comma, most = self.text[self.at : (end := self.text.index("}", self.at))].partition(",")
                self.at = end + 1
                node = ("rep", node, int(least), int(most) if most else None if comma else int(least))
            else:
                node = ("rep", node, int(q == "+"), 1 if q == "?" else None)
        return node

    def single(self):
        c = self.take()
        if c == "(":
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"{self.text!r} lacks a closing parenthesis")
            return node
        if c == "[":
            return self.char_class()
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        return self.letters({self.escaped() if c == "\\" else ord(c)})

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def char_class(self):
        negated = self.peek() == "^" and bool(self.take())
        found: set[int] = set()
        while (c := self.take()) != "]":
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.escaped() if (c := self.take()) == "\\" else ord(c)
            found |= set(range(low, high + 1))
        node = self.letters(found)
        return ("set", frozenset(range(256)) - node[1]) if negated else node

    def letters(self, found: set[int]):
        if self.fold:
            found = found | {ord(chr(b).swapcase()) for b in found if chr(b).isascii() and chr(b).isalpha()}
        return ("set", frozenset(found))


def parsed(pattern: str, fold: bool = False):
    parser = _Parser(pattern, fold)
    node = parser.alternatives()
    if parser.at != len(pattern):
        raise ValueError(f"{pattern!r} has an unmatched parenthesis")
    return node


def backwards(node):
    """The expression of the reversed strings."""
    if node[0] == "cat":
        return ("cat", [backwards(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [backwards(x) for x in node[1]])
    if node[0] == "rep":
        return ("rep", backwards(node[1]), node[2], node[3])
    return node


class _Nfa:
    """Thompson's construction: free[state] lists moves without a byte, on[state] is (bytes, target) or None."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.on: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append(None)
        return len(self.free) - 1

    def add(self, node, begin: int) -> int:
        """Attach node at begin; the state where it ends."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            middle = self.state()
            self.free[begin].append(middle)
            self.on[middle] = (node[1], end)
            return end
        if kind == "cat":
            for part in node[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                into = self.state()
                self.free[begin].append(into)
                self.free[self.add(part, into)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            begin = self.add(inner, begin)
        end = self.state()
        if most is None:
            loop = self.state()
            self.free[begin].append(loop)
            self.free[self.add(inner, loop)].append(loop)
            self.free[loop].append(end)
            return end
        for _ in range(most - least):
            self.free[begin].append(end)
            begin = self.add(inner, begin)
        self.free[begin].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """classes: byte to class; table: next state by state and class, states with accepts last; accepts: bit mask by state.

    State 0 is the start. dead is a state that nothing leads out of and that accepts nothing, or -1.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    first_accept: int
    dead: int

    def rows(self) -> tuple[bytes, list[list[int]], list[int]]:
        """The same as plain Python, for walking over single matches."""
        return self.classes.tobytes(), self.table.tolist(), self.accepts.tolist()


def compiled(node) -> Automaton:
    """The minimal automaton of one expression, matched from a given byte on."""
    nfa = _Nfa()
    root = nfa.state()
    final = nfa.add(node, root)
    sets = [x[0] for x in nfa.on if x]
    classes, sample = _byte_classes(lambda b: tuple(b in s for s in sets))

    def step(now: frozenset, b: int) -> frozenset:
        return nfa.closure({nfa.on[s][1] for s in now if nfa.on[s] and b in nfa.on[s][0]})

    return _subsets(classes, sample, nfa.closure([root]), step, lambda now: int(final in now))


def combined(nodes: list) -> Automaton:
    """One minimal automaton that accepts where a match of nodes[k] is first complete (bit k), from whichever byte it starts.

    What a match could still grow by is left out, so that the states needn't remember which matches are growing.
    """
    parts = [compiled(x) for x in nodes]
    classes, sample = _byte_classes(lambda b: tuple(int(p.classes[b]) for p in parts))
    begin = frozenset((k, START) for k in range(len(parts)))

    def step(now: frozenset, b: int) -> frozenset:
        moved = ((k, int(parts[k].table[s, parts[k].classes[b]])) for k, s in now if not parts[k].accepts[s])
        return begin | {(k, s) for k, s in moved if s != parts[k].dead}

    return _subsets(classes, sample, begin, step, lambda now: sum(1 << k for k, s in now if parts[k].accepts[s]))


def _byte_classes(kind) -> tuple[np.ndarray, list[int]]:
    """Bytes that no expression tells apart share a class; one byte of each class."""
    seen: dict[tuple, int] = {}
    classes = np.array([seen.setdefault(kind(b), len(seen)) for b in range(256)], np.uint8)
    return classes, [int(np.argmax(classes == c)) for c in range(len(seen))]


def _subsets(classes: np.ndarray, sample: list[int], begin: frozenset, step, mask) -> Automaton:
    numbers, order, table = {begin: 0}, [begin], []
    for now in order:
        row = []
        for b in sample:
            if (to := step(now, b)) not in numbers:
                numbers[to] = len(order)
                order.append(to)
            row.append(numbers[to])
        table.append(row)
    return _minimal(classes, np.array(table, np.int64), np.array([mask(now) for now in order], np.int64))


def _minimal(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Moore's refinement: split blocks of states until the states of a block agree on the blocks of all their targets."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        signature = np.column_stack([block, block[table]])
        refined = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    count = int(block.max()) + 1
    one = np.zeros(count, np.int64)
    one[block] = np.arange(len(block))  # any state of the block stands for it
    masks = accepts[one]
    rank = np.argsort([(0 if k == block[0] else 1 if masks[k] == 0 else 2) for k in range(count)], kind="stable")
    number = np.empty(count, np.int64)
    number[rank] = np.arange(count)
    table = number[block[table[one[rank]]]].astype(np.int32)
    masks = masks[rank]
    first = int(np.argmax(masks > 0)) if (masks > 0).any() else count
    stuck = [s for s in range(count) if masks[s] == 0 and (table[s] == s).all()]
    return Automaton(classes, table, masks, first, stuck[0] if stuck else -1)


#: Bytes that one block of the scan holds, and lanes that it is cut into.
BLOCK, LANES = 1 << 21, 2048
#: Never a byte of UTF-8; between texts it brings the automaton back to its start.
GAP = 0xFF


class Scanner:
    """Runs one automaton over bytes, many lanes abreast, and tells where it accepts."""

    def __init__(self, automaton: Automaton):
        width = automaton.table.shape[1]
        self.width, self.automaton = width, automaton
        self.step = (automaton.table * width).ravel().astype(np.int32)  # states are kept times width
        self.floor = automaton.first_accept * width
        self.classes = automaton.classes.astype(np.int32)

    def accepting(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose byte first completes a match of any rule, and their masks; BLOCK bytes at a time."""
        found, masks, state = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], START
        for low in range(0, len(data), BLOCK):
            at, mask, state = self._block(data[low : low + BLOCK], state)
            found.append(at + low)
            masks.append(mask)
        return np.concatenate(found), np.concatenate(masks)

    def _block(self, data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The same for one block that begins in a state, and the state that it ends in; full blocks need no filling up.

        The bytes are dealt to lanes of equal length, which all take one byte a step, each from the start state. A lane that
        should have begun in another state is walked again from there until it meets the states that it already has, which
        with such rules takes a few bytes; so the result is that of one pass from left to right.
        """
        n = len(data)
        lanes = max(1, min(LANES, n // 64))
        length = -(-n // lanes)
        raw = np.full(lanes * length, GAP, np.uint8)
        raw[:n] = np.frombuffer(data, np.uint8)
        columns = np.ascontiguousarray(self.classes[raw].reshape(lanes, length).T)
        states = np.empty((length, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        now[0] = state
        for i in range(length):
            now = np.take(self.step, now + columns[i], out=states[i], mode="clip")
        step = self.step
        for lane in range(1, lanes):
            state = int(states[-1, lane - 1])
            i = 0
            while state != START or i:
                state = int(step[state + columns[i, lane]])
                if states[i, lane] == state:
                    break
                states[i, lane] = state
                i += 1
                if i == length:
                    break
        flat = states.T.reshape(-1)
        at = np.flatnonzero(flat >= self.floor)
        at = at[at < n]
        return at, self.automaton.accepts[flat[at] // self.width], int(states[-1, -1])
