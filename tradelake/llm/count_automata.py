"""Weighted acyclic automata: sequences of 64-bit labels and their counts.

All sequences of an automaton have the same length. States lie in layers; a state is a run of arcs
(label, target state) ordered by label, and arcs into the end carry the counts. Built from
ordered sequences, states with the same arcs are made once, from the last layer up, so an automaton is
the least one that holds its sequences. Everything works on whole layers, not arc by arc.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from tradelake.llm import textbytes as tb

Paths = tuple[list[np.ndarray], np.ndarray]


def summed(columns: list[np.ndarray], weights: np.ndarray) -> Paths:
    """Sequences in order, one of each, with the sums of their weights."""
    if not len(weights):
        return columns, weights
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = np.zeros(len(order), bool)
    first[0] = True
    for c in columns:
        first[1:] |= c[1:] != c[:-1]
    begin = np.flatnonzero(first)
    return [c[begin] for c in columns], np.add.reduceat(weights[order], begin)


class CountAutomaton:
    """`first[d]` is where each state's arcs of layer d begin (one entry more than states)."""

    def __init__(
        self,
        first: list[np.ndarray],
        labels: list[np.ndarray],
        targets: list[np.ndarray],
        weights: np.ndarray,
    ):
        self.first, self.labels, self.targets, self.weights = first, labels, targets, weights

    @classmethod
    def build(cls, columns: list[np.ndarray], weights: np.ndarray) -> CountAutomaton:
        """From sequences in order without repeats, given by their first, second, ... labels."""
        depth, rows = len(columns), len(weights)
        # Where a new node begins in each layer of the tree of prefixes.
        new = np.zeros(rows, bool)
        new[:1] = True
        starts = [np.zeros(min(rows, 1), np.int64)]
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
            starts.append(np.flatnonzero(new))
        first, labels, targets = [], [], []
        values, at = weights, np.arange(rows)
        for d in range(depth - 1, -1, -1):
            # The arcs of this layer's nodes, one for each node (or sequence) below.
            begin = np.append(np.searchsorted(at, starts[d]), len(at))
            state, begin, kept = _merge(begin, columns[d][at], values)
            first.insert(0, begin)
            labels.insert(0, columns[d][at][kept])
            targets.insert(0, values[kept])
            values, at = state, starts[d]
        return cls(first, labels, targets[:-1], targets[-1])

    def paths(self) -> Paths:
        """All sequences in order, and their weights."""
        state = np.zeros(min(len(self.weights), 1), np.int64)
        columns: list[np.ndarray] = []
        arc = state
        for d, labels in enumerate(self.labels):
            count = self.first[d][state + 1] - self.first[d][state]
            columns = [np.repeat(c, count) for c in columns]
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            arc = np.repeat(self.first[d][state], count) + inside
            columns.append(labels[arc])
            if d < len(self.targets):
                state = self.targets[d][arc]
        return columns, self.weights[arc]

    def look_up(self, columns: list[np.ndarray]) -> np.ndarray:
        """Weight of each sequence asked for, 0 if it is not held: a walk of all of them at once."""
        rows = len(columns[0])
        alive = np.full(rows, len(self.weights) > 0)
        state, arc = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        for d, labels in enumerate(self.labels):
            if not len(labels):
                return np.zeros(rows, np.int64)
            low, high = self.first[d][state], self.first[d][state + 1]
            end = high
            while True:
                open_ = low < high
                if not open_.any():
                    break
                middle = (low + high) // 2
                less = open_ & (labels[np.minimum(middle, len(labels) - 1)] < columns[d])
                low = np.where(less, middle + 1, low)
                high = np.where(open_ & ~less, middle, high)
            arc = np.minimum(low, len(labels) - 1)
            alive &= (low < end) & (labels[arc] == columns[d])
            if d < len(self.targets):
                state = np.where(alive, self.targets[d][arc], 0)
        return np.where(alive, self.weights[arc], 0)

    def to_bytes(self) -> bytes:
        depth = len(self.labels)
        parts: list[np.ndarray] = []
        for d in range(depth):
            parts += [self.first[d], self.labels[d]]
        parts += [*self.targets, self.weights]
        packed = [_narrow(p) for p in parts]
        head = [depth] + [x for p in packed for x in (p.itemsize, len(p))]
        return np.array(head, "<i8").tobytes() + b"".join(p.tobytes() for p in packed)

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountAutomaton:
        depth = int(np.frombuffer(raw, "<i8", 1)[0])
        head = np.frombuffer(raw, "<i8", 1 + 2 * 3 * depth)[1:].reshape(-1, 2).tolist()
        at, parts = 8 + 16 * len(head), []
        for i, (width, size) in enumerate(head):
            kind = np.uint64 if i < 2 * depth and i % 2 else np.int64
            parts.append(np.frombuffer(raw, f"<u{width}", size, at).astype(kind))
            at += width * size
        return cls(parts[0 : 2 * depth : 2], parts[1 : 2 * depth : 2], parts[2 * depth : -1], parts[-1])

    @staticmethod
    def union(automata: Iterable[CountAutomaton], limit: int = 1 << 21) -> Paths:
        """Sequences of all automata in order, with summed weights.

        Sums are taken whenever as many sequences wait as there are sums, and `limit` at least, so
        memory follows the distinct ones.
        """
        done: Paths | None = None
        waiting: list[Paths] = []
        count = 0
        for one in automata:
            waiting.append(one.paths())
            count += len(waiting[-1][1])
            if count >= max(limit, len(done[1]) if done else 0):
                done, waiting, count = _join([done, *waiting] if done else waiting), [], 0
        if waiting:
            done = _join([done, *waiting] if done else waiting)
        return done or ([], np.zeros(0, np.int64))


def _join(parts: list[Paths]) -> Paths:
    columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts))]
    return summed(columns, np.concatenate([p[1] for p in parts]))


def _merge(
    begin: np.ndarray, labels: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One state for all nodes with the same arcs.

    Takes where the nodes' arcs begin; gives the state of each node, where the states' arcs begin and
    which arcs they are. Nodes that look alike by their hashes are compared arc by arc.
    """
    nodes = len(begin) - 1
    count = np.diff(begin)
    owner = np.repeat(np.arange(nodes), count)
    place = np.arange(len(labels)) - begin[owner]
    code = tb.chain(tb.chain(labels, values.astype(np.uint64)), place.astype(np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(code, dtype=np.uint64)])
    code = tb.chain(sums[begin[1:]] - sums[begin[:-1]], count.astype(np.uint64))
    _, model, group = np.unique(code, return_index=True, return_inverse=True)
    like = model[group][owner]
    own = np.minimum(begin[like] + place, len(labels) - 1)
    differs = (labels[own] != labels) | (values[own] != values) | (count[like] != count[owner])
    apart = np.zeros(nodes, bool)
    apart[owner[differs]] = True
    model_of = np.where(apart, np.arange(nodes), model[group])
    states, state = np.unique(model_of, return_inverse=True)
    sizes = count[states]
    ends = np.cumsum(sizes)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    kept = np.repeat(begin[states], sizes) + inside
    return state.astype(np.int64), np.concatenate([[0], ends]), kept


def _narrow(values: np.ndarray) -> np.ndarray:
    """The least unsigned width that holds all values."""
    top = int(values.max()) if len(values) else 0
    for width in (1, 2, 4):
        if top < 1 << (8 * width):
            return values.astype(f"<u{width}")
    return values.astype("<u8")
