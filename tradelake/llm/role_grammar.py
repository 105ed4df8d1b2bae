"""A role grammar as LR tables, and its generalised parser with edits.

The parser keeps a stack of LR states for each way to read what it has seen; ways share their stacks' lower
parts. Weighted edits let it go on where the grammar does not: a turn may be deleted or get another
role, and turns may be inserted. Of ways with equal stack tops the one with the least (cost,
audit) stays: the audit has a letter for each edit, in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import lru_cache

# The letters and weights of the edits.
KEEP, RETYPE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, RETYPE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5

# A conversation: nothing, or an optional system turn and pairs of user and assistant.
CONVERSATION = {
    "talk": ((), ("pairs",), ("s", "pairs")),
    "pairs": (("u", "a"), ("pairs", "u", "a")),
}

Stack = tuple[int, ...]
Way = tuple[int, str, Stack]


class Tables:
    """LR(0) states of a grammar whose stacks have bounded depth, and moves between whole stacks."""

    def __init__(self, grammar: Mapping[str, tuple[tuple[str, ...], ...]], start: str):
        self.grammar, self.start = grammar, start
        self.states: list[frozenset] = []
        self.goto: dict[tuple[int, str], int] = {}
        self._add(self._closure({(None, (start,), 0)}))
        todo = [0]
        while todo:
            state = todo.pop()
            after: dict[str, set] = {}
            for name, body, dot in self.states[state]:
                if dot < len(body):
                    after.setdefault(body[dot], set()).add((name, body, dot + 1))
            for symbol, items in sorted(after.items()):
                known = len(self.states)
                self.goto[state, symbol] = self._add(self._closure(items))
                if len(self.states) > known:
                    todo.append(known)
        self.terminals = sorted(
            {s for bodies in grammar.values() for body in bodies for s in body if s not in grammar}
        )
        self._check_tops()

    def _closure(self, items: Iterable[tuple]) -> frozenset:
        done, todo = set(), list(items)
        while todo:
            item = todo.pop()
            if item in done:
                continue
            done.add(item)
            _, body, dot = item
            if dot < len(body) and body[dot] in self.grammar:
                todo += [(body[dot], own, 0) for own in self.grammar[body[dot]]]
        return frozenset(done)

    def _add(self, state: frozenset) -> int:
        if state not in self.states:
            self.states.append(state)
        return self.states.index(state)

    def _reduced(self, stack: Stack) -> list[Stack]:
        """The stack and all that reductions make of it."""
        out, todo = [], [stack]
        while todo:
            one = todo.pop()
            if one in out:
                continue
            out.append(one)
            for name, body, dot in self.states[one[-1]]:
                if name is not None and dot == len(body):
                    below = one[: len(one) - len(body)]
                    todo.append((*below, self.goto[below[-1], name]))
        return out

    def shift(self, stack: Stack, terminal: str) -> list[Stack]:
        """The stacks after one more turn, by top."""
        ways = (one for one in self._reduced(stack) if (one[-1], terminal) in self.goto)
        return sorted((*one, self.goto[one[-1], terminal]) for one in ways)

    def accepts(self, stack: Stack) -> bool:
        final = (None, (self.start,), 1)
        return any(final in self.states[one[-1]] for one in self._reduced(stack))

    def last_turn(self, stack: Stack) -> str:
        """The terminal that a stack was last moved by; empty for the empty conversation."""
        symbol = next((s for (_, s), to in self.goto.items() if to == stack[-1]), "")
        while symbol in self.grammar:
            symbol = next(body[-1] for body in self.grammar[symbol] if body)
        return symbol

    def stacks(self) -> list[Stack]:
        """All stacks that can come up, from the empty conversation's on."""
        out, todo = [], [(0,)]
        while todo:
            one = todo.pop(0)
            if one not in out:
                out.append(one)
                todo += [s for t in self.terminals for s in self.shift(one, t)]
                if len(out) > 1000:
                    raise ValueError("the grammar's stacks have no bounded depth")
        return out

    def _check_tops(self) -> None:
        """Stacks with equal tops must allow the same continuations, as one of them stands for all."""
        stacks = self.stacks()
        kind = {s: (self.accepts(s),) for s in stacks}
        for _ in stacks:
            kind = {
                s: (kind[s], *(tuple(sorted({repr(kind[n]) for n in self.shift(s, t)})) for t in self.terminals))
                for s in stacks
            }
            names = {k: i for i, k in enumerate(sorted(set(kind.values()), key=repr))}
            kind = {s: (names[kind[s]],) for s in stacks}
        by_top: dict[int, set] = {}
        for s in stacks:
            by_top.setdefault(s[-1], set()).add(kind[s])
        if any(len(kinds) > 1 for kinds in by_top.values()):
            raise ValueError("stacks with equal tops differ in what may follow")


# How a turn looks to the parser: its role's initial if the grammar has it, and its faults.
def turn_kind(initial: str, must_go: bool, truncated: bool) -> str:
    role = "sua".find(initial) if len(initial) == 1 else -1
    return chr(48 + 4 * (role + 1) + 2 * must_go + truncated)


class Repairer:
    """The parser with edits. Ways are given and returned by their whole stacks."""

    def __init__(self, grammar=CONVERSATION, start: str = "talk", makes: tuple[str, ...] = ("u", "a")):
        self.tables = Tables(grammar, start)
        # Turns that edits can make.
        self.makes = makes
        self.follow = lru_cache(1 << 16)(self._follow)
        self._moves = lru_cache(None)(self._moves_of)

    def entries(self) -> list[Stack]:
        return self.tables.stacks()

    def opened(self, stack: Stack) -> tuple[Way, ...]:
        """The ways before the first turn: what is inserted there counts."""
        return self._least(self._with_inserts([(0, "", stack)]))

    def _least(self, ways: Iterable[Way]) -> tuple[Way, ...]:
        """One way for each stack top: the least by cost, then by audit."""
        best: dict[int, Way] = {}
        for way in ways:
            top = way[2][-1]
            if top not in best or way < best[top]:
                best[top] = way
        return tuple(best.values())

    def _with_inserts(self, ways: list[Way]) -> list[Way]:
        done: dict[Stack, Way] = {}
        todo = list(ways)
        while todo:
            way = todo.pop()
            cost, audit, stack = way
            if stack in done and done[stack] <= way:
                continue
            done[stack] = way
            for role in self.makes:
                for after in self.tables.shift(stack, role):
                    todo.append((cost + COSTS[INSERT], audit + INSERT, after))
        return list(done.values())

    def _moves_of(self, stack: Stack, kind: str) -> tuple[Way, ...]:
        """What a turn and inserts after it can make of a stack."""
        code = ord(kind) - 48
        role, must_go, truncated = code // 4 - 1, code & 2, code & 1
        ways = [(COSTS[DELETE], DELETE, stack)]
        if not must_go:
            more = TRUNCATED_COST if truncated else 0
            if role >= 0:
                ways += [(COSTS[KEEP] + more, KEEP, s) for s in self.tables.shift(stack, "sua"[role])]
            for made in self.makes:
                ways += [(COSTS[RETYPE] + more, RETYPE, s) for s in self.tables.shift(stack, made)]
        return self._least(self._with_inserts(ways))

    def _follow(self, entry: Stack, kinds: str, opens: bool) -> tuple[Way, ...]:
        """The least way to each stack top after some turns, begun with one stack."""
        ways = self.opened(entry) if opens else ((0, "", entry),)
        for kind in kinds:
            ways = self._least(
                (cost + more, audit + letters, after)
                for cost, audit, stack in ways
                for more, letters, after in self._moves(stack, kind)
            )
        return ways

    def ended(self, ways: Iterable[Way]) -> Way:
        return min(way for way in ways if self.tables.accepts(way[2]))


def roles_by_audit(audit: str, initials: list[str], after: str) -> list[tuple[str, int, str]]:
    """(edit, number of the turn or -1, role's initial) of each edit that leaves a turn.

    `after` is the initial of the last turn before these that stays, empty if there is none. Users
    and assistants take turns, so an edit's role follows from its place.
    """
    out, at = [], 0
    for letter in audit:
        number = -1
        if letter != INSERT:
            number, at = at, at + 1
        if letter == DELETE:
            continue
        after = initials[number] if letter == KEEP else ("a" if after == "u" else "u")
        out.append((letter, number, after))
    return out
