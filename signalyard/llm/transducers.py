"""Finite-state transducers as tables, their composition, and the grammar of
aimed, negated and reported insults and threats.

A transducer reads a word's class (or another one's output), writes a symbol and
moves on.  It may have several arcs for one symbol - it guesses, say, that a
target follows - and the guesses that do not come true end in no final state, so
a clause has exactly one path.  ``compose`` feeds one's output to the next: its
states are the pairs of states that can be reached.  ``Table`` holds the composed
machine in numbered states, without those from which no final state can be
reached; a clause is read by looking its words up there."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import NamedTuple

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT = CLASSES = ("other", "target", "negation", "report", "threat", "insult")
CONTEXTS = ("plain", "aimed", "negated", "reported")
#: What a clause's matches are: kind and context.
LABELS = [(kind, context) for kind in (INSULT, THREAT) for context in CONTEXTS]

#: How many words a negation reaches on, and a target to either side.
NEGATION_REACH, TARGET_REACH = 3, 4
#: A run of other words longer than every reach is read as one of this length.
LONGEST_GAP = max(NEGATION_REACH, TARGET_REACH) + 1

State, Symbol = Hashable, Hashable


class Transducer(NamedTuple):
    """``arcs``: of each state and input symbol, the (output, next state) pairs."""
    start: State
    arcs: dict[State, dict[Symbol, list[tuple[Symbol, State]]]]
    final: frozenset


def transducer(start: State, alphabet: Iterable[Symbol], step: Callable[[State, Symbol], list[tuple[Symbol, State]]],
               is_final: Callable[[State], bool] = lambda s: True) -> Transducer:
    """The states that ``step`` reaches from ``start``, as a table."""
    alphabet, arcs, todo = list(alphabet), {}, [start]
    while todo:
        s = todo.pop()
        if s not in arcs:
            arcs[s] = {a: step(s, a) for a in alphabet}
            todo += [n for found in arcs[s].values() for _, n in found]
    return Transducer(start, arcs, frozenset(s for s in arcs if is_final(s)))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Reads what ``a`` reads and writes what ``b`` writes of ``a``'s output."""
    def step(state, symbol):
        s, t = state
        return [(out, (u, v)) for middle, u in a.arcs[s].get(symbol, []) for out, v in b.arcs[t].get(middle, [])]
    symbols = {x for by in a.arcs.values() for x in by}
    return transducer((a.start, b.start), sorted(symbols, key=str), step, lambda s: s[0] in a.final and s[1] in b.final)


def outputs(t: Transducer) -> list[Symbol]:
    return sorted({out for by in t.arcs.values() for found in by.values() for out, _ in found}, key=str)


# -- the grammar: each reads the output of the one before ------------------------

def reported_speech() -> Transducer:
    """After a word of saying, what the clause insults or threatens is reported."""
    def step(reported, c):
        if c == REPORT:
            return [(OTHER, True)]
        return [((c, "reported") if reported and c in (INSULT, THREAT) else c, reported)]
    return transducer(False, CLASSES, step)


def negation(alphabet: list[Symbol]) -> Transducer:
    """The words after a negation are negated, as far as it reaches."""
    def step(left, c):
        if c == NEGATION:
            return [(OTHER, NEGATION_REACH)]
        return [((c, "negated") if left and c in (INSULT, THREAT) else c, max(0, left - 1))]
    return transducer(0, alphabet, step)


def matches(kind: str, alphabet: list[Symbol]) -> Transducer:
    """Words of the ``kind`` that are neither negated nor reported are plain matches."""
    return transducer(0, alphabet, lambda s, c: [((c, "plain") if c == kind else c, s)])


def targets(alphabet: list[Symbol]) -> Transducer:
    """A plain match is aimed if a target stands within reach on either side.

    A state is (words that a target before still reaches, words within which one
    must follow, words among which none may).  Without a target before it, a match
    is read both ways: as aimed, and a target must follow; as plain, and none may."""
    def step(state, c):
        since, need, forbidden = state
        if c == TARGET:
            return [] if forbidden else [(None, (TARGET_REACH, 0, 0))]
        if need == 1:
            return []
        after = (max(0, since - 1), max(0, need - 1), max(0, forbidden - 1))
        if not (isinstance(c, tuple) and c[1] == "plain"):
            return [(c if isinstance(c, tuple) else None, after)]
        aimed, plain = (c[0], "aimed"), c
        if since or need:
            return [(aimed, after)]
        return [(aimed, (0, TARGET_REACH, after[2])), (plain, (0, 0, TARGET_REACH))]
    return transducer((0, 0, 0), alphabet, step, lambda s: s[1] == 0)


def grammar() -> Transducer:
    """Reported speech, negation, insults, threats and targets composed: from word
    classes to LABELS (and None)."""
    t = reported_speech()
    for following in (negation, lambda a: matches(INSULT, a), lambda a: matches(THREAT, a), targets):
        t = compose(t, following(outputs(t)))
    return t


class Table:
    """A transducer from CLASSES to LABELS with numbered states: ``arcs[state][class]``
    is a tuple of (label or -1, next state)."""

    def __init__(self, t: Transducer):
        back: dict[State, set] = {}
        for s, by in t.arcs.items():
            for found in by.values():
                for _, n in found:
                    back.setdefault(n, set()).add(s)
        alive, todo = set(), list(t.final)
        while todo:
            s = todo.pop()
            if s not in alive:
                alive.add(s)
                todo += back.get(s, ())
        number = {s: i for i, s in enumerate([t.start] + [s for s in t.arcs if s in alive and s != t.start])}
        label = {None: -1, **{x: i for i, x in enumerate(LABELS)}}
        self.arcs = [tuple(tuple((label[out], number[n]) for out, n in t.arcs[s][c] if n in alive) for c in CLASSES) for s in number]
        self.final = frozenset(number[s] for s in t.final if s in number)

    def labels(self, clause: Iterable[int]) -> tuple[int, ...]:
        """The labels of a clause's insults and threats, in order; ``clause``: the
        class number of each of its words."""
        paths = {0: ()}
        arcs = self.arcs
        for c in clause:
            following = {}
            for s, said in paths.items():
                for label, n in arcs[s][c]:
                    following[n] = said if label < 0 else (*said, label)
            paths = following
        found, = [said for s, said in paths.items() if s in self.final]
        return found
