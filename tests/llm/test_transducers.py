"""The composed grammar against the words of its definition, and composition
against paths enumerated by hand."""

import itertools
import random

from signalyard.llm import transducers as X

NUMBER = {c: i for i, c in enumerate(X.CLASSES)}


def by_definition(clause):
    out = []
    for i, c in enumerate(clause):
        if c in (X.INSULT, X.THREAT):
            context = ("reported" if X.REPORT in clause[:i] else "negated" if X.NEGATION in clause[max(0, i - X.NEGATION_REACH):i]
                       else "aimed" if X.TARGET in clause[max(0, i - X.TARGET_REACH):i + X.TARGET_REACH + 1] else "plain")
            out.append(X.LABELS.index((c, context)))
    return tuple(out)


def paths(t, word):
    """All outputs of a transducer for a word, by trying every arc."""
    found = [((), t.start)]
    for c in word:
        found = [((*said, out), n) for said, s in found for out, n in t.arcs[s].get(c, [])]
    return sorted((said for said, s in found if s in t.final), key=str)


def test_the_table_reads_every_clause_as_defined():
    table = X.Table(X.grammar())
    for n in range(5):
        for clause in itertools.product(X.CLASSES, repeat=n):
            assert table.labels([NUMBER[c] for c in clause]) == by_definition(clause)
    rng = random.Random(1)
    for _ in range(20_000):
        clause = [rng.choice(X.CLASSES + (X.OTHER,) * 4) for _ in range(rng.randrange(25))]
        assert table.labels([NUMBER[c] for c in clause]) == by_definition(clause), clause


def test_a_clause_has_one_path_and_composition_is_one_after_the_other():
    rng = random.Random(2)
    whole = X.grammar()
    report = X.reported_speech()
    negated = X.negation(X.outputs(report))
    both = X.compose(report, negated)
    for _ in range(500):
        clause = [rng.choice(X.CLASSES) for _ in range(rng.randrange(9))]
        assert len(paths(whole, clause)) == 1
        first, = paths(report, clause)
        assert paths(both, clause) == paths(negated, first)


def test_targets_guess_and_only_the_right_guess_ends():
    t = X.targets([X.OTHER, X.TARGET, (X.INSULT, "plain")])
    insult = (X.INSULT, "plain")
    assert paths(t, [insult, X.OTHER, X.TARGET]) == [((X.INSULT, "aimed"), None, None)]
    assert paths(t, [insult] + [X.OTHER] * 4 + [X.TARGET]) == [((X.INSULT, "plain"),) + (None,) * 5]
    assert len(t.arcs[t.start][insult]) == 2
