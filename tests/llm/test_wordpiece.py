import random

import public_tokenizers
import pytest

from signalyard.llm.wordpiece import Automaton, count_pieces, read_vocabulary
from tests.llm.util import awkward, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, pieces, longest):
    n = 0
    while word:
        word = word[next(k for k in range(min(longest, len(word)), 0, -1) if word[:k] in pieces):]
        n += 1
    return n


def test_counts_equal_greedy_matching():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b" abc") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(40))}
        machine = Automaton(pieces)
        for _ in range(60):
            word = bytes(rng.choice(b" abcd") for _ in range(rng.randrange(15)))
            assert machine.count(word) == greedy(word, pieces, 7), (word, pieces)


def test_all_bytes_must_be_pieces():
    with pytest.raises(ValueError):
        Automaton({b"a"})


def test_query_equals_greedy_matching(spark):
    pieces = read_vocabulary(PATH)
    longest = max(map(len, pieces))
    rows = awkward()
    got = sorted((tuple(r) for r in count_pieces(docs(spark, rows, n_words="clash"), PATH).collect()), key=str)
    assert got == sorted(((d, len((t or "").split()), sum(greedy(b" " + w.encode(), pieces, longest) for w in (t or "").split()))
                          for d, t in ((r[0], r[1]) for r in rows)), key=str)
    assert count_pieces(docs(spark, []), PATH).count() == 0
