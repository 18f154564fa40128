"""Runs of words against a brute-force search, and the whole operator's rows."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from signalyard.llm import runs as R
from tests.llm.util import awkward, docs


def brute(words, min_exponent=4, min_words=6):
    found = []
    for p in range(1, len(words) // 2 + 1):
        i = p
        while i < len(words):
            start = i - p
            while i < len(words) and words[i] == words[i - p]:
                i += 1
            length = i - start
            if length >= max(min_words, min_exponent * p) and not any(
                    all(words[k] == words[k - q] for k in range(start + q, i)) for q in range(1, p)):
                found.append((start, length, p))
            i += 1 if i - p == start else 0
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w = w[:at] + w[at:at + rng.randrange(1, 8)] * rng.randrange(1, 9) + w[at:]
        yield w


@pytest.mark.parametrize("min_exponent,min_words", [(2, 1), (3, 6), (4, 6)])
def test_runs_equal_brute_force(min_exponent, min_words):
    for w in sequences(min_exponent, 400):
        assert R.runs(w, min_exponent, min_words) == brute(w, min_exponent, min_words), w


def test_squares_have_primitive_roots_and_none_is_missed():
    for w in sequences(9, 200):
        want = {(e, p) for e in range(len(w) + 1) for p in range(1, e // 2 + 1) if w[e - p:e] == w[e - 2 * p:e - p]
                and not any(p % q == 0 and w[e - p:e] == w[e - q:e] * (p // q) for q in range(1, p))}
        assert set(R.square_ends(w)) == want, w


def test_zones_hold_every_run_whole():
    rng = random.Random(4)
    for _ in range(200):
        some = list(sequences(rng.randrange(10**6), rng.randrange(1, 5)))
        flat, doc = np.array(sum(some, []), dtype=np.int64), np.repeat(np.arange(len(some)), [len(w) for w in some])
        begins = np.cumsum([0] + [len(w) for w in some])
        found = [[] for _ in some]
        for lo, hi in R.zones(flat, doc) if len(flat) else []:
            d = int(doc[lo])
            assert doc[hi - 1] == d
            found[d] += [(s + lo - begins[d], n, p) for s, n, p in R.runs(flat[lo:hi].tolist())]
        assert found == [brute(w) for w in some]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n_, p in found for i in range(s + p, s + n_)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n_},{p}\n" for s, n_, p in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_rows_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [r for r in awkward() if r[0] != 5]
    rows += [(1000 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(80)))) for i in range(150)]
    rows += [(2000, "a b a b\x1ca " * 9), (2001, "x " * 5), (2002, "x\t\n\x0b\x0c\r" * 6), (2003, "p q r " * 4 + "z " + "p q r " * 4)]
    got = R.word_runs(docs(spark, rows, n_runs=1, words="w").repartition(3)).select(*COLS).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)


def test_a_long_text_and_an_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(20_000)) + " " + "go on and on " * 40_000
    row, = R.word_runs(docs(spark, [(3, text)])).collect()
    assert zlib.crc32(b"3") % 10 and (row.n_runs, row.start, row.length, row.period) == (1, 20_000, 160_000, 4)
    assert R.word_runs(docs(spark, [])).count() == 0
