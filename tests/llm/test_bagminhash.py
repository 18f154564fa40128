import random
from collections import Counter, defaultdict

import numpy as np

from signalyard.llm import bagminhash as bm
from tests.llm.util import awkward, docs, words


def counts(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    total = a.total() + b.total()
    both = (a & b).total()
    return both / (total - both) if total else 1.0


def brute(rows, threshold=0.8):
    bags = [counts(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= threshold:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sorted(sorted(str(rows[i][0]) for i in g) for g in groups.values())


def classes(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.class_id, r.class_size].append(r)
    assert all(len(g) == size and min(r.doc_id for r in g if r.doc_id is not None) == cid
               for (cid, size), g in groups.items() if cid is not None)
    return sorted(sorted(str(r.doc_id) for r in g) for g in groups.values())


def edit(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(1)
    pairs = []
    for _ in range(12):
        shared = [(f"s{i}", rng.randrange(1, 40)) for i in range(40)]
        a = dict(shared) | {f"a{i}": rng.randrange(1, 9) for i in range(rng.randrange(40))}
        b = {k: max(1, v + rng.randrange(-10, 11)) for k, v in shared} | {f"b{i}": rng.randrange(1, 9) for i in range(rng.randrange(40))}
        pairs.append((a, b))

    def bag(d):
        h, c = bm.bag([])[0], None
        keys = {k: bm.bag([k])[0][0] for k in d}
        order = sorted(d, key=lambda k: int(keys[k]))
        return np.array([keys[k] for k in order], np.uint64), np.array([d[k] for k in order], np.int64)

    m = 4000
    sig = bm.signatures([bag(x) for p in pairs for x in p], m)
    assert np.isfinite(sig).all()
    for i, (a, b) in enumerate(pairs):
        true = jaccard(Counter(a), Counter(b))
        assert bm.similarity(bag(a), bag(b)) == true
        assert abs((sig[2 * i] == sig[2 * i + 1]).mean() - true) < 4 * (0.25 / m) ** 0.5
    # a bag's signature does not depend on what it is made with
    assert (bm.signatures([bag(pairs[0][0])], m)[0] == sig[0]).all()


def test_classes_equal_all_pairs(spark):
    rng = random.Random(6)
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 50_000]
    for g in range(12):
        base = words(rng, rng.randrange(5, 200))
        rows += [(1000 + 100 * g + i, edit(rng, base, rng.randrange(0, 1 + len(base.split()) // 25))) for i in range(rng.randrange(1, 15))]
    chain = words(rng, 300)
    for i in range(12):  # each near the one before, the last far from the first
        rows.append((5000 + i, chain))
        chain = edit(rng, chain, 3)
    rows += [(6000 + i, "line of words that repeats " * (20 + i)) for i in range(8)]
    rng.shuffle(rows)
    got = classes(bm.near_classes(docs(spark, rows, row="clash", key=1, label=2)))
    assert got == brute(rows)


def test_large_buckets_are_settled_without_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(bm, "_FEW", 4)
    rng = random.Random(7)
    base = words(rng, 120)
    # Copies with differing edits: many pairs are below the threshold, most have a path.
    rows = [(i, edit(rng, base, rng.randrange(0, 4))) for i in range(150)]
    got = classes(bm.near_classes(docs(spark, rows), bands=40, rows=2))
    assert got == brute(rows)


def test_empty_and_wordless(spark):
    assert bm.near_classes(docs(spark, [])).count() == 0
    got = bm.near_classes(docs(spark, [(1, None), (2, ""), (3, " \n"), (4, "a")])).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1)]


def test_hashes_are_written_and_read_back():
    h, c = bm.bag("one two three four five six seven seven seven seven seven seven seven".split())
    back, counts = bm._read_bag(bm._write_hashes(h), c.astype("<u4").tobytes())
    assert (back == h).all() and (counts == c).all() and h.max() < 1 << 48
    assert len(bm._write_hashes(h)) == 6 * len(h) and len(bm._read_bag(b"", b"")[0]) == 0
