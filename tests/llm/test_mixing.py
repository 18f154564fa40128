import random
import re
from collections import defaultdict

import pytest

from signalyard.llm.mixing import mix, schedule
from tests.llm.util import awkward, docs, words


def targets(sizes):
    """Reshare the excess until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def check(spark, rows, block):
    df = docs(spark, rows, row=1, no="clash", size="clash", target=3)
    got = mix(df, block).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2] if len(r) > 2 else "s"] += size(r[1])
    goal = targets(sizes)
    source = {r[0]: r[2] if len(r) > 2 else "s" for r in rows}
    texts = {r[0]: r[1] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size(texts[r.doc_id]) and r.source_size == sizes[s]
        assert r.target == pytest.approx(goal[s], rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 0.5
    # all of a source is in each whole epoch
    for r in got:
        if r.size:
            assert r.taken >= r.size * int((goal[source[r.doc_id]] + 0.5) // sizes[source[r.doc_id]])
    assert sorted((tuple(r)[:5] for r in mix(df, block).collect()), key=str) == sorted((tuple(r)[:5] for r in got), key=str)


@pytest.mark.parametrize("block", [1, 50, 1024])
def test_mix_meets_targets(spark, block):
    rng = random.Random(block)
    rows = [r for r in awkward() if len(r[1] or "") < 100_000]
    rows += [(1000 + i, words(rng, rng.randrange(40)), rng.choice(["hot", "hot", "hot", "a", "é", None, "Z"])) for i in range(300)]
    rows += [(5000, "", "only empty"), (5001, "one", "tiny")]
    check(spark, rows, block)


def test_empty_tables(spark):
    assert mix(docs(spark, [])).count() == 0
    assert [r.taken for r in mix(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_any_run_of_slots_is_near_the_shares(spark):
    src = spark.createDataFrame([(0, 1000, 1000), (1, 5000, 2000), (2, 10, 25)], "no int, source_size long, take long")
    got = {(r.no, r.block): (r.whole, r.part) for r in schedule(src, 10).collect()}
    assert sum(w for (n, _), (w, _) in got.items() if n == 0) == 100
    assert sum(w for (n, _), (w, _) in got.items() if n == 1) == 200 and max(b for n, b in got if n == 1) == 199
    assert got[2, 0] == (2, 5)
