"""Centroid clustering against plain integer arithmetic, and the bounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from signalyard.llm import centroids as C


def embeddings(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.selectExpr("*", "1 AS cluster", "'x' AS components") if extra else df


def brute(rows, k, rounds, dimensions, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in first[:k]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        cs = [[sum(x) // n for x in zip(*own)] if (n := len(own := [v for (_, v), a in zip(kept, at) if a == j])) else c for j, c in enumerate(cs)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    per = {j: sum(d for _, a, d in out if a == j) for j in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return [(i, a, d, per[a], sum(per.values()), sha[a]) for i, a, d in out]


def same(df, rows, **how):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted(map(tuple, C.clusters(df, **how).collect()), key=key)
    assert got == sorted(brute(rows, how.get("k", 8), how.get("rounds", 10), how.get("dimensions", 64), how.get("scale", 1024)), key=key)
    return got


@pytest.mark.parametrize("seed,spread,sample", [(1, 0.02, 40), (2, 0.3, 8192), (3, 2.0, 5)])
def test_equals_plain_arithmetic(spark, seed, spread, sample):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, 16))
    rows = [(i, (middles[i % 6] + spread * rng.normal(size=16)).tolist()) for i in range(300)]
    same(embeddings(spark, rows).repartition(5), rows, dimensions=16, sample=sample, pivots=7)


def test_awkward_rows(spark):
    rng = random.Random(3)
    v = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    rows = [(i, v()) for i in range(20)] + [(None, v()), (None, None), (50, None), (51, []), (52, [1.0] * 3), (53, [0.0] * 5),
                                            (54, [1.0, None, 1.0, 1.0]), (55, [1.0, math.nan, 1.0, 1.0]), (56, [math.inf] * 4), (57, [0.0] * 4), (7, [0.5] * 4)]
    rows += [rows[3]] * 3 + [(60, [-0.0004882813, 0.0009765625, -1.0, 0.999999])]
    got = same(embeddings(spark, rows, extra="x"), rows, dimensions=4, k=5, rounds=4)
    assert len(got) == 27


def test_ties_equal_rows_few_rows_and_none(spark):
    line = [(i, [float(x)]) for i, x in enumerate([0, 2, 4, 6, 1, 3, 5, 1, 3])]
    same(embeddings(spark, line), line, dimensions=1, k=4, scale=1)
    equal = [(i, [1.5, 2.5]) for i in range(9)]
    got = same(embeddings(spark, equal), equal, dimensions=2)
    assert {r[1] for r in got} == {0}
    few = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    same(embeddings(spark, few), few, dimensions=2)
    none = C.clusters(embeddings(spark, []))
    assert none.count() == 0 and none.columns == [c.split()[0] for c in C.SCHEMA.split(", ")]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        C.clusters(embeddings(spark, [(1, [1e30, 1.0])]), dimensions=2).collect()


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(0)
    middles = rng.integers(-800, 800, size=(8, 24))
    vectors = middles[rng.integers(0, 8, 2000)] + rng.integers(-60, 60, size=(2000, 24))
    simplex = C.Simplex(np.concatenate([middles, vectors[:50]]), 12)
    apexes, own = simplex.apexes(vectors), simplex.apexes(middles)
    exact = C.squared(vectors, middles)
    may = C.possible(apexes, own)
    assert may[np.arange(len(vectors)), exact.argmin(1)].all()
    assert may.sum() < 1.1 * len(vectors)  # bounds alone decide nearly all
    flat = ((apexes[:, None, :-1] - own[None, :, :-1]) ** 2).sum(2)
    assert (flat + (apexes[:, -1:] - own[:, -1]) ** 2 <= exact * (1 + 1e-9) + 1e-3).all()
    assert (flat + (apexes[:, -1:] + own[:, -1]) ** 2 >= exact * (1 - 1e-9) - 1e-3).all()


def test_equal_candidates_give_one_pivot():
    simplex = C.Simplex(np.full((5, 3), 7), 4)
    assert len(simplex.pivots) == 1 and simplex.apexes(np.array([[7, 7, 10]])).tolist() == [[3.0]]
