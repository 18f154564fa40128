"""Near vectors against all pairs in doubles, and the quantisation bounds."""

import math

import numpy as np
import pytest

from signalyard.llm import quantised as Q


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(rows, threshold=0.95):
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or []) for _, v in rows]
    links = [[] for _ in rows]
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and good[i] and good[j] and len(a) == len(b):
                x, y = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
                if a == b or x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i].append(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec_id, len(links[i]), component, vec_id == component))
    return out


def key(r):
    return r[0] is None, r[0] or 0, r[1]


def same(spark, rows, **how):
    got = sorted(map(tuple, Q.near_vectors(embeddings(spark, rows), **how).collect()), key=key)
    assert got == sorted(brute(rows, how.get("threshold", 0.95)), key=key)
    return got


@pytest.mark.parametrize("tile", [37, 4096])
def test_equals_all_pairs(spark, tile):
    rng = np.random.default_rng(tile)
    rows = []
    for group in range(12):
        middle = rng.normal(size=24)
        for noise in (0.0, 0.01, 0.1, 0.2, 0.25, 0.3, 0.33):
            for _ in range(1 + group % 4):
                rows.append((len(rows) * 7 % 1009, ((middle + noise * rng.normal(size=24)) * 10.0 ** rng.integers(-3, 3)).tolist()))
    rows += [(3000 + i, rng.normal(size=24).tolist()) for i in range(60)]
    got = same(spark, rows, tile=tile, pivots=9)
    assert any(r[1] for r in got) and not all(r[1] for r in got)


def test_a_hot_group_and_equal_vectors(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=8)
    rows = [(i, (middle + 0.001 * rng.normal(size=8)).tolist()) for i in range(120)]
    rows += [(1000 + i, middle.tolist()) for i in range(100)] + [(2000 + i, rng.normal(size=8).tolist()) for i in range(40)]
    got = same(spark, rows, tile=50)
    assert sum(r[1] == 219 for r in got) == 220


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (1, v), (2, [-1.0, -2.0, -3.0]), (3, [10.0, 20.0, 30.0]), (None, v), (4, None), (None, None), (5, []), (6, [0.0] * 3), (7, [1.0, None, 3.0]),
            (8, [math.nan] * 3), (9, [math.inf, 0.0, 0.0]), (10, [1.0, 2.0]), (11, [1.0, 2.0, 3.0, 0.0]), (12, [1e300, 2e300, 3e300]), (13, [1e-300, 2e-300, 3e-300]),
            (None, [5.0, -5.0, 1.0]), (14, [0.0, -0.0, 1.0]), (15, [-0.0, 0.0, 1.0]), (16, [2.0])]
    same(spark, rows)
    same(spark, rows, tile=2, pivots=2)
    same(spark, [(4, None), (5, [])])
    none = Q.near_vectors(embeddings(spark, []).selectExpr("*", "1 AS key", "2 AS node", "'x' AS kept"))
    assert none.count() == 0 and none.columns == [c.split()[0] for c in Q.SCHEMA.split(", ")]


def test_products_stay_within_their_bounds():
    rng = np.random.default_rng(0)
    u = Q.unit(rng.normal(size=(400, 64)) * rng.choice([1, 30], size=(400, 64)))
    codes, scales, errors = Q.quantise(u)
    about = (codes.astype(float) @ codes.T.astype(float)) * scales[:, None] * scales
    slack = (1 + errors[:, None]) * errors + errors[:, None]
    assert (np.abs(about - u @ u.T) <= slack).all()


def test_parts_that_need_no_product():
    rng = np.random.default_rng(1)
    def tile(middle, n, first):
        u = Q.unit(middle + 0.001 * rng.normal(size=(n, 16)))
        return Q.Tile(np.arange(first, first + n), np.ones(n, dtype=np.int64), *Q.quantise(u), u)
    near, far = np.eye(16)[0], np.eye(16)[1]
    calls = []
    real = Q._linked
    try:
        Q._linked = lambda *a: calls.append(1) or real(*a)
        a, b, c = tile(near, 700, 0), tile(near, 600, 1000), tile(far, 600, 2000)
        assert Q.links_between(a, b).count.tolist() == [600] * 700 + [700] * 600
        assert Q.links_between(a, None).count.tolist() == [699] * 700
        assert not Q.links_between(a, c).count.any() and not calls
    finally:
        Q._linked = real
