"""Interval arithmetic against sets of points."""

import random

import pytest

from signalyard.operators import ranges as R


def points(rows):
    out = {}
    for k, a, b in rows:
        out.setdefault(k, set()).update(range(a, b) if a is not None and b is not None else ())
    return out


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_cover_and_gaps_equal_point_sets(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice(["a", "a", "b", "c", None]), s := rng.randrange(200), s + rng.choice([0, 1, 2, 5, 5, 40, -3])) for _ in range(150)]
    rows += [("d", 5, 9), ("d", 9, 12), ("d", 6, 7), ("e", 3, 3), ("f", None, 4), ("f", 4, None), ("b", 10, 20), ("b", 10, 20)]
    spans = [("a", 20, 150), ("b", 0, 300), (None, -5, 60), ("d", 0, 20), ("e", 1, 4), ("f", 0, 3), ("g", 2, 6), ("h", 6, 6)]
    df = spark.createDataFrame(rows, "k string, start long, end long")
    got = R.covered(df, "k", partitions).collect()
    want = {k: v for k, v in points(rows).items() if v}
    assert points(got) == want
    for k in want:
        own = sorted((r.start, r.end) for r in got if r.k == k)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))  # disjoint, and not touching
    left = R.uncovered(df, spark.createDataFrame(spans, "k string, from long, to long"), "k", partitions).collect()
    assert points(left) == {k: v for k, a, b in spans if (v := set(range(a, b)) - want.get(k, set()))}
    assert len(left) == sum(1 for k, a, b in spans for x in range(a, b)
                            if x not in want.get(k, set()) and (x == a or x - 1 in want.get(k, set())))


def test_steps_are_cut_from_each_start(spark):
    from pyspark.sql import functions as F
    gaps = spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-01-01 10:00:00' AS start, timestamp_ntz'2024-01-01 12:30:00' AS end "
                     "UNION ALL SELECT 'b', timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-01 11:00:00'")
    got = sorted((r.k, r.start.hour, r.end.hour, r.end.minute) for r in R.in_steps(gaps, F.expr("INTERVAL 1 HOUR")).collect())
    assert got == [("a", 10, 11, 0), ("a", 11, 12, 0), ("a", 12, 12, 30), ("b", 10, 11, 0)]


def test_load_gaps_reads_ranges_of_any_step_and_format(spark):
    from signalyard.streaming.cursor import load_gaps
    log = spark.createDataFrame([
        ("a", "2024-01-01", "2024-01-06"), ("a", "2024-01-03", "2024-01-04"), ("a", "2024-01-07T12:00:00", "2024-01-07T12:05:00"),
        ("a", "2024-01-07T12:05:00", "2024-01-08"), ("b", "2024-01-08", "2024-01-09"), ("b", "nonsense", "2024-01-01"), ("x", "2024-01-01", "2024-01-02")],
        "feed string, start_date string, end_date string")
    got = sorted(map(tuple, load_gaps(log, "2024-01-10", feeds=["a", "b", "new"], default_days=1).collect()))
    t = lambda d, h=0: f"2024-01-{d:02d}T{h:02d}:00:00"
    assert got == [("a", t(6), t(7)), ("a", t(7), t(7, 12)), ("a", t(8), t(9)), ("a", t(9), t(10)), ("b", t(9), t(10)), ("new", t(9), t(10))]
