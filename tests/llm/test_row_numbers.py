"""Decisions reach their texts also if two scans of a table are split differently."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from signalyard.llm import bagminhash, exact_dedup, mixing
from tests.llm.test_bagminhash import brute as near_brute, edit
from tests.llm.test_exact_dedup import brute as exact_brute, got as exact_got
from tests.llm.util import cores_come_and_go, files, words

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def cores(spark):
    spark.conf.set(PARALLELISM, 64)
    yield lambda n: spark.conf.set(PARALLELISM, n)
    spark.conf.unset(PARALLELISM)


def rows_with_copies():
    rng = random.Random(3)
    rows = [(i, words(rng, 40)) for i in range(120)]
    return rows + [(1000 + i, rows[i][1]) for i in range(60)] + [(2000 + i, edit(rng, rows[i][1], 1)) for i in range(60, 90)]


def test_exact_stage(spark, cores):
    rows = rows_with_copies()
    out = cp.drop_copies(spark, files(spark, rows), "")
    cores(1)
    assert Counter(r.text for r in out.collect()) == Counter({t for _, t in rows})


def test_near_stage(spark, cores):
    rows = rows_with_copies()
    out = cp.drop_near_copies(spark, files(spark, rows), "")
    cores(1)
    left = Counter(str(r.doc_id) for r in out.collect())
    groups = near_brute(rows)
    assert sum(left.values()) == len(groups) and all(sum(left[d] for d in g) == 1 for g in groups)


def test_mix_stage(spark, cores):
    rows = [(i, words(random.Random(i), 5 + i % 50), f"s{i % 3}") for i in range(200)]
    table = files(spark, rows)
    expected = Counter({r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(table).collect() if r.taken})
    out = cp.mix_sources(spark, table, "")
    cores(1)
    assert Counter(r.doc_id for r in out.collect()) == +expected


def test_near_classes(spark, cores, monkeypatch):
    rows = rows_with_copies()
    table = files(spark, rows)
    cores_come_and_go(monkeypatch, spark, bagminhash, "materialise")
    found = Counter()
    for r in bagminhash.near_classes(table).filter("kept").collect():
        found[r.class_size] += 1
    assert found == Counter(len(g) for g in near_brute(rows))


def test_exact_groups_of_blocks_under_one_alias(spark, cores, monkeypatch):
    rows = rows_with_copies()
    table = files(spark, rows)
    cores_come_and_go(monkeypatch, spark, exact_dedup, "cut")
    assert exact_got(exact_dedup.exact_groups(table, 64, lambda b: F.lit(1).cast("long"))) == exact_brute(rows)
