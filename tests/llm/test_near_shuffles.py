"""What near-dedup sends through shuffles is in proportion to its input."""

import random

import numpy as np

from signalyard.llm import bagminhash as bm
from tests.llm.test_bagminhash import brute, classes, edit
from tests.llm.util import docs, words


def test_cells_are_written_in_the_narrowest_width_and_read_back():
    rng = np.random.default_rng(4)
    for most, size in ((1, 64), (15, 64), (16, 128), (255, 128), (256, 256), (65_535, 256), (65_536, 512), (2**32 - 1, 512)):
        cells = rng.integers(0, most, bm._CELLS, endpoint=True)
        cells[rng.integers(bm._CELLS)] = most
        raw = bm._write_cells(cells)
        assert len(raw) == size and (bm._read_cells(raw) == cells).all()
    assert (bm._read_cells(bm._write_cells(np.zeros(bm._CELLS, np.int64))) == 0).all()


def test_bands_bags_and_bounds_are_not_shuffled_with_the_buckets(spark, monkeypatch):
    rng = random.Random(11)
    bases = [words(rng, 12 + i % 40) for i in range(500)]
    rows = [(i, bases[i % 500] if i < 500 else edit(rng, bases[i % 500], rng.randrange(0, 3))) for i in range(900)]
    made, real = {}, bm.materialise

    def call(df, name, **options):
        made.setdefault(name, (df.columns, df._jdf.queryExecution().sparkPlan().toString()))
        return real(df, name, **options)
    monkeypatch.setattr(bm, "materialise", call)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        got = classes(bm.near_classes(docs(spark, rows), bands=40, rows=2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute(rows)
    # too many rows to broadcast their numbers: a bitmap tells them
    for name in ("near-firsts", "near-left-bags"):
        assert "BroadcastHashJoin" in made[name][1] and "SortMergeJoin" not in made[name][1], name
    # a row's bounds are held once, not once a bucket
    assert "cells" in made["near-about"][0]
    for name in ("near-open", "near-told", "near-chosen"):
        assert "cells" not in made[name][0] and "cells" not in made[name][1], name


def test_bitmaps_are_made_where_their_rows_meet(spark, monkeypatch):
    plans, real = [], bm.materialise
    monkeypatch.setattr(bm, "materialise", lambda df, name, **o: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name, **o))
    table = spark.range(70_000, numPartitions=1).withColumnRenamed("id", "row")
    wanted = table.filter("row % 7 = 0").unionByName(table.filter("row % 14 = 0")).repartition(5)
    got = sorted(r["row"] for r in bm._only(table, wanted).collect())
    assert got == list(range(0, 70_000, 7))
    below = plans[0].split("Exchange hashpartitioning", 1)[1]
    assert "bitmap_construct_agg" not in below and "bitmap_construct_agg" in plans[0]


def test_small_tables_are_not_written_by_a_task_for_each_shuffle_partition(spark, monkeypatch):
    rng = random.Random(12)
    bases = [words(rng, 12 + i % 30) for i in range(150)]
    rows = [(i, bases[i % 150] if i < 150 else edit(rng, bases[i % 150], rng.randrange(0, 3))) for i in range(300)]
    files, real = {}, bm.materialise

    def call(df, name, **options):
        out = real(df, name, **options)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out
    monkeypatch.setattr(bm, "materialise", call)
    held = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        got = classes(bm.near_classes(docs(spark, rows), bands=40, rows=2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute(rows)
    most = max(2 * spark.sparkContext.defaultParallelism, 96 // bm._WRITTEN_TOGETHER)
    for name in ("near-copies", "near-buckets", "near-members", "near-pairs", "near-labels", "near-told", "near-classes"):
        assert 0 < files[name] <= most, (name, files[name])
