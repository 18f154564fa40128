"""Bucketed upserts with manifests, and the triage of damaged lake files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalyard import schemas as Z
from signalyard.session import scratch_path
from signalyard.sinks import buckets as BK
from signalyard.sinks import tables as TB
from signalyard.sinks import triage as TR

from .conftest import local

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(local(path)) for n in names if n.endswith(".parquet")}


def rows(spark, path):
    return sorted(map(tuple, BK.read(spark, path, SCHEMA).collect()), key=str)


def table(spark, items):
    return spark.createDataFrame(list(items), SCHEMA)


def test_an_upsert_writes_the_buckets_it_touches(spark):
    path = scratch_path(spark, "t-buckets")
    assert rows(spark, path) == [] and BK.newest(spark, path) == (0, None)
    first = {f"k{i}": i for i in range(200)} | {None: -1}
    assert BK.upsert(spark, table(spark, first.items()), path, ["k"], buckets=16) == (1, list(range(16)))
    before = files(path)
    version, touched = BK.upsert(spark, table(spark, [("k7", 70), ("k7", 71)]), path, ["k"])
    assert version == 2 and len(touched) == 1 and len(files(path) - before) == 1
    want = [(k, v) for k, v in first.items() if k != "k7"] + [("k7", 70), ("k7", 71)]
    assert rows(spark, path) == sorted(want, key=str)
    # the old version is still there as it was
    assert sorted(map(tuple, BK.read(spark, path, SCHEMA, version=1).collect()), key=str) == sorted(first.items(), key=str)
    BK.upsert(spark, table(spark, [(None, 5), ("new", 6)]), path, ["k"])
    want = [r for r in want if r[0] is not None] + [(None, 5), ("new", 6)]
    assert rows(spark, path) == sorted(want, key=str)
    assert BK.upsert(spark, table(spark, []), path, ["k"]) == (3, [])
    with pytest.raises(ValueError, match="keys"):
        BK.upsert(spark, table(spark, [("a", 1)]), path, ["v"])


def test_the_second_of_two_writers_finds_its_version_taken(spark, monkeypatch):
    path = scratch_path(spark, "t-writers")
    BK.upsert(spark, table(spark, [("a", 1), ("b", 2)]), path, ["k"], buckets=4)
    real, raced = BK._claim, []

    def slow(spark_, table_, version, manifest):
        if not raced:  # while this writer works, another one commits the same version
            raced.append(version)
            BK.upsert(spark, table(spark, [("a", 10), ("c", 3)]), path, ["k"])
        real(spark_, table_, version, manifest)
    monkeypatch.setattr(BK, "_claim", slow)
    with pytest.raises(BK.WriteConflict):
        BK.upsert(spark, table(spark, [("b", 20)]), path, ["k"], attempts=1)
    assert rows(spark, path) == [("a", 10), ("b", 2), ("c", 3)]
    raced.clear()
    assert BK.upsert(spark, table(spark, [("b", 20)]), path, ["k"])[0] == 4  # made again on the winner's version
    assert rows(spark, path) == [("a", 10), ("b", 20), ("c", 3)] and raced == [3]


def test_an_unfinished_manifest_is_not_read_and_blocks_until_abandoned(spark):
    path = scratch_path(spark, "t-unfinished")
    BK.upsert(spark, table(spark, [("a", 1)]), path, ["k"], buckets=2)
    with open(local(BK._manifest_path(path, 2)), "w") as f:
        f.write('{"n": 2, "keys"')
    assert rows(spark, path) == [("a", 1)]
    with pytest.raises(BK.WriteConflict):
        BK.upsert(spark, table(spark, [("a", 2)]), path, ["k"])
    assert BK.abandon(spark, path) == [2]
    assert BK.upsert(spark, table(spark, [("a", 2)]), path, ["k"])[0] == 2 and rows(spark, path) == [("a", 2)]


def test_triage_names_what_is_wrong_and_scans_the_rest(spark):
    base, src = scratch_path(spark, "t-triage"), Z.SOURCE_NEWSAPI
    assert TR.triage(spark, base, src).count() == 0 and TR.scan_good(spark, base, src).count() == 0
    news = spark.createDataFrame([("2024-01-01", f"text {i}", "2024-01-01", "2024-01-02") for i in range(50)], Z.LAKE_NEWS).repartition(3)
    TB.write_lake(news, base, src)
    folder = local(TB.lake_path(base, src)) + "/month=2024_01"
    good = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
    with open(f"{folder}/{good[0]}", "rb") as f:
        raw = f.read()
    foot = int.from_bytes(raw[-8:-4], "little")
    bad = {"empty": b"", "too short": b"PAR1", "not parquet": b"x" * 100, "truncated": raw[:len(raw) // 2], "broken footer": raw[:-8 - foot] + b"\xff" * 40 + raw[40 - 8 - foot:],
           "broken data": raw[:4] + bytes(60) + raw[64:]}
    for i, content in enumerate(bad.values()):
        with open(f"{folder}/bad-{i}.parquet", "wb") as f:
            f.write(content)
    with open(f"{folder}/readme.md", "w") as f:
        f.write("hello")
    spark.range(3).coalesce(1).write.mode("append").parquet(f"file://{folder}")
    report = TR.triage(spark, base, src)
    reasons = {r["path"].split("/")[-1]: r["reason"] for r in report.collect()}
    assert [reasons[f"bad-{i}.parquet"] for i in range(len(bad))] == list(bad)
    assert reasons["readme.md"] == "another format" and [reasons[n] for n in good] == [None] * len(good)
    assert sum(v == "other columns" for v in reasons.values()) == 1
    got = TR.scan_good(spark, base, src, report)
    assert got.count() == 50 and got.select("month").distinct().collect()[0][0] == "2024_01"
    counts = {r["reason"]: r["files"] for r in TR.report_reasons(report).collect()}
    assert counts["good"] == len(good) and counts["truncated"] == 1
    assert got.filter(F.col("data") == "text 7").count() == 1
