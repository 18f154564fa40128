import gzip
import hashlib
import os
import random
import zlib

import pytest

from signalyard.llm import warc
from signalyard.llm.common import shared_path

PAGES = "page_id long, url string, html string, file string"


def pages(spark, n=300, files=5):
    rng = random.Random(n)
    rows = [(i, f"http://x/{i}", "é<p>" * rng.randrange(60), "clash") for i in range(n)]
    rows += [(None, None, None, None), (5, "http://x/5", rows[5][2], "clash"), (5, "http://x/5", rows[5][2], "clash"),
             (1000, "u\r\nWARC/1.0", "x" * 500_000, "clash"), (1001, "", "", "")]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, PAGES).repartition(files, "url")


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_records_are_where_the_manifest_says_and_parse(spark):
    rows, df = pages(spark)
    folder = shared_path(spark, "warc")
    manifest = warc.write_replica(df, folder).collect()
    assert len(manifest) == len(rows) and len({m.file for m in manifest}) > 2
    want = sorted(warc.record(u or "", h or "") for _, u, h, _ in rows)
    got, sizes = [], {}
    for m in manifest:
        data = open(local(warc.file_path(folder, m.file)), "rb").read()
        raw = data[m.offset:m.offset + m.length]
        head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
        length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert rest[length:] == b"\r\n\r\n"
        got.append(raw)
        sizes[m.file] = sizes.get(m.file, 0) + m.length
        assert os.path.getsize(local(warc.file_path(folder, m.file))) >= sizes[m.file]
    assert sorted(got) == want


@pytest.mark.parametrize("files", [1, 4, 40])
def test_damaged_records_are_found(spark, files):
    rows, df = pages(spark, files=files)
    got = warc.audited_copy(df, shared_path(spark, "warc"), 7).collect()
    assert len(got) == len(rows)
    digests = {r[0]: hashlib.sha256(warc.record(r[1] or "", r[2] or "")).hexdigest() for r in rows}
    for r in got:
        assert r.same == (zlib.crc32(str(r.page_id).encode()) % 7 != 0), r
        assert r.sha256 == digests[r.page_id] and (r.other_sha256 is None) == r.same


def test_equal_replicas_have_equal_roots_and_lost_bytes_are_found(spark):
    _, df = pages(spark, 100)
    a, b = shared_path(spark, "warc"), shared_path(spark, "warc")
    manifest = warc.write_replica(df, a)
    warc.copy_replica(manifest, a, b)
    places = warc.ranges(manifest, a, b)
    trees = [warc.tree(warc.range_hashes(places, p)) for p in (a, b)]
    assert warc.root(trees[0][0]) == warc.root(trees[1][0]) and len(trees[0][0]) >= 3
    assert warc.differing(*trees).count() == 0
    # cut the end of one file off, and lose another
    with open(local(warc.file_path(b, 0)), "r+b") as f:
        f.truncate(os.path.getsize(f.name) - 10)
    os.remove(local(warc.file_path(b, 1)))
    places = {(m.file, m.nth) for m in manifest.collect()}
    last = max(n for f, n in places if f == 0)
    records, others = warc.audit(manifest, a, b)
    assert {(r.file, r.nth) for r in records.filter("not same").collect()} == {(0, last)} | {p for p in places if p[0] == 1}
    assert {r.file for r in records.filter("not rest_same").collect()} == {0, 1}
    assert {r.name: r.other_sha256 == "no file" for r in others.collect()} == {"part-00000.warc.gz": False, "part-00001.warc.gz": True}


def test_what_no_record_holds_is_found_on_either_side(spark):
    """Appended bytes, files that one replica has, and records in another order."""
    _, df = pages(spark, 60)
    a, b = shared_path(spark, "warc"), shared_path(spark, "warc")
    manifest = warc.write_replica(df, a)
    warc.copy_replica(manifest, a, b)
    records, others = warc.audit(manifest, a, b)
    assert others.count() == 0 and records.filter("not same or not rest_same").count() == 0
    with open(local(warc.file_path(b, 0)), "ab") as f:
        f.write(b"more")
    with open(local(warc.file_path(a, 2)), "ab") as f:
        f.write(b"x" * 20_000_000)
    for folder, name in ((a, "only-in-a.warc.gz"), (b, "under/only-in-b"), (a, "both"), (b, "both"), (a, "unlike"), (b, "unlike")):
        path = os.path.join(local(folder), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(b"same" if name == "both" else folder.encode())
    places = [m for m in manifest.collect() if m.file == 3]
    first, second = sorted(places, key=lambda m: m.nth)[:2]
    with open(local(warc.file_path(b, 3)), "r+b") as f:
        raw = f.read()
        f.seek(0)
        f.write(raw[first.length:first.length + second.length] + raw[:first.length] + raw[first.length + second.length:])
    records, others = warc.audit(manifest, a, b)
    got = {r.name: (r.sha256 == "no file", r.other_sha256 == "no file") for r in others.collect()}
    assert got == {"part-00000.warc.gz": (False, False), "part-00002.warc.gz": (False, False), "only-in-a.warc.gz": (False, True),
                   "under/only-in-b": (True, False), "unlike": (False, False)}
    assert {(r.file, r.nth) for r in records.filter("not same").collect()} >= {(3, 0), (3, 1)}
    assert {r.file for r in records.filter("not same").collect()} == {3}


def test_empty_table(spark):
    assert warc.audited_copy(spark.createDataFrame([], PAGES), shared_path(spark, "warc")).count() == 0
