"""SNK4 without rewriting: a keyed table in hash buckets, with a manifest a version.

A row lies in the bucket of its keys' hash.  A version's manifest names, for each
bucket, the folder of files that holds it; an upsert writes the buckets that it
touches to a new folder and names the old folders for all others, so its cost
follows the buckets it touches and never the table.  Readers take the newest
manifest and see one version, whatever is written meanwhile.

A version is claimed by creating its manifest, which must not exist yet (an atomic
create in HDFS and local file systems).  Two writers that began from one version
want the same next number: the second finds it taken, and raises ``WriteConflict``
or begins again from the version that won.  A manifest's last line says that it is
whole; a writer that dies while it writes one leaves the table readable and blocks
further writes until ``abandon`` removes it."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

_DONE = "done"


class WriteConflict(RuntimeError):
    """Another writer has taken the version."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifest_path(table: str, version: int) -> str:
    return os.path.join(table, "manifests", f"{version:012d}.json")


def _read_lines(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        lines = []
        while (line := reader.readLine()) is not None:
            lines.append(line)
        return lines
    finally:
        reader.close()


def _claim(spark: SparkSession, table: str, version: int, manifest: dict) -> None:
    """Creates the version's manifest, or raises ``WriteConflict``."""
    fs, p = _fs(spark, _manifest_path(table, version))
    try:
        out = fs.create(p, False)
    except Exception as e:  # py4j wraps the file system's own error
        if fs.exists(p):
            raise WriteConflict(f"version {version} of {table} is taken") from e
        raise
    try:
        out.write(bytearray(f"{json.dumps(manifest)}\n{_DONE}\n".encode()))
    finally:
        out.close()


def _numbers(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, os.path.join(table, "manifests"))
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json"))


def newest(spark: SparkSession, table: str) -> tuple[int, dict | None]:
    """The newest whole version and its manifest; 0 and None of an empty table."""
    for v in reversed(_numbers(spark, table)):
        lines = _read_lines(spark, _manifest_path(table, v))
        if lines[-1:] == [_DONE]:
            return v, json.loads(lines[0])
    return 0, None


def read(spark: SparkSession, table: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table (its newest version); empty if nothing has been written."""
    manifest = newest(spark, table)[1] if version is None else json.loads(_read_lines(spark, _manifest_path(table, version))[0])
    folders = sorted(set((manifest or {"buckets": {}})["buckets"].values()))
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[os.path.join(table, f) for f in folders])


def upsert(spark: SparkSession, new: DataFrame, table: str, keys: list[str], buckets: int = 64, attempts: int = 3) -> tuple[int, list[int]]:
    """Replaces the rows whose keys are in ``new``, keeps the others; returns the
    version written and the buckets touched.

    ``buckets`` is fixed by the first write.  Null keys are keys like any other.
    If another writer takes the version first, the upsert is made again on its
    result, ``attempts`` times in all."""
    new = materialise(new, "upsert")
    for attempt in range(attempts):
        version, manifest = newest(spark, table)
        try:
            return _upsert_on(spark, new, table, keys, version, manifest or {"n": buckets, "keys": keys, "buckets": {}})
        except WriteConflict:
            if attempt == attempts - 1:
                raise


def _upsert_on(spark: SparkSession, new: DataFrame, table: str, keys: list[str], version: int, manifest: dict) -> tuple[int, list[int]]:
    if manifest["keys"] != keys:
        raise ValueError(f"the table's keys are {manifest['keys']}")
    taken = _numbers(spark, table)
    if taken and taken[-1] > version:
        raise WriteConflict(f"version {taken[-1]} of {table} is being written")
    in_bucket = F.pmod(F.xxhash64(*keys), F.lit(manifest["n"])).cast("int").alias("bucket")
    rows = new.select("*", in_bucket)
    touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())  # at most the number of buckets
    if not touched:
        return version, []
    old = [manifest["buckets"][str(b)] for b in touched if str(b) in manifest["buckets"]]
    if old:
        kept = spark.read.schema(new.schema).parquet(*[os.path.join(table, f) for f in old]).alias("k")
        same = [F.col(f"k.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
        kept = kept.join(new.select(*keys).distinct().alias("n"), same, "left_anti")
        rows = rows.unionByName(kept.select("*", in_bucket))
    folder = os.path.join("data", uuid.uuid4().hex)
    # a bucket may be larger than a task likes: REBALANCE splits it by size
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(os.path.join(table, folder))
    path = lambda b: os.path.join(folder, f"bucket={b}")
    now = {**manifest, "buckets": {**manifest["buckets"], **{str(b): path(b) for b in touched}}}
    _claim(spark, table, version + 1, now)
    return version + 1, touched


def abandon(spark: SparkSession, table: str) -> list[int]:
    """Removes manifests that their writers never finished (call it when no
    writer is at work); the versions removed."""
    gone = []
    for v in _numbers(spark, table):
        if _read_lines(spark, _manifest_path(table, v))[-1:] != [_DONE]:
            fs, p = _fs(spark, _manifest_path(table, v))
            fs.delete(p, False)
            gone.append(v)
    return gone
