"""Lake and serving-table sinks: SNK1-SNK5, and the matching scans
SRC1/SRC6/SRC7.

* lake: one folder per feed, ``month=YYYY_MM`` partitions taken from the
  record's own ``date_start`` (the reference used the ingest month, which
  cannot prune by data date), any Spark file format.  Spark's commit
  protocol replaces the reference's five write attempts.
* serving tables: append-only folders (SNK3/SNK5); keyed upsert (SNK4)
  writes a new version folder and readers take the newest complete one,
  so a table is never overwritten while it is read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as Z
from ..functions.dates import day_of, month_key
from ..operators.envelope import to_lake_rows


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def lake_path(base: str, source: str) -> str:
    return os.path.join(base, f"batch_{source}")


def write_lake(rows: DataFrame, base: str, source: str, fmt: str = "parquet",
               extra_partitions: list[str] | None = None) -> None:
    """SNK1 + SNK2: project/cast to the feed's schema, partition by the
    records' month, append.  With ``extra_partitions`` (e.g. the batch id)
    the partitions named by the rows are overwritten instead (dynamic
    partition overwrite), which makes a re-run of the same rows
    idempotent."""
    extra = extra_partitions or []
    out = to_lake_rows(rows, source, keep=extra) \
        .withColumn("month", month_key(day_of("date_start", strict=False)))
    w = out.write.format(fmt)
    if extra:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", *extra)
    else:
        w = w.mode("append").partitionBy("month")
    w.save(lake_path(base, source))


def unreadable_files(spark: SparkSession, base: str, source: str, fmt: str = "parquet") -> list[str]:
    """SRC1: the feed's files that cannot be read (each file's footer is
    opened in a job of one small task per file)."""
    path = lake_path(base, source)
    if not _exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    files, bad = p.getFileSystem(conf).listFiles(p, True), []
    while files.hasNext():
        f = files.next().getPath().toString()
        if not f.endswith(f".{fmt}"):
            continue
        try:
            spark.read.format(fmt).load(f).schema
        except Exception:  # noqa: BLE001 - any reader's own error
            bad.append(f)
    return bad


def scan_lake(spark: SparkSession, base: str, source: str, fmt: str = "parquet",
              hive_layout: bool = True, skip_corrupt: bool = False) -> DataFrame:
    """SRC1: every file of the feed's folder with the declared schema; a
    missing folder is an empty frame with the same schema.  A file that cannot
    be read is an error; ``skip_corrupt`` leaves it out, as the reference does
    - ``unreadable_files`` names what that skips.  ``hive_layout=False`` reads the reference's
    plain ``<YYYY_MM>/<file>`` layout recursively (no partition column)."""
    schema = Z.LAKE_SCHEMAS[source]
    path = lake_path(base, source)
    if hive_layout:
        schema = T.StructType(schema.fields + [T.StructField("month", T.StringType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema).format(fmt).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if not hive_layout:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}")
    return r.load(path).select(*schema.fieldNames())


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK3/SNK5: append rows (one write per frame, not per row); an empty
    frame writes no data files."""
    df.write.mode("append").format(fmt).save(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC6: scan a serving table (missing -> empty with schema); callers
    ``select`` the columns they need and Catalyst prunes the rest."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    out = []
    for name in _list_dirs(spark, path):
        if name.startswith("v=") and _exists(spark, os.path.join(path, name, "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def read_versioned(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Newest complete version of an upserted table (empty if none)."""
    v = _versions(spark, path)
    if not v:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(os.path.join(path, f"v={v[-1]}"))


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> int:
    """SNK4: keyed upsert (replace rows whose key is in ``new``, keep the
    others) written as the next version; returns the version number."""
    current = read_versioned(spark, path, new.schema, fmt)
    merged = current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
    v = (_versions(spark, path) or [0])[-1] + 1
    merged.write.mode("error").format(fmt).save(os.path.join(path, f"v={v}"))
    return v


def lookup(spark: SparkSession, path: str, schema: T.StructType, key_col: str, key: str) -> DataFrame:
    """SRC7: point lookup by key; absent -> no rows (callers coalesce to
    their defaults, see operators.joins.with_defaults)."""
    return read_versioned(spark, path, schema).filter(F.col(key_col) == F.lit(key))
