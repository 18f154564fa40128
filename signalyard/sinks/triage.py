"""SRC1: triage of a lake's files before a scan.

Tasks list the folders and check the files: each opens its files' ends and first
pages and says what is wrong with a file, if anything.  The report is a table, and
a scan takes the good files alone; no file is opened by the driver, and none is
read as a whole.  Stores are those that Arrow reads (local, HDFS, S3, GCS)."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as Z
from .tables import _exists, _list_dirs, lake_path

_MAGIC = b"PAR1"
#: Files that one task checks.
FILES_A_TASK = 200
_REPORT = "path string, length long, reason string"


def file_reason(fs: pafs.FileSystem, path: str, columns: list[str]) -> str | None:
    """Why a Parquet file cannot be scanned for ``columns``; None if it can."""
    size = fs.get_file_info(path).size
    if size == 0:
        return "empty"
    if size < 12:
        return "too short"
    with fs.open_input_file(path) as f:
        head = f.read(4)
        f.seek(size - 8)
        tail = f.read(8)
        if head != _MAGIC:
            return "not parquet"
        if tail[4:] != _MAGIC:
            return "truncated"
        if int.from_bytes(tail[:4], "little") > size - 12:
            return "broken footer"
        try:
            file = pq.ParquetFile(f)
            have = set(file.schema_arrow.names)
        except (pa.ArrowInvalid, pa.ArrowException, OSError):
            return "broken footer"
        if not set(columns) <= have:
            return "other columns"
        try:  # the first pages of the first row group
            if file.metadata.num_row_groups:
                next(file.iter_batches(1, row_groups=[0], columns=columns), None)
        except (pa.ArrowInvalid, pa.ArrowException, OSError):
            return "broken data"
    return None


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files under ``folder``, empty ones too, but none that
    Spark hides (names that begin with ``_`` or ``.``).  The driver lists the
    folder's own entries (its months); what lies under each is listed by a task."""
    names = _list_dirs(spark, folder)
    tops = spark.createDataFrame([(folder, False)] + [(f"{folder}/{n}", True) for n in names], "folder string, deep boolean").repartition(len(names) + 1)
    schema = pa.schema([("path", pa.string()), ("length", pa.int64())])

    def run(batches):
        for batch in batches:
            for top, deep in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = _store(top)
                files = [f for f in fs.get_file_info(pafs.FileSelector(at, recursive=deep)) if f.type == pafs.FileType.File]
                paths = [top + f.path[len(at):] for f in files]
                seen = [not any(p.startswith(("_", ".")) for p in path[len(top):].strip("/").split("/")) for path in paths]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, s in zip(paths, seen) if s], pa.string()),
                                                  pa.array([f.size for f, s in zip(files, seen) if s], pa.int64())], schema=schema)
    return tops.mapInArrow(run, "path string, length long")


def triage(spark: SparkSession, base: str, source: str) -> DataFrame:
    """(path, length, reason) of every file of a feed's lake folder, reason null
    for a file that can be scanned; written once."""
    from ..session import materialise
    folder = lake_path(base, source)
    if not _exists(spark, folder):
        return spark.createDataFrame([], _REPORT)
    columns = Z.LAKE_SCHEMAS[source].fieldNames()
    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("reason", pa.string())])

    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            reasons = []
            for path in paths:
                if not path.endswith(".parquet"):
                    reasons.append("another format")
                    continue
                fs, at = _store(path)
                reasons.append(file_reason(fs, at, columns))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(reasons, pa.string())], schema=schema)

    files = materialise(listing(spark, folder), "lake-files")
    tasks = max(1, -(-files.count() // FILES_A_TASK))
    return materialise(files.repartition(tasks).mapInArrow(run, _REPORT), "lake-triage")


def scan_good(spark: SparkSession, base: str, source: str, report: DataFrame | None = None) -> DataFrame:
    """The feed's rows (with ``month``) of the files that the triage found good."""
    report = triage(spark, base, source) if report is None else report
    schema = T.StructType([*Z.LAKE_SCHEMAS[source].fields, T.StructField("month", T.StringType())])
    good = [r[0] for r in report.filter("reason is null").select("path").collect()]  # the list of files that a scan takes
    if not good:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", lake_path(base, source)).parquet(*good)
    return rows.select(*schema.fieldNames())


def report_reasons(report: DataFrame) -> DataFrame:
    """Number of files by reason ("good" for those without)."""
    return report.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("files"))

