"""Spreading CPU-heavy row work over the available cores.

Text scoring costs a regex scan of every whole text per row.  A large lake is
read by thousands of scan tasks; a table can also arrive in fewer partitions
than there are cores (Parquet files of one row group each).  ``spread_scan``
deals such a scan over the cores by a content hash, which is deterministic on
retry; a scan of enough partitions is left as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_scan(scan: DataFrame, key_cols: list[str]) -> DataFrame:
    """``scan`` - a table scan with projections, so that its partitions are
    known from the files, without a job - in at least as many partitions as
    there are cores."""
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, F.xxhash64(*[F.col(c) for c in key_cols]))
