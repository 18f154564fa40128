"""Shared helpers of the corpus operators."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from signalyard.session import ensure_checkpoint_dir, materialise


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder."""
    return posixpath.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: what follows neither
    recomputes it nor depends on the executors that made it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def parts_for(n: int, per_part: int) -> int:
    """How many parts of about ``per_part`` items hold ``n`` items."""
    return max(1, -(-int(n) // int(per_part)))


#: The columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def numbered(docs: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The ``columns`` of ``docs`` and row, a number of each row, written to the
    shared folder: two scans of ``docs`` may be split differently (the splits
    follow the cores registered at that time), but every reader of the written
    table finds the same numbers.  It holds whole texts, hence the codec."""
    return materialise(docs.select(*columns, F.monotonically_increasing_id().alias("row")), "numbered", compression="zstd")
