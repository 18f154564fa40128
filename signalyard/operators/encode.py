"""ENC1/ENC2: label encoding = position of the value among the sorted
distinct values (0..n-1), as scikit-learn's ``LabelEncoder`` does.

The distinct set (a partial aggregate: one row per value per task before
the shuffle) is range-sorted and checkpointed to the shared checkpoint
folder, so the numbering is fixed even if a task is recomputed; a value's
code is its partition's offset plus its position within the partition.  The
code table is written, so Spark knows its size when it plans the join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialise


def label_codes(values: DataFrame, col: str, out: str, partitions: int | None = None) -> DataFrame:
    """Code table (col, out) for the distinct non-null values of ``col``."""
    # No predicate on the value column before the distinct: Catalyst would
    # push it below the projection that computes the value and inline the
    # (possibly expensive) expression into the filter.
    spark = values.sparkSession
    ensure_checkpoint_dir(spark)
    distinct = values.select(col).distinct()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = distinct.repartitionByRange(n, F.col(col).asc_nulls_last()) \
        .sortWithinPartitions(F.col(col).asc_nulls_last()) \
        .select(col, F.spark_partition_id().alias("_pid"),
                F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    # one row per partition
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = sizes.select("_pid", "_first", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = ranked.join(offsets, "_pid")
    codes = j.where(F.col(col).isNotNull()).select(
        col, (F.col("_off") + F.col("_mid") - F.col("_first")).cast("long").alias(out))
    return materialise(codes, "label-codes")


def label_encode(df: DataFrame, col: str, out: str | None = None, missing_as: str | None = None,
                 codes_from: DataFrame | None = None) -> DataFrame:
    """ENC1 (``missing_as=None``: nulls stay null) and ENC2
    (``missing_as="nan"``: nulls become that category first, as
    ``astype(str)`` does).  ``codes_from`` fits the codes on another frame
    (e.g. the unfiltered one) and applies them to ``df``."""
    out = out or col

    def prep(d: DataFrame) -> DataFrame:
        if missing_as is None:
            return d
        return d.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit(missing_as)))
    src = prep(df)
    fit = prep(codes_from.select(col)) if codes_from is not None else src
    codes = label_codes(fit, col, "_code").withColumnRenamed(col, "_key")
    res = src.join(codes, F.col(col) == F.col("_key"), "left").drop("_key")
    if out == col:
        return res.drop(col).withColumnRenamed("_code", col)
    return res.withColumnRenamed("_code", out)
