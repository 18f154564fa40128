"""Cutting the items of a key into numbered parts of bounded size.

Rows are dealt into tasks by ranges of (key, content hash), so a key that holds a
third of all rows spans many tasks, and each task cuts what it has of a key where
the running size passes the bound.  Equal items have one hash, and a range cannot
divide them: an item whose copies alone exceed a part is first counted (partial
counts are made before the shuffle, so its copies never meet) and goes on as
numbered slices of copies, each a fraction of a part."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_parts(items: DataFrame, keys: list[str], max_bytes: int, item: str = "item", carry: list[str] | None = None) -> DataFrame:
    """``keys``, part, ``items`` (an array of ``item``, sorted), n_items, n_bytes
    (of the items as JSON, with a separator each), and the least value of each
    ``carry`` column.

    A part has at most ``max_bytes`` of items, or one item.  An item of more than
    half of that is a part of its own; the others of a key are cut every half of
    their running size, so that the item on the border still fits.  Part numbers
    of a key ascend, with gaps; a key that spans tasks begins a new part in each."""
    carry = carry or []
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = max(1, max_bytes // 2)
    r = items.select(*keys, *carry, F.col(item).alias("_item"))
    size = F.octet_length(F.to_json(F.struct("_item"))) - F.lit(len('{"_item":}')) + 1
    r = r.withColumn("_bytes", F.greatest(size, F.lit(1))).withColumn("_at", F.xxhash64("_item"))
    # at most (bytes of all items / half) rows
    hot = r.groupBy(*keys, "_at").agg(F.sum("_bytes").alias("_all")).filter(F.col("_all") > half).drop("_all")
    # a key may be null, and takes part like any other value
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*keys, "_at")]
    alone = r.alias("r").join(hot.alias("h"), same, "left_anti")
    copied = r.alias("r").join(hot.alias("h"), same, "left_semi")
    copied = copied.groupBy(*keys, "_item", "_bytes", "_at").agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in carry])
    per = F.greatest(F.lit(1), F.floor(F.lit(half // 4) / F.col("_bytes")))
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / per).cast("long")))
    copied = copied.withColumn("_slice", slices).withColumn("_copies", F.least(per, F.col("_n") - F.col("_slice") * per)) \
        .withColumn("_at", F.xxhash64("_at", "_slice"))  # ranges are of even numbers of rows: deal the heavy ones over all
    columns = [*keys, *carry, "_item", "_at", "_slice", "_copies", "_cost"]
    r = alone.withColumns({"_slice": F.lit(0).cast("long"), "_copies": F.lit(1).cast("long")}).unionByName(copied.drop("_n")) \
        .withColumn("_cost", F.col("_bytes") * F.col("_copies")).select(*columns) \
        .repartitionByRange(n, *keys, "_at", "_slice").withColumn("_task", F.spark_partition_id())
    w = Window.partitionBy("_task", *keys).orderBy("_at", "_cost", "_slice").rowsBetween(Window.unboundedPreceding, 0)
    large = F.col("_cost") > half
    seen = F.sum(F.when(large, 0).otherwise(F.col("_cost"))).over(w)
    own = F.sum(F.when(large, 1).otherwise(0)).over(w)
    # even numbers for slices of small items, odd ones for items of their own
    cut = F.when(large, 2 * own - 1).otherwise(2 * F.floor((seen - F.col("_cost")) / F.lit(half)))
    r = r.withColumn("part", (F.shiftleft(F.col("_task").cast("long"), 32) + cut).cast("long"))
    copies = F.array_repeat("_item", F.col("_copies").cast("int"))
    return r.groupBy("_task", *keys, "part").agg(
        F.sort_array(F.flatten(F.collect_list(copies))).alias("items"), F.sum("_copies").alias("n_items"), F.sum("_cost").alias("n_bytes"),
        *[F.min(c).alias(c) for c in carry]).drop("_task")
