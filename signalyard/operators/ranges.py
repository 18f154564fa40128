"""Interval arithmetic on time ranges: what a log covers, and what it does not.

Ranges of a key are walked in the order of their starts with the latest end so far
(gaps and islands).  A key that holds a third of all ranges is no single task: the
ranges are range-partitioned by (key, start); each partition's latest end per key,
one small row, gives the later partitions what they go on from, as in
``operators.batching``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_reach(ranges: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """``ranges`` (key, start, end) with ``reach``: the latest end among the
    ranges of its key that come before it by (start, end); null for the first."""
    n = partitions or int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = ranges.repartitionByRange(n, key, "start", "end").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    # at most partitions + keys rows
    tops = tagged.groupBy("_pid", key).agg(F.max("end").alias("_top"))
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_pid", F.col(key).alias("_key"), F.max("_top").over(earlier).alias("_before"))
    own = Window.partitionBy("_pid", key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    t = tagged.withColumn("_own", F.max("end").over(own)).alias("t")
    joined = t.join(tops.alias("b"), (F.col("t._pid") == F.col("b._pid")) & F.col(f"t.{key}").eqNullSafe(F.col("b._key")))
    return joined.select(f"t.{key}", "start", "end", F.greatest("_own", "_before").alias("reach"))


def _proper(ranges: DataFrame, key: str) -> DataFrame:
    """Ranges of some length (null ends are left out), each once."""
    return ranges.select(key, "start", "end").filter(F.col("start") < F.col("end")).distinct()


def covered(ranges: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The union of each key's ``ranges`` (key, start, end) as disjoint ranges
    that do not touch."""
    r = _with_reach(_proper(ranges, key), key, partitions)
    first = r.filter(F.col("reach").isNull() | (F.col("reach") < F.col("start")))
    # an island ends where the next one's first range found the reach, the last at the key's latest end
    following = Window.partitionBy(key).orderBy("start")
    last = r.groupBy(F.col(key).alias("_key")).agg(F.max("end").alias("_last"))
    islands = first.select(key, "start", F.lead("reach").over(following).alias("_end"))
    return islands.join(last, F.col(key).eqNullSafe(F.col("_key"))).select(key, "start", F.coalesce("_end", "_last").alias("end"))


def uncovered(ranges: DataFrame, spans: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """What of each key's span (``spans``: one row a key; key, from, to) its
    ``ranges`` do not cover, as (key, start, end): the spans less the ranges.  A
    key without ranges is uncovered as a whole; one without a span has no rows."""
    r = _with_reach(_proper(ranges, key), key, partitions)
    between = r.filter(F.col("reach") < F.col("start")).select(key, F.col("reach").alias("start"), F.col("start").alias("end"))
    ends = r.groupBy(key).agg(F.min("start").alias("_lo"), F.max("end").alias("_hi")).withColumnRenamed(key, "_key")
    about = spans.join(ends, F.col(key).eqNullSafe(F.col("_key")), "left")
    # before the first range, and after the last one; the whole span without any
    around = about.select(key, F.explode(F.array(
        F.struct(F.col("from").alias("start"), F.coalesce("_lo", "to").alias("end")),
        F.struct(F.col("_hi").alias("start"), F.col("to").alias("end")))).alias("_g")).select(key, "_g.start", "_g.end").filter("start is not null")
    s = spans.select(F.col(key).alias("_key"), "from", "to")
    clipped = between.unionByName(around).join(s, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, F.greatest("start", "from").alias("start"), F.least("end", "to").alias("end"))
    return clipped.filter(F.col("start") < F.col("end"))


def in_steps(gaps: DataFrame, step: Column) -> DataFrame:
    """Each range cut into steps from its start on; the last may be shorter."""
    at = F.explode(F.sequence("start", "end", step)).alias("_s")
    keep = [c for c in gaps.columns if c not in ("start", "end")]
    cut = gaps.select(*keep, F.col("end").alias("_end"), at).filter(F.col("_s") < F.col("_end"))
    return cut.select(*keep, F.col("_s").alias("start"), F.least(F.col("_s") + step, F.col("_end")).alias("end"))
