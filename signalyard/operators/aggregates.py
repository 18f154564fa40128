"""Aggregations and ordered picks: AGG1-AGG11, SRT1-SRT6.

Every grouped aggregate here is algebraic (count/sum/avg/min/max), so
Spark plans a partial aggregate before the shuffle: a hot key (one day or
one source holding a third of the rows) is pre-combined per task and
reaches the reducer as one row per task.  Top-k picks go through
``TakeOrderedAndProject`` (a per-task top-k, then a k-row merge), never a
full sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round4(c) -> Column:
    """Cross-engine stable rounding for reported doubles (averages of
    two-decimal values often sit on a tie): nudge by 1e-7, round to 4."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-7), 4)


def count_per_key(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """AGG1: row count per key; rows with a null key are dropped (pandas
    ``groupby`` default)."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def daily_weather(df: DataFrame, key: str = "record_date") -> DataFrame:
    """AGG2: mean temperature, rain and sun summed per day; a day whose
    rain (or sun) is all null sums to 0 (pandas ``sum`` of nothing)."""
    return df.dropna(subset=[key]).groupBy(key).agg(
        F.avg("temperature").alias("temperature"),
        F.coalesce(F.sum("rain"), F.lit(0.0)).alias("rain"),
        F.coalesce(F.sum("sun"), F.lit(0.0)).alias("sun"),
    )


def column_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG4: one-row frame of null-ignoring means (timestamps averaged on
    epoch seconds and turned back into a timestamp)."""
    aggs = []
    for c in columns:
        dt = df.schema[c].dataType.typeName()
        if dt in ("timestamp", "timestamp_ntz"):
            # Mean on epoch seconds (smaller sums than millis, so the double
            # sum stays exact for longer), floored to whole seconds.
            m = F.timestamp_seconds(F.floor(F.avg(F.unix_seconds(F.col(c).cast("timestamp")))))
            if dt == "timestamp_ntz":
                m = m.cast("timestamp_ntz")
            aggs.append(m.alias(c))
        else:
            aggs.append(F.avg(F.col(c).cast("double")).alias(c))
    return df.agg(*aggs)


def tail_summary(df: DataFrame, order: list[Column], mean_cols: list[str],
                 median_cols: list[str], n: int = 7) -> DataFrame:
    """AGG3/SRT5 (FIX Q11): mean of ``mean_cols`` and median of
    ``median_cols`` over the last ``n`` rows of an explicit total order
    (``order`` is given ascending; the tail is taken by the reversed
    order through a top-k)."""
    rev = [o.desc_nulls_last() if isinstance(o, Column) else F.col(o).desc_nulls_last()
           for o in order]
    tail = df.orderBy(*rev).limit(n)
    return tail.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in mean_cols],
                    *[F.median(F.col(c).cast("double")).alias(c) for c in median_cols])


def argmax_label(neg, neu, pos) -> Column:
    """AGG9: label of the largest of the three scores; ties resolve to the
    first in the order neg, neu, pos (Python ``max`` over a dict)."""
    n, u, p = (F.col(x) if isinstance(x, str) else x for x in (neg, neu, pos))
    return F.when((n >= u) & (n >= p), F.lit("neg")).when(u >= p, F.lit("neu")).otherwise(F.lit("pos"))


def distinct_days(df: DataFrame, col: str = "date_start") -> DataFrame:
    """AGG11: distinct 'yyyy-MM-dd' values, sorted."""
    return df.select(F.date_format(F.col(col), "yyyy-MM-dd").alias("day")).distinct().orderBy("day")
