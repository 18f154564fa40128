"""ML1 (5-day interval assignment), ML7 (closed-form regression per
interval) and AGG10 (interval loss).

The reference walks intervals in a Python loop, filtering the frame once
per interval.  Membership is a pure function of the row, so here it is
one projection: ``k = floor(datediff(date_start, origin) / 5)``, kept when
``k >= 0``, ``date_end < origin + 5(k+1)`` and the interval starts before
the frame's last ``date_end``.  Empty intervals simply have no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERVAL_DAYS = 5


def assign_intervals(df: DataFrame, origin: Column | str | None = None,
                     days: int = INTERVAL_DAYS, start: str = "date_start",
                     end: str = "date_end") -> DataFrame:
    """ML1: adds ``interval`` (k), ``interval_start`` and ``interval_end``
    (dates); rows that straddle an interval end are dropped, as in the
    reference (PRJ15: ``date_start >= start AND date_end < end``, half-open).  ``origin`` defaults to the frame's ``min(date_start)``
    (AGG6), attached as a scalar subquery."""
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    o = None if origin is None else (F.to_date(F.lit(origin)) if isinstance(origin, str)
                                     else F.to_date(origin))
    # Frame bounds as one scalar subquery attached once (a struct column),
    # so the plan evaluates the min/max aggregate a single time.
    b = df.agg(F.min(s).alias("o"), F.max(e).alias("m"))
    d = df.withColumn("_b", b.select(F.struct("o", "m")).scalar())
    d = d.withColumn("_o", o if o is not None else F.col("_b.o")).withColumn("_last", F.col("_b.m")) \
        .drop("_b")
    k = F.floor(F.datediff(s, F.col("_o")) / days)
    d = d.withColumn("interval", k.cast("long"))
    d = d.withColumn("interval_start", F.date_add(F.col("_o"), (F.col("interval") * days).cast("int"))) \
        .withColumn("interval_end", F.date_add(F.col("interval_start"), days))
    keep = (F.col("interval") >= 0) & (e < F.col("interval_end")) & \
        (F.col("interval_start") < F.col("_last"))
    return d.filter(keep).drop("_o", "_last")


def interval_regression(df: DataFrame, y: str = "close", x: str = "open") -> DataFrame:
    """ML7: least-squares line of ``y`` on ``x`` per interval."""
    return df.groupBy("interval", "interval_start", "interval_end").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def interval_loss(df: DataFrame, pred: str, target: str) -> DataFrame:
    """AGG10: mean squared error per interval."""
    return df.groupBy("interval", "interval_start", "interval_end").agg(
        F.avg((F.col(pred) - F.col(target)) ** 2).alias("loss"),
        F.count(F.lit(1)).alias("n_rows"))
