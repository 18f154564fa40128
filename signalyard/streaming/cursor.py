"""STM8: incremental backfill planner, as a table of load windows.

The producers keep a cursor: start at the last logged ``end_date`` (SRT1)
or 30 days before today (DT4), step one day (or five minutes) while the
step start is before ``as_of``.  Here the plan is a DataFrame: one row
per (feed, window) still to load, so any job can drive an incremental
load from it.  ``mode="tail"`` reproduces the cursor (windows after the
last logged end); ``mode="gaps"`` also finds holes (every window from the
first logged start that the log does not hold).  The number of windows
per feed is the time span divided by the step, independent of data
volume; the anti join against the log shuffles only (feed, start) keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_ago
from ..functions.text import too_far_in_past
from ..operators.ranges import in_steps, uncovered


def last_cursor(log: DataFrame, by: str = "feed", fmt: str | None = None) -> DataFrame:
    """SRT1: latest ``end_date`` per feed: in string order, as the reference
    sorts (fine for ISO formats), or, with ``fmt``, by the parsed date (the
    12-hour feed's strings sort wrongly)."""
    if fmt is None:
        return log.groupBy(by).agg(F.max("end_date").alias("end_date"))
    return log.groupBy(by).agg(F.max_by("end_date", F.to_timestamp_ntz(F.col("end_date"), F.lit(fmt))).alias("end_date"))


def load_windows(log: DataFrame, as_of: str, by: str = "feed", mode: str = "gaps",
                 feeds: list[str] | None = None, default_days: int = 30,
                 fmt: str = "yyyy-MM-dd", step_minutes: int | None = None) -> DataFrame:
    """Windows (feed, start_date, end_date) still to load: of one day, or of
    ``step_minutes``.  ``feeds`` adds feeds that have no log yet; they begin
    ``default_days`` before ``as_of`` (DT4)."""
    unit = "DAY" if step_minutes is None else "MINUTE"
    step = F.expr(f"INTERVAL {1 if step_minutes is None else int(step_minutes)} {unit}")
    stamp = lambda c: F.to_timestamp_ntz(F.col(c), F.lit(fmt))
    asof = F.lit(as_of).cast("timestamp_ntz")
    spans = log.select(by, stamp("start_date").alias("_from"), stamp("end_date").alias("_to"))
    if feeds:
        blank = log.sparkSession.createDataFrame([(f,) for f in feeds], f"{by} string")
        spans = spans.filter(F.col(by).isin(feeds)).unionByName(blank, allowMissingColumns=True)
    b = spans.groupBy(by).agg(F.min("_from").alias("_lo"), F.max("_to").alias("_cursor"))
    first = F.col("_lo") if mode == "gaps" else F.col("_cursor")
    start = F.coalesce(first, days_ago(default_days, F.to_date(asof)).cast("timestamp_ntz"))
    # Steps start at `start`; keep those before as_of, plus the single
    # step at as_of when the cursor is exactly as_of (the loop runs once).
    seq = F.when(start <= asof, F.sequence(start, asof, step))
    w = b.select(by, start.alias("_start"), F.explode(seq).alias("_s"))
    w = w.filter((F.col("_s") < asof) | (F.col("_start") == asof))
    w = w.select(by, F.date_format("_s", fmt).alias("start_date"), F.date_format(F.col("_s") + step, fmt).alias("end_date"))
    return w.join(log.select(by, "start_date").distinct(), [by, "start_date"], "left_anti")


def load_gaps(log: DataFrame, as_of: str, by: str = "feed", feeds: list[str] | None = None, default_days: int = 30,
              formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss"), out_format: str = "yyyy-MM-dd'T'HH:mm:ss",
              step_minutes: int = 24 * 60) -> DataFrame:
    """Windows (feed, start_date, end_date) of at most ``step_minutes`` that the
    log does not cover, from each feed's first logged start to ``as_of``.

    Unlike ``load_windows``, which asks for a log row of a step's very start, the
    log's ranges are taken as ranges: of any length, overlapping, nested or
    touching, and written in any of ``formats`` (others, and ranges without
    length, cover nothing).  Only what is uncovered is cut into steps.  ``feeds``
    adds feeds without a log, from ``default_days`` before ``as_of`` (DT4)."""
    def stamp(c: str):
        text = F.col(c)
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])
    until = F.lit(as_of).cast("timestamp_ntz")
    ranges = log.select(by, stamp("start_date").alias("start"), stamp("end_date").alias("end"))
    known = ranges.filter(F.col("start") < F.col("end"))
    spans = known.groupBy(by).agg(F.min("start").alias("from"))
    if feeds is not None:
        wanted = log.sparkSession.createDataFrame([(f,) for f in feeds], f"{by} string")
        spans = wanted.join(spans, by, "left")
    spans = spans.select(by, F.coalesce("from", days_ago(default_days, F.to_date(until)).cast("timestamp_ntz")).alias("from"), until.alias("to"))
    step = F.make_dt_interval(mins=F.lit(int(step_minutes)))
    cut = in_steps(uncovered(known, spans, by), step)
    return cut.select(by, F.date_format("start", out_format).alias("start_date"), F.date_format("end", out_format).alias("end_date"))


def skip_refused(windows: DataFrame, answers: DataFrame, api: str, by: str = "feed") -> DataFrame:
    """STM8 + PRJ19: the windows left once those that the API refused as too
    far in the past are skipped.  ``answers``: feed, start_date, status,
    message."""
    refused = answers.filter(too_far_in_past("status", "message", api)).select(by, "start_date").distinct()
    return windows.join(refused, [by, "start_date"], "left_anti")
