"""Date and time column functions (DT1-DT6, PRJ4, PRJ6-7, PRJ12-13, PRJ20,
PRJ28).  All are Column -> Column built-ins, so they stay inside
whole-stage codegen.  Spark 4 runs with ANSI on: the strict forms raise on
bad input like the reference's ``strptime``/``pd.to_datetime``; the
``try_`` forms give null like ``errors="coerce"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CTM_STRING_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_date(c, strict: bool = True) -> Column:
    """PRJ12/STR3: first ten characters -> date -> 'yyyy-MM-dd' string.
    Strict mode raises on an invalid date (as the reference does)."""
    head = F.substring(_c(c).cast("string"), 1, 10)
    d = F.to_date(head) if strict else F.try_to_date(head)
    return F.date_format(d, "yyyy-MM-dd")


def day_of(c, strict: bool = True) -> Column:
    """PRJ13: day truncation of a date-ish string/timestamp to DATE."""
    head = F.substring(_c(c).cast("string"), 1, 10)
    return F.to_date(head) if strict else F.try_to_date(head)


def coerce_timestamp(c, fmt: str | None = None) -> Column:
    """PRJ4/PRJ20: timestamp or null (never raises)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


def candle_time(c) -> Column:
    """PRJ7 (FIX): parse 'Nov 22, 2024, 1:00:00 PM' labels."""
    return F.try_to_timestamp(_c(c), F.lit(CTM_STRING_FORMAT))


def reformat_broker_time(c) -> Column:
    """DT1: 'Mon d, YYYY, h:mm:ss AM' -> 'YYYY-MM-DDTHH:MM:SSZ' (no zone
    conversion, the 'Z' is a literal as in the reference)."""
    return F.date_format(candle_time(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def shift_days(c, days, fmt: str = "yyyy-MM-dd") -> Column:
    """DT2: add (or with negative ``days`` subtract) whole days to a
    formatted string; the result keeps the input format."""
    ts = F.to_timestamp(_c(c), fmt)
    n = days if isinstance(days, Column) else F.lit(int(days))
    return F.date_format(ts + F.make_dt_interval(days=n), fmt)


def shift_minutes(c, minutes, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """DT3: add minutes to a formatted string; same format out."""
    ts = F.to_timestamp(_c(c), fmt)
    n = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.date_format(ts + F.make_dt_interval(mins=n), fmt)


def days_ago(n: int = 30, as_of: Column | None = None) -> Column:
    """DT4: the backfill default start, ``as_of - n`` days (as_of defaults
    to current_date)."""
    return F.date_sub(as_of if as_of is not None else F.current_date(), n)


def month_key(c) -> Column:
    """DT6: 'yyyy_MM' partition key."""
    return F.date_format(_c(c), "yyyy_MM")


_COMPARATORS = {
    "==": lambda a, b: a == b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
}


def compare_dates(a, b, fmt: str = "yyyy-MM-dd", op: str = "==") -> Column:
    """PRJ28: compare two formatted date strings by an operator string;
    an unknown operator yields null (the reference returns None)."""
    fn = _COMPARATORS.get(op)
    if fn is None:
        return F.lit(None).cast("boolean")
    return fn(F.to_timestamp(_c(a), fmt), F.to_timestamp(_c(b), fmt))


def date_range(start, end) -> Column:
    """DT5: inclusive list of days; start after end raises, as the
    reference's generator does."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    return F.when(s > e, F.raise_error(F.lit("'start_date' must not be after 'end_date'."))) \
        .otherwise(F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
