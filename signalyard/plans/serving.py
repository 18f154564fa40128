"""Dashboard queries over the serving tables: PIP7 (predicted vs real),
PIP8 (scraper logs over time), PIP9 (weather and rainfall series),
PIP10 (news series), PIP11 (stats table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import full_outer_split


def predicted_vs_real(predicted: DataFrame, real: DataFrame, per_day: str = "all") -> DataFrame:
    """PIP7: PRJ27 renames, JN5 full outer on record_date, SRT3 order.

    Stored predictions are one row per scored row.  ``per_day="all"`` pairs
    each of a day's predictions with each of its candles, as the reference's
    merge does (rows: predictions x candles of the day); ``per_day="mean"``
    first reduces the predictions to their mean per day, one row per candle.
    An empty side needs no branch because both have declared schemas."""
    p = predicted.select("record_date", F.col("open").alias("predicted_open"))
    if per_day == "mean":
        p = p.groupBy("record_date").agg(F.avg("predicted_open").alias("predicted_open"))
    elif per_day != "all":
        raise ValueError("per_day is 'all' or 'mean'")
    r = real.select("record_date", F.col("open").alias("real_open"))
    j = full_outer_split(r, p, ["record_date"])
    return j.select("record_date", "predicted_open", "real_open").orderBy("record_date")


def logs_over_time(logs: dict[str, DataFrame]) -> DataFrame:
    """PIP8: SET2 union of the scraper logs with a source tag, SRT4 one
    order by (source, start_date) after the union."""
    parts = [df.select("start_date", "record_count", F.lit(tag).alias("source"))
             for tag, df in logs.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.orderBy("source", "start_date")


def weather_series(weather_daily: DataFrame) -> DataFrame:
    """PIP9: SRC6 projection and PRJ25 sunshine seconds -> minutes."""
    return weather_daily.select("record_date", "temperature", "rain",
                                (F.col("sun") / 60).alias("sun_minutes")).orderBy("record_date")


def news_series(news_daily: DataFrame) -> DataFrame:
    """PIP10: the news counts series (record_date, source, count)."""
    return news_daily.select("record_date", "source", "count").orderBy("record_date", "source")


def stats_table(means: DataFrame, key: str = "means") -> DataFrame:
    """PIP11: SRC7 point lookup of the means row by key, PRJ26 unpivot to
    (Parameter, Value).  A missing row gives an empty table."""
    row = means.filter(F.col("_id") == key).drop("_id")
    return row.unpivot([], row.columns, "Parameter", "Value")
