"""Daily serving loads: PIP1 (news counts), PIP2 (weather), PIP3 (open).

Each load is ``lake -> record_date -> aggregate -> anti join with the
serving table -> append``.  The anti join makes the load incremental and
idempotent: re-running it appends nothing (KEEP Q5: a day already loaded
is not updated; ``on_conflict="replace"`` replaces it instead)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import record_date
from ..operators.aggregates import count_per_key, daily_weather as agg_daily_weather
from ..operators.joins import replace_or_add, rows_to_add


def tag_and_union(feeds: dict[str, DataFrame], tag_col: str = "source") -> DataFrame:
    """PRJ11 + SET1: literal tag per feed, union by column name (feeds may
    miss columns; those become null)."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def daily_news_counts(feeds: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """PIP1: news items per (record_date, source); record_date from the
    article's own ``date``."""
    news = tag_and_union(feeds).select(record_date("date", strict).alias("record_date"), "source")
    return count_per_key(news, ["record_date", "source"], "count")


def count_news(tagged: DataFrame, strict: bool = True) -> DataFrame:
    """PIP1 on already tagged news rows (``source`` column)."""
    news = tagged.select(record_date("date", strict).alias("record_date"), "source")
    return count_per_key(news, ["record_date", "source"], "count")


def daily_weather(weather: DataFrame, strict: bool = True) -> DataFrame:
    """PIP2: mean temperature, summed rain and sun per record_date (from
    ``date_start``)."""
    w = weather.select(record_date("date_start", strict).alias("record_date"),
                       "temperature", "rain", "sun")
    return agg_daily_weather(w, "record_date")


def daily_open(stock: DataFrame, strict: bool = True) -> DataFrame:
    """PIP3: one (record_date, open) row per candle, no aggregation."""
    return stock.select(record_date("date_start", strict).alias("record_date"),
                        F.col("open").cast("double").alias("open"))


def incremental(new: DataFrame, existing: DataFrame, keys: list[str],
                on_conflict: str = "ignore") -> DataFrame:
    """JN4: the rows to append (``ignore``) or the replacement table
    (``replace``)."""
    if on_conflict == "replace":
        return replace_or_add(new, existing, keys)
    return rows_to_add(new, existing, keys)
