"""Envelope payload handling: PRJ5 (routing), PRJ9 (dispatch), PRJ10
(stamp the step on every item), ARR1 (explode), AGG8 (record count),
SNK2 (projection/cast to the feed's lake schema)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as Z

KINDS = ["news", "candlesticks", "weather"]


def payload_kind(strict: bool = False) -> Column:
    """PRJ9: first present payload key of news, candlesticks, weather
    (present = key given, even with an empty list).  None present -> null,
    or an error with ``strict`` (the reference raises)."""
    k = F.when(F.col("news").isNotNull(), F.lit("news")) \
        .when(F.col("candlesticks").isNotNull(), F.lit("candlesticks")) \
        .when(F.col("weather").isNotNull(), F.lit("weather"))
    if strict:
        k = k.otherwise(F.raise_error(F.lit("Unknown record data. Available: news, candlesticks, weather")))
    return k


def record_count() -> Column:
    """AGG8: number of records carried by the message's payload."""
    k = payload_kind()
    return F.when(k == "news", F.size("news")).when(k == "candlesticks", F.size("candlesticks")) \
        .when(k == "weather", F.size("weather")).otherwise(F.lit(0)).cast("long")


def is_news(c: str = "source") -> Column:
    """PRJ5 (FIX): route news feeds by prefix; the reference's ``!=
    stock`` also let weather through (it then vanished at explode)."""
    return F.col(c).startswith("scraper_news_")


def explode_items(env: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """ARR1 + PRJ10: one row per payload item of messages whose payload is
    ``kind``, stamped with the message's date_start/date_end.  A null or
    empty payload contributes no rows."""
    keep = keep or []
    e = env.filter(payload_kind() == kind)
    return e.select(*keep, F.inline(F.col(kind)), "date_start", "date_end")


def to_lake_rows(items: DataFrame, source: str, keep: list[str] | None = None) -> DataFrame:
    """SNK2: project and cast items to the feed's lake schema (fields not
    in the schema are dropped; envelope candle ``ctm`` millis become a
    timestamp); ``keep`` columns are passed through first."""
    schema = Z.LAKE_SCHEMAS[source]
    cols = [F.col(c) for c in (keep or [])]
    for f in schema.fields:
        if f.name not in items.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "ctm" and items.schema["ctm"].dataType.typeName() == "long":
            cols.append(F.timestamp_millis("ctm").cast(f.dataType).alias("ctm"))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return items.select(*cols)
