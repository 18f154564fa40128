"""SNK8: envelope writer - wrap a feed's rows into JSON messages
``{source, <kind>: [...], time, date_start, date_end, date_format}``.

One step (date_start, date_end) is one message of the producers.  A step of
many rows is written in several parts, each of at most ``max_bytes`` of
items (or one item), and all parts carry the step and their number, so that
counting messages (WIN1) counts steps whatever the part size is.

A step that holds a third of all rows spans many tasks, and so do the copies of
an item that holds a third of them; equal rows count one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as Z
from ..operators.parts import bounded_parts

KIND_FIELDS = {
    "news": Z.NEWS_ITEM.fieldNames(),
    "candlesticks": Z.CANDLE.fieldNames(),
    "weather": Z.WEATHER_ITEM.fieldNames(),
}
#: Below the usual limit of a Kafka message (1 MB) with its frame.
DEFAULT_MAX_BYTES = 900_000


def _item_struct(kind: str):
    cols = []
    for f in KIND_FIELDS[kind]:
        if kind == "candlesticks" and f == "ctm":
            # Envelope candles carry epoch millis, as the broker API does.
            cols.append(F.unix_millis(F.col("ctm").cast("timestamp")).alias("ctm"))
        else:
            cols.append(F.col(f))
    return F.struct(*cols)


def to_envelopes(rows: DataFrame, source: str, kind: str, date_format: str,
                 max_bytes: int = DEFAULT_MAX_BYTES, time_col: str = "date_start") -> DataFrame:
    """Lake rows of one feed -> one JSON ``value`` per part, with the step and
    part number (``date_start, date_end, part``; numbers ascend, with gaps).

    Items are cut as ``operators.parts.bounded_parts`` does."""
    keys = ["date_start", "date_end"]
    r = rows.select(*keys, F.col(time_col).alias("_time"), _item_struct(kind).alias("item"))
    env = bounded_parts(r, keys, max_bytes, carry=["_time"]).withColumnRenamed("items", kind)
    value = F.to_json(F.struct(
        F.lit(source).alias("source"), F.col(kind), F.col("_time").alias("time"),
        F.col("date_start"), F.col("date_end"), F.lit(date_format).alias("date_format")))
    return env.select(*keys, "part", value.alias("value"))
