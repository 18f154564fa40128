"""Speed layer: PIP12 (windowed news/candle join) and PIP13 (stream
scoring), STM1-STM5, JN6, AGG7, PRJ1-PRJ8, SNK6-SNK7.

The same functions build the streaming plan and its batch twin: given a
parsed-envelope DataFrame (static or streaming) they return the joined
windows.  On a stream, each branch carries a watermark on its event time,
the windowed aggregates are stateful (state evicted once a window closes)
and the two are joined on ``window`` in append mode, so a window is
emitted once both sides have closed it.  Window state is bounded by the
input rate times the window length; windows are spread over
``spark.sql.shuffle.partitions`` state partitions by window key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as Z
from ..functions.dates import candle_time
from ..operators.envelope import is_news
from ..session import scratch_path
from ..sources.envelope import parse_envelopes, valid

# --- fixed values: the reference's stream settings --------------------------
WATERMARK = "2 seconds"
WINDOW = "10 seconds"
SLIDE = "3 seconds"
# Our own: the largest span that both divide into.
PANE = "1 second"


def event_time(c: str = "time") -> Column:
    """PRJ4: event time of a message, null when unparseable (Q9 KEEP: a
    bare date is midnight).  Cast to TIMESTAMP, which watermarks need."""
    return F.try_to_timestamp(F.col(c)).cast("timestamp")


# What each side publishes: feeds of the side, payload column, published fields,
# and the item's own date (PRJ6, PRJ7).
_SIDES = {
    "news_list": (is_news, "news", Z.NEWS_ITEM.fieldNames(), lambda i: F.try_to_date(i["date"])),
    "stock_list": (lambda: F.col("source") == Z.SOURCE_STOCK, "candlesticks", Z.CANDLE.fieldNames(),
                   lambda i: candle_time(i["ctmString"])),
}


def side_items(parsed: DataFrame, side: str, watermark: str | None = None,
               at: Column | None = None) -> DataFrame:
    """PRJ5 routing, ARR1, PRJ6/PRJ7, STM1: the side's items as (item,
    item_date, at), ``at`` being the message's event time."""
    feeds, payload, fields, item_date = _SIDES[side]
    items = parsed.filter(feeds()).select(
        (at if at is not None else event_time()).alias("at"), F.inline(F.col(payload).cast(_array(payload))))
    items = items.select("at", F.struct(*fields).alias("item"))
    items = items.withColumn("item_date", item_date(F.col("item")))
    return items.withWatermark("at", watermark) if watermark else items


def _array(payload: str) -> str:
    return Z.ENVELOPE[payload].dataType.simpleString()


def per_window(items: DataFrame, name: str, window: str, slide: str, pane: str) -> DataFrame:
    """STM2 + AGG7: the items of each sliding window.

    Items are gathered once per ``pane`` (a common divisor of window and slide),
    so state and shuffle hold each text once; a window then joins its panes'
    lists.  A window's list is one value, as it is one published message: it is
    bounded by the stream's rate times the window's length."""
    panes = items.groupBy(F.window("at", pane).alias("pane")).agg(F.collect_list("item").alias("items"))
    return panes.groupBy(F.window("pane", window, slide).alias("window")) \
        .agg(F.flatten(F.collect_list("items")).alias(name))


def window_join(parsed: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                watermark: str | None = WATERMARK, pane: str = PANE) -> DataFrame:
    """JN6: the windows that hold items of both sides (STM3: two chained
    aggregations a side and a join, all stateful on a stream)."""
    news, stock = (per_window(side_items(parsed, side, watermark), side, window, slide, pane) for side in _SIDES)
    return news.join(stock, "window")


def to_messages(joined: DataFrame) -> DataFrame:
    """PRJ8/SNK6 payload: one JSON value per joined window (lists sorted
    so the value is deterministic)."""
    return joined.select(F.col("window.start").alias("window_start"),
                         F.to_json(F.struct(F.sort_array("news_list").alias("news_list"),
                                            F.sort_array("stock_list").alias("stock_list")))
                         .alias("value"))


def read_stream(spark: SparkSession, path: str | None = None, fmt: str = "kafka",
                options: dict | None = None, max_files: int | None = None,
                from_start: bool = True) -> DataFrame:
    """SRC2/SRC3: the message stream.  ``fmt="kafka"`` needs the connector
    on the classpath (options: kafka.bootstrap.servers, subscribe,
    ``startingOffsets`` is earliest, or latest without ``from_start``, unless
    given); ``fmt="text"`` reads JSON lines from files (value
    column), which is what the tests use."""
    r = spark.readStream.format(fmt)
    if fmt == "kafka":  # SRC3: a new consumer begins with the oldest message
        options = {"startingOffsets": "earliest" if from_start else "latest"} | (options or {})
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path) if path else r.load()


def start_window_join(spark: SparkSession, source: DataFrame, out_path: str,
                      checkpoint: str | None = None, window: str = WINDOW, slide: str = SLIDE,
                      watermark: str = WATERMARK, pane: str = PANE, trigger: dict | None = None,
                      sink_format: str = "json", sink_options: dict | None = None) -> StreamingQuery:
    """PIP12 end to end: raw stream -> parse -> windowed join -> JSON
    messages appended to ``out_path`` (or a Kafka topic via
    ``sink_format="kafka"``).  Each query has its own checkpoint (STM5
    FIX: the reference gave two queries the same folder)."""
    parsed = valid(parse_envelopes(source, "value"))
    msgs = to_messages(window_join(parsed, window, slide, watermark, pane))
    w = msgs.writeStream.outputMode("append").format(sink_format) \
        .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-window-join"))
    for k, v in (sink_options or {}).items():
        w = w.option(k, v)
    if sink_format != "kafka":
        w = w.option("path", out_path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_features(parsed: DataFrame, means: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """PIP13/SNK7 (FIX): candles as model inputs - open, close, high, low,
    vol from the candle itself (the reference sent the constant 11450.0 as
    close and close as high), the other features from the stored means
    (IMP4), ready for ``models.walk_forward.score``."""
    from ..operators.joins import with_defaults
    c = side_items(parsed, "stock_list", watermark).select(
        "at", "item_date", *[F.col(f"item.{k}").cast("double").alias(k) for k in ("open", "close", "high", "low", "vol")])
    for k in Z.FEATURES[5:]:
        c = c.withColumn(k, F.lit(None).cast("double"))
    return with_defaults(c, means, Z.FEATURES)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """STM4: rows the stateful operators dropped as late in the last
    micro-batch (from the query's progress report)."""
    p = query.lastProgress or {}
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))


def start_stream_predictions(spark: SparkSession, source: DataFrame, means: DataFrame,
                             model: DataFrame, out_path: str, checkpoint: str | None = None,
                             trigger: dict | None = None) -> StreamingQuery:
    """PIP13: candles from the message stream scored with the latest model
    (ML5 in a stream) and appended as (record_date, candle_time, open)
    prediction rows (SNK5) - one append per micro-batch instead of one HTTP call per row."""
    from ..models.walk_forward import score_with
    parsed = valid(parse_envelopes(source, "value"))
    feats = stream_features(parsed, means, watermark=None)
    scored = score_with(feats, model).select(
        F.date_format(F.coalesce("item_date", "at"), "yyyy-MM-dd").alias("record_date"),
        F.coalesce("item_date", "at").cast("timestamp_ntz").alias("candle_time"), F.col("predicted_open").alias("open"))
    w = scored.writeStream.outputMode("append").format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-predict"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
