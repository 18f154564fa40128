"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the supplied tables (through ``sources.fixtures``) in
full and composes library operators; its DuckDB twin is in
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import round4
from ..session import materialise
from ..sources import fixtures as fx
from .. import schemas as Z
from . import daily

# --- fixed values: the "already loaded" cut-off used by incremental loads
LOADED_BEFORE = "2024-01-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _news_feeds(spark, sf_dir):
    return {tag: fx.news_feed(spark, sf_dir, tag) for tag in fx.NEWS_FEEDS.values()}


@query
def news_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP1: PRJ11, SET1, PRJ12, AGG1."""
    return daily.daily_news_counts(_news_feeds(spark, sf_dir))


@query
def news_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP1 load step: AGG1 then JN4 against the rows loaded before the
    cut-off."""
    counts = daily.daily_news_counts(_news_feeds(spark, sf_dir))
    existing = counts.filter(F.col("record_date") < LOADED_BEFORE)
    return daily.incremental(counts, existing, ["record_date", "source"])


@query
def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP2: PRJ12, AGG2."""
    w = daily.daily_weather(fx.weather_raw(spark, sf_dir))
    return w.select("record_date", round4("temperature").alias("temperature"),
                    round4("rain").alias("rain"), round4("sun").alias("sun"))


@query
def stock_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP3: PRJ12, JN4 (one row per candle of a day not yet loaded)."""
    rows = daily.daily_open(fx.stock_lake(spark, sf_dir))
    existing = rows.filter(F.col("record_date") < LOADED_BEFORE)
    return daily.incremental(rows, existing, ["record_date"])


# --- text jobs ---------------------------------------------------------------
from ..functions import html as H  # noqa: E402
from ..functions.text import clean_text, contains_all  # noqa: E402
from ..operators.encode import label_encode as _label_encode  # noqa: E402
from ..operators.partitioning import spread_scan  # noqa: E402
from ..operators.text_scoring import sentiment_scores, with_language  # noqa: E402
from . import frames  # noqa: E402


def _documents(spark, sf_dir, *cols):
    return spread_scan(fx.table(spark, sf_dir, "documents").select(*cols, "text"), [*cols, "text"])


# --- fixed values: keyword filter of the broker news feed ------------------
KEYWORDS = ["The", "License"]


@query
def clean_text_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 (literal patterns, Q1 KEEP) over every document; digest of
    the cleaned text."""
    d = _documents(spark, sf_dir, "doc_id")
    c = clean_text("text", "literal")
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).cast("long").alias("clean_len"))


@query
def clean_text_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 (intended patterns) over every document."""
    d = _documents(spark, sf_dir, "doc_id")
    c = clean_text("text", "intended")
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).cast("long").alias("clean_len"))


@query
def keyword_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ16/STR2 (intended: keywords lowered too): documents containing
    every keyword."""
    d = fx.table(spark, sf_dir, "documents")
    return d.filter(contains_all("text", KEYWORDS, "intended")).select("doc_id")


@query
def keyword_all_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ16 literal (KEEP): capitalised keywords never match a lowered
    body, lower-case ones do."""
    d = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = [d.filter(contains_all("text", ks, "literal")).select("doc_id", F.lit(" ".join(ks)).alias("keywords"))
             for ks in (KEYWORDS, [k.lower() for k in KEYWORDS])]
    return found[0].unionByName(found[1])


@query
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6: paragraph text of every page."""
    p = spread_scan(fx.table(spark, sf_dir, "pages").select("page_id", "html"), ["page_id", "html"])
    t = H.paragraph_text("html")
    return p.select("page_id", F.size(H.paragraphs("html")).cast("long").alias("n_paragraphs"),
                    F.md5(t).alias("text_md5"), F.length(t).cast("long").alias("text_len"))


@query
def sentiment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT1 + AGG9: token counts, lexicon hits and label per document."""
    d = sentiment_scores(_documents(spark, sf_dir, "doc_id"), "text")
    return d.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
                    F.col("pos_hits").cast("long").alias("pos_hits"),
                    F.col("neg_hits").cast("long").alias("neg_hits"), "sentiment")


@query
def language_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT2: language code per document (null when no profile word)."""
    d = with_language(_documents(spark, sf_dir, "doc_id", "lang"), "text", "language")
    return d.select("doc_id", "lang", "language")


@query
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENC1: sorted distinct languages -> 0..n-1."""
    d = _label_encode(fx.table(spark, sf_dir, "documents").select("doc_id", "lang"),
                      "lang", "lang_code")
    return d.select("doc_id", "lang", F.col("lang_code").cast("long").alias("lang_code"))


@query
def label_encode_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENC2 on the TXT2 guess: a missing guess is the category 'nan'."""
    d = with_language(_documents(spark, sf_dir, "doc_id"), "text", "language")
    # written: the codes and the output both read the guesses
    d = _label_encode(materialise(d.select("doc_id", "language"), "guesses"), "language", "language_code", missing_as="nan")
    return d.select("doc_id", "language", F.col("language_code").cast("long").alias("language_code"))


# --- training frames -------------------------------------------------------
def _feeds(spark, sf_dir):
    # the three news feeds together (SET1), from one scan
    news = spread_scan(fx.news_items(spark, sf_dir).select(*Z.LAKE_NEWS.fieldNames()), Z.LAKE_NEWS.fieldNames())
    return news, fx.weather_lake(spark, sf_dir), fx.stock_lake(spark, sf_dir)


def _report(df: DataFrame) -> DataFrame:
    """Digest of the text column, 4-place doubles, BIGINT integers."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if f.name == "data":
            cols.append(F.md5("data").alias("data_md5"))
        elif t == "double":
            cols.append(round4(f.name).alias(f.name))
        elif t in ("integer", "long", "short"):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


@query
def frame_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP4: STR1, TXT1, TXT2, JN1, JN2, PRJ20-23, ENC1."""
    return _report(frames.training_frame_inner(*_feeds(spark, sf_dir)))


@query
def frame_outer_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP5: PRJ13, JN3 (x2), PRJ21-22, ENC2, AGG4, IMP1."""
    return _report(frames.training_frame_outer(*_feeds(spark, sf_dir)))


# --- fixed values: the historical scoring range (README sample request) ----
RANGE_START, RANGE_END = "2024-01-05", "2024-01-20"


@query
def frame_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4 data steps: PIP5 frame, PRJ14 inclusive range, IMP2."""
    f = frames.frame_in_range(frames.training_frame_outer(*_feeds(spark, sf_dir)),
                              RANGE_START, RANGE_END)
    return _report(f)


@query
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG11 over the ranged frame."""
    f = frames.frame_in_range(frames.training_frame_outer(*_feeds(spark, sf_dir)),
                              RANGE_START, RANGE_END)
    return frames.range_dates(f)


@query
def means_tail7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP6: AGG3 over the inner frame (explicit total order, Q11 FIX)."""
    m = frames.feature_means(frames.training_frame_inner(*_feeds(spark, sf_dir)))
    return _report(m)


@query
def means_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP11: SRC7 point lookup of the 'means' row, PRJ26 unpivot to
    (Parameter, Value)."""
    m = frames.feature_means(frames.training_frame_inner(*_feeds(spark, sf_dir)))
    row = m.filter(F.col("_id") == "means").drop("_id")
    u = row.unpivot([], row.columns, "Parameter", "Value")
    return u.select("Parameter", round4("Value").alias("Value"))


@query
def predict_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN7/IMP4/MAP1: prediction requests built from the candles (open is
    missing on the 0h and 12h candles, weather and text inputs are
    missing throughout) take the stored means, else 0.0."""
    from ..operators.joins import with_defaults
    from ..schemas import FEATURES
    news, weather, stock = _feeds(spark, sf_dir)
    means = frames.feature_means(frames.training_frame_inner(news, weather, stock))
    req = stock.select(
        "ctm", F.when(F.hour("ctm") % 12 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("open")).alias("open"), "close", "high", "low", "vol")
    for c in FEATURES[5:]:
        req = req.withColumn(c, F.lit(None).cast("double"))
    return _report(with_defaults(req, means.filter(F.col("_id") == "means"), FEATURES))


# --- envelopes -------------------------------------------------------------
from ..operators import envelope as ENV  # noqa: E402
from ..operators.batching import count_batches as _count_batches  # noqa: E402
from ..sources.envelope import parse_envelopes, valid  # noqa: E402


def _parsed(spark, sf_dir):
    msgs = fx.envelopes(spark, sf_dir)
    return valid(parse_envelopes(msgs, "value", keep=["part"]))


def _items(spark, sf_dir, kind):
    # only the feeds of that payload are written and parsed
    msgs = fx.envelopes(spark, sf_dir, kinds=[kind])
    return ENV.explode_items(valid(parse_envelopes(msgs, "value")), kind, keep=["source"])


@query
def envelope_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8 -> PRJ1-3 -> PRJ5/PRJ9 -> ARR1 + PRJ10 -> SNK2 for the three
    news feeds (round trip: equals the news lake rows)."""
    it = _items(spark, sf_dir, "news").filter(ENV.is_news())
    return it.select("source", "date", F.md5("data").alias("data_md5"), "date_start", "date_end")


@query
def envelope_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope round trip of the candle feed (ctm millis -> timestamp)."""
    it = ENV.to_lake_rows(_items(spark, sf_dir, "candlesticks"), "scraper_stock_xtb")
    return _report(it)


@query
def envelope_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope round trip of the weather feed."""
    it = ENV.to_lake_rows(_items(spark, sf_dir, "weather"), "scraper_weather_openmeteo")
    return _report(it)


@query
def envelope_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9 dispatch + AGG8 record count per message."""
    # the parts of a step are one message
    return _parsed(spark, sf_dir).groupBy("source", ENV.payload_kind().alias("kind"), "date_start", "date_end") \
        .agg(F.sum(ENV.record_count()).alias("record_count"))


@query
def count_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1 + STR5: count-triggered batches per source (news 5, stock 10,
    weather 1 messages), incomplete tail batches held back."""
    # one row per step: its parts are one message (narrow rows from here on)
    p = _parsed(spark, sf_dir).groupBy("source", "date_start", "date_end").agg(
        F.sum(ENV.record_count()).alias("n_records"))
    b = _count_batches(p, ["date_start", "date_end"])
    return b.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum("n_records").alias("n_records"),
        F.min("date_start").alias("first_start"), F.max("date_start").alias("last_start"))


# --- logs, cursor, serving ------------------------------------------------------
from ..streaming import cursor as CUR  # noqa: E402
from . import serving  # noqa: E402

# --- fixed values: the planning date for the backfill cursor ---------------
AS_OF = "2024-02-02"


def _logs(spark, sf_dir):
    lg = fx.scraper_logs(spark, sf_dir)
    return {f: lg.filter(F.col("feed") == f).drop("feed") for f in fx.LOG_FEEDS.values()}


@query
def logs_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP8: SET2 + SRT4."""
    return serving.logs_over_time(_logs(spark, sf_dir))


@query
def last_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1: last logged end_date per scraper."""
    return CUR.last_cursor(fx.scraper_logs(spark, sf_dir))


@query
def load_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM8 + DT4 + DT5: day windows from the first logged start up to the
    planning date that the log does not hold (holes and the tail)."""
    return CUR.load_windows(fx.scraper_logs(spark, sf_dir), AS_OF, mode="gaps")


@query
def load_windows_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM8 cursor mode: windows after the last logged end."""
    return CUR.load_windows(fx.scraper_logs(spark, sf_dir), AS_OF, mode="tail")


def _real_and_predicted(spark, sf_dir):
    real = daily.daily_open(fx.stock_lake(spark, sf_dir))
    # The stored predictions: a persistence forecast (yesterday's mean
    # open), so the comparison is SQL-checkable; the model's own
    # predictions come from models.walk_forward.
    pred = real.groupBy("record_date").agg(F.avg("open").alias("open")) \
        .select(F.date_format(F.date_add(F.to_date("record_date"), 1), "yyyy-MM-dd").alias("record_date"),
                "open")
    return real, pred


@query
def pred_vs_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP7: PRJ27, JN5, SRT3."""
    real, pred = _real_and_predicted(spark, sf_dir)
    j = serving.predicted_vs_real(pred, real)
    return j.select("record_date", round4("predicted_open").alias("predicted_open"),
                    round4("real_open").alias("real_open"))


@query
def weather_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP9: daily weather with sunshine in minutes (PRJ25)."""
    s = serving.weather_series(daily.daily_weather(fx.weather_raw(spark, sf_dir)))
    return s.select("record_date", *[round4(c).alias(c) for c in ("temperature", "rain", "sun_minutes")])


@query
def news_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP10: news counts series."""
    return serving.news_series(daily.daily_news_counts(_news_feeds(spark, sf_dir)))


# --- weather by region, dates, intervals ----------------------------------------
from ..functions import dates as DT  # noqa: E402
from ..operators import intervals as IV  # noqa: E402
from . import weather as WX  # noqa: E402

# --- fixed values: test location dimension (region, country, rw, cw) -------
# Two countries so the two averaging levels differ (the reference's one
# location cannot tell them apart).
TEST_LOCATIONS = [("A", 0.6, "0", 0.4, 0.0, 0.0), ("A", 0.6, "1", 0.6, 0.0, 0.0),
                  ("B", 0.4, "2", 0.3, 0.0, 0.0), ("B", 0.4, "3", 0.3, 0.0, 0.0),
                  ("B", 0.4, "4", 0.4, 0.0, 0.0)]


@query
def regional_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP15: SRC8, SRT6, MTH1, AGG5."""
    r = WX.regional_weather(fx.region_daily(spark, sf_dir), WX.locations(spark, TEST_LOCATIONS))
    return r.select("day", *[round4(c).alias(c) for c in ("temperature", "rain", "sun")])


@query
def date_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT5 + WIN2: consecutive day pairs over the event span."""
    e = fx.table(spark, sf_dir, "events")
    bounds = e.agg(F.to_date(F.min("ts")).alias("start"), F.to_date(F.max("ts")).alias("end"))
    return WX.day_pairs(None, None, frame=bounds)


@query
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT1, DT2, DT3, DT6, PRJ28, PRJ7 over every candle."""
    s = fx.stock_lake(spark, sf_dir)
    api_time = F.date_format("ctm", "yyyy-MM-dd'T'HH:mm:ss")
    return s.select(
        "ctm", DT.reformat_broker_time("ctmString").alias("broker_time"),
        DT.candle_time("ctmString").cast("timestamp_ntz").alias("candle_time"),
        DT.shift_days("date_start", 1).alias("next_day"),
        DT.shift_days("date_start", -1).alias("prev_day"),
        DT.shift_minutes(api_time, 5).alias("plus_5min"),
        DT.compare_dates("date_start", "date_end", op="<").alias("starts_before_end"),
        DT.compare_dates("date_start", "date_end", op="==").alias("same_day"),
        DT.month_key("ctm").alias("month"))


def _intervals(spark, sf_dir):
    return IV.assign_intervals(fx.stock_lake(spark, sf_dir))


@query
def interval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1: rows per 5-day interval from the first day."""
    return _intervals(spark, sf_dir).groupBy("interval", "interval_start", "interval_end") \
        .agg(F.count(F.lit(1)).alias("n_rows"))


@query
def interval_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7: close-on-open least squares per interval."""
    r = IV.interval_regression(_intervals(spark, sf_dir))
    return r.select("interval", "interval_start", "interval_end", "n_rows",
                    round4("slope").alias("slope"), round4("intercept").alias("intercept"))


@query
def interval_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10: mean squared error of each interval's ML7 line."""
    rows = _intervals(spark, sf_dir)
    coef = IV.interval_regression(rows).select("interval", "slope", "intercept")
    scored = rows.join(coef, "interval") \
        .withColumn("pred", F.col("intercept") + F.col("slope") * F.col("open"))
    r = IV.interval_loss(scored, "pred", "close")
    return r.select("interval", "interval_start", "interval_end", "n_rows", round4("loss").alias("loss"))


# --- speed layer -----------------------------------------------------------------
from ..session import materialise, scratch_path  # noqa: E402
from ..streaming import speed_layer as SL  # noqa: E402

# --- fixed values: stream twin settings (10 s / 3 s scaled to hours) --------
TWIN_WINDOW, TWIN_SLIDE, TWIN_PANE = "10 hours", "3 hours", "1 hour"
#: Files of a micro-batch.
FILES_A_TRIGGER = 2
_LIST_SCHEMA = "struct<news_list: array<struct<data: string, date: string>>, " \
               "stock_list: array<struct<ctm: bigint, ctmString: string, open: double, close: double, " \
               "high: double, low: double, vol: double>>>"


def _window_summary(df: DataFrame, news: str, stock: str, start: str, end: str) -> DataFrame:
    return df.select(
        F.col(start).cast("timestamp_ntz").alias("window_start"),
        F.col(end).cast("timestamp_ntz").alias("window_end"),
        F.size(news).cast("long").alias("n_news"), F.size(stock).cast("long").alias("n_stock"),
        round4(F.aggregate(stock, F.lit(0.0), lambda acc, x: acc + x["open"])).alias("stock_open_sum"))


@query
def window_join_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP12 batch twin: PRJ1-7, ARR1, STM2 sliding windows, AGG7,
    JN6 on the window."""
    parsed = valid(parse_envelopes(fx.event_messages(spark, sf_dir), "value"))
    j = SL.window_join(parsed, TWIN_WINDOW, TWIN_SLIDE, watermark=None, pane=TWIN_PANE)
    return _window_summary(j, "news_list", "stock_list", "window.start", "window.end")


@query
def window_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP12 on a stream: the messages read from files (SRC2 text twin) in several
    micro-batches, STM1 watermarks, STM3 chained stateful operators in
    append mode, STM4 unclosed windows held back, STM5 own checkpoint,
    SNK6 JSON sink.  Returns the sink's windows."""
    src_dir = scratch_path(spark, "stream-in")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    fx.write_in_order(fx.event_messages(spark, sf_dir).select(stamp.alias("date_start"), stamp.alias("date_end"), "value"), src_dir)
    out_dir = scratch_path(spark, "stream-out")
    stream = SL.read_stream(spark, src_dir, fmt="text", max_files=FILES_A_TRIGGER)
    q = SL.start_window_join(spark, stream, out_dir, window=TWIN_WINDOW, slide=TWIN_SLIDE, pane=TWIN_PANE)
    q.awaitTermination()
    out = spark.read.schema("window_start timestamp, value string").json(out_dir)
    lists = out.select("window_start", F.from_json("value", _LIST_SCHEMA).alias("v"))
    lists = lists.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {TWIN_WINDOW}"))
    return _window_summary(lists, "v.news_list", "v.stock_list", "window_start", "window_end")


# --- stateful batching, lake, refresh ------------------------------------------
from .. import schemas as Z  # noqa: E402
from ..sinks import tables as TB  # noqa: E402
from ..streaming import batcher as BT  # noqa: E402
from ..streaming import ordered as OB  # noqa: E402
from ..streaming import refresh as RF  # noqa: E402


@query
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM6 (PIP14): the producers' messages as a stream of bounded
    micro-batches, restarted half way; every N messages of a source are released
    as a batch.  Same result as WIN1 (count_batches)."""
    src = scratch_path(spark, "batcher-in")
    ckpt, out_dir = scratch_path(spark, "ckpt-batcher"), scratch_path(spark, "batcher-out")
    for _ in _halves_arrive(fx.envelopes(spark, sf_dir), src):
        parsed = valid(parse_envelopes(SL.read_stream(spark, src, fmt="text", max_files=FILES_A_TRIGGER), "value"))
        messages = parsed.select("source", "date_start", "date_end", ENV.record_count().alias("n_records"))
        OB.start_batches(spark, messages, out_dir, ckpt, ["date_start", "date_end"], steps=["date_start", "date_end"]).awaitTermination()
    b = spark.read.parquet(out_dir)
    return b.groupBy("source", "batch_id").agg(
        F.count_distinct("date_start", "date_end").alias("n_messages"), F.sum("n_records").alias("n_records"),
        F.min("date_start").alias("first_start"), F.max("date_start").alias("last_start"))


def _halves_arrive(messages, path):
    """Writes the messages before the cut-off day, then the others, as files in
    the order of their steps, and yields after each."""
    messages = materialise(messages.select("date_start", "date_end", "value"), "arriving")
    early, at = F.coalesce(F.col("date_start") < LOADED_BEFORE, F.lit(True)), 0
    for half in (early, ~early):
        at = fx.write_in_order(messages.filter(half), path, at)
        yield


def _write_news_lake(spark, sf_dir, base, day_filter=None):
    for src in (Z.SOURCE_NEWSAPI, Z.SOURCE_WORLDNEWSAPI, Z.SOURCE_NEWS_XTB):
        rows = fx.lake_feeds(spark, sf_dir)[src]
        if day_filter is not None:
            rows = rows.filter(day_filter)
        TB.write_lake(rows, base, src)


def _news_lake(spark, base):
    return {src.split("_")[-1]: TB.scan_lake(spark, base, src)
            for src in (Z.SOURCE_NEWSAPI, Z.SOURCE_WORLDNEWSAPI, Z.SOURCE_NEWS_XTB)}


@query
def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 + SNK2 write of the news feeds (month partitions from the
    records' dates), SRC1 scan back."""
    base = scratch_path(spark, "lake")
    _write_news_lake(spark, sf_dir, base)
    u = frames.tag_news(_news_lake(spark, base))
    return u.select("source", "date", F.md5("data").alias("data_md5"), "date_start", "date_end", "month")


def _refreshed(spark, feeds, read, aggregate, keys, day_col, schema):
    """STM7 + JN4 + SNK3: the lake grows in two steps; a refresh stream
    (restarted from its checkpoint in between) appends the days not yet
    served.  ``feeds``: source -> lake rows."""
    base, serving = scratch_path(spark, "lake"), scratch_path(spark, "serving")
    ckpt = scratch_path(spark, "ckpt-refresh")
    first_half = F.substring("date_start", 1, 10) < F.lit(LOADED_BEFORE)
    for half in (first_half, ~first_half):
        for src, rows in feeds.items():
            TB.write_lake(rows.filter(half), base, src)
        streams = [spark.readStream.schema(_with_month(Z.LAKE_SCHEMAS[src])).parquet(TB.lake_path(base, src))
                   for src in feeds]
        stream = streams[0]
        for s in streams[1:]:
            stream = stream.unionByName(s)
        RF.start_refresh(spark, stream, lambda: read(base), aggregate, serving, keys, day_col, ckpt,
                         {"availableNow": True}).awaitTermination()
    return TB.read_table(spark, serving, schema)


@query
def refresh_news_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM7 + PIP1: the daily news counts kept up to date."""
    feeds = {s: r for s, r in fx.lake_feeds(spark, sf_dir).items() if Z.FEED_KIND[s] == "news"}
    return _refreshed(spark, feeds, lambda base: frames.tag_news(_news_lake(spark, base)), daily.count_news,
                      ["record_date", "source"], "date", Z.SERVING_NEWS)


@query
def refresh_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM7 + PIP2: the daily weather kept up to date."""
    src = Z.SOURCE_WEATHER
    out = _refreshed(spark, {src: fx.lake_feeds(spark, sf_dir)[src]}, lambda base: TB.scan_lake(spark, base, src),
                     daily.daily_weather, ["record_date"], "date_start", Z.SERVING_WEATHER)
    return out.select("record_date", *[round4(c).alias(c) for c in ("temperature", "rain", "sun")])


@query
def refresh_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM7 + PIP3: the daily opening prices kept up to date."""
    src = Z.SOURCE_STOCK
    return _refreshed(spark, {src: fx.lake_feeds(spark, sf_dir)[src]}, lambda base: TB.scan_lake(spark, base, src),
                      daily.daily_open, ["record_date"], "date_start", Z.SERVING_OPEN)


def _with_month(schema):
    from pyspark.sql import types as T
    return T.StructType(schema.fields + [T.StructField("month", T.StringType())])


# --- walk-forward model (one predictor, which SQL can fit; ten in tests/) -------
from ..models import walk_forward as WF  # noqa: E402

ONE_PREDICTOR = {"features": ["close"], "target": "target", "ridge": 0.0}


def _model_frame(spark, sf_dir):
    """The inner frame with the next candle's opening price as target."""
    news, weather, stock = _feeds(spark, sf_dir)
    stock = materialise(stock, "candles")
    return (WF.lead_target(frames.training_frame_inner(news, weather, stock), stock),)


@query
def walk_forward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3 + MTH2-3: fit through each 5-day interval of the inner
    training frame, score that interval's rows."""
    preds, _ = WF.fit_and_score(*_model_frame(spark, sf_dir), **ONE_PREDICTOR)
    return preds.select("record_date", "interval", round4("predicted_open").alias("predicted_open"))


@query
def walk_forward_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML6 log + AGG10: one (the_date, loss) per interval model."""
    _, log = WF.fit_and_score(*_model_frame(spark, sf_dir), **ONE_PREDICTOR)
    return log.select("the_date", round4("loss").alias("loss"))


@query
def predict_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4: ranged, imputed outer frame scored with the latest model."""
    news, weather, stock = _feeds(spark, sf_dir)
    # the model's frame and the ranged one are built on the same scored articles
    news, weather, stock = frames.scored_news(news), materialise(weather, "weather"), materialise(stock, "candles")
    fitted = WF.lead_target(frames.training_frame_inner(news, weather, stock, scored=True), stock)
    model = WF.latest_model(WF.fit_walk_forward(fitted, **ONE_PREDICTOR))
    ranged = frames.frame_in_range(frames.training_frame_outer(news, weather, stock, scored=True),
                                   RANGE_START, RANGE_END)
    s = WF.score_with(ranged, model, ONE_PREDICTOR["features"])
    return s.select(F.date_format("date_start", "yyyy-MM-dd").alias("record_date"),
                    round4("predicted_open").alias("predicted_open"))


@query
def envelope_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP14 end to end: the producers' messages as a stream -> STM6
    count-triggered batches -> PRJ9-10/ARR1 -> SNK2 -> SNK1 one (month,
    batch) partition per completed batch; the lake read back (SRC1) holds
    the records of every completed batch, per step."""
    base = scratch_path(spark, "e2l-lake")
    _arrive_in_lake(spark, fx.envelopes(spark, sf_dir), base)
    return _lake_steps(spark, base)


def _arrive_in_lake(spark, messages, base):
    """PIP14 with a checkpoint of its own, restarted when half has arrived."""
    src, ckpt = scratch_path(spark, "e2l-in"), scratch_path(spark, "ckpt-e2l")
    for _ in _halves_arrive(messages, src):
        stream = SL.read_stream(spark, src, fmt="text", max_files=FILES_A_TRIGGER)
        OB.start_envelope_batches(spark, stream, base, ckpt).awaitTermination()


def _lake_steps(spark, base):
    parts = [TB.scan_lake(spark, base, s).select(F.lit(s).alias("source"), "date_start", "date_end")
             for s in Z.ALL_SOURCES]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("source", "date_start", "date_end").agg(F.count(F.lit(1)).alias("n_rows"))


# --- stream scoring, registry, quarantine, restart -------------------------------
# --- fixed values: a model and means to score the candle stream with
STREAM_MODEL = {"intercept": 1.0, "w_open": 0.5, "w_close": -0.25, "w_temperature": 2.0}


@query
def stream_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP13 + SNK7 + ML5: the candle messages as a stream, scored with a
    model and the stored means (PRJ7, IMP4), appended to a table (SNK5)."""
    src, out = scratch_path(spark, "predict-in"), scratch_path(spark, "predict-out")
    fx.write_stream_input(fx.envelopes(spark, sf_dir, kinds=["candlesticks"]), src)
    values = {f.name: 0.0 for f in WF.COEF_SCHEMA.fields if f.dataType.typeName() == "double"} | STREAM_MODEL
    model = spark.createDataFrame([tuple({"interval": 0, "the_date": "2024-01-06", "n_rows": 1, **values}[c]
                                         for c in WF.COEF_SCHEMA.fieldNames())], WF.COEF_SCHEMA)
    means = spark.createDataFrame([("means", *map(float, range(len(Z.FEATURES))))], Z.MEANS)
    SL.start_stream_predictions(spark, SL.read_stream(spark, src, fmt="text"), means, model, out).awaitTermination()
    r = spark.read.schema("record_date string, candle_time timestamp_ntz, open double").parquet(out)
    return r.select("record_date", "candle_time", round4("open").alias("open"))


@query
def registry_resave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML6 + SRT2 + SNK4: the newest model's date saved twice; the registry
    gives the second model."""
    registry = scratch_path(spark, "registry")
    coef = WF.fit_walk_forward(*_model_frame(spark, sf_dir), **ONE_PREDICTOR)
    WF.save_model(coef, registry)
    WF.save_model(WF.latest_model(coef).withColumn("intercept", F.col("intercept") + 1000), registry)
    m = WF.require_model(spark, registry)
    return m.select("the_date", round4("intercept").alias("intercept"), round4("w_close").alias("w_close"))


@query
def envelope_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ2 + PRJ9 in PIP14: messages that are malformed, of an unknown feed
    or with another feed's payload, by reason; the good ones among them (one
    per other event) go to the lake."""
    base = scratch_path(spark, "bad-lake")
    e = fx.table(spark, sf_dir, "events")
    item = F.array(F.struct(F.col("props").alias("data"), F.lit("2024-01-01").alias("date")))
    day = F.date_format("ts", "yyyy-MM-dd")
    name = F.when(F.col("event_type") == "signup", "scraper_unknown_feed") \
        .when(F.col("event_type") == "click", Z.SOURCE_STOCK).otherwise(Z.SOURCE_NEWSAPI)
    good = F.to_json(F.struct(name.alias("source"), item.alias("news"), day.alias("date_start"), day.alias("date_end"),
                              F.col("event_id").cast("string").alias("time")))
    broken = F.concat(F.lit("no message "), F.col("event_id"))
    value = F.when(F.col("event_type") == "error", broken).otherwise(good)
    _arrive_in_lake(spark, e.select(day.alias("date_start"), day.alias("date_end"), value.alias("value")), base)
    return spark.read.parquet(BT.quarantine_path(base)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def lake_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP14: a second stream with a fresh checkpoint over the same lake adds
    its batches and overwrites none."""
    base = scratch_path(spark, "restart-lake")
    msgs = fx.envelopes(spark, sf_dir, kinds=["weather"])
    early = F.col("date_start") < LOADED_BEFORE
    for half in (early, ~early):
        _arrive_in_lake(spark, msgs.filter(half), base)
    return _lake_steps(spark, base)


# --- single operators --------------------------------------------------------------
from ..functions.text import NEWSAPI_TOO_FAR, REMOVED_URL, api_news_rows  # noqa: E402
from ..sources.envelope import read_envelope_files  # noqa: E402


@query
def recorded_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: recorded weather messages, one JSON document per file."""
    path = scratch_path(spark, "recorded")
    msgs = fx.envelopes(spark, sf_dir, kinds=["weather"])
    msgs.select("date_start", "value").repartition("date_start").write.partitionBy("date_start").text(path)
    env = read_envelope_files(spark, path)
    return _report(ENV.to_lake_rows(ENV.explode_items(env, "weather"), Z.SOURCE_WEATHER))


@query
def envelope_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5 + STR7: messages whose quotes were escaped once too often."""
    n = fx.news_items(spark, sf_dir)
    value = F.to_json(F.struct(
        F.concat(F.lit("scraper_news_"), "feed").alias("source"),
        F.array(F.struct(F.md5("data").alias("data"), "date")).alias("news"), "date_start", "date_end"))
    escaped = n.select(F.replace(value, F.lit('"'), F.lit('\\"')).alias("value"))
    env = valid(parse_envelopes(escaped, "value", repair=True))
    return ENV.explode_items(env, "news", keep=["source"]).select("source", "date", "data", "date_start", "date_end")


@query
def weather_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4: the first days are stored with wrong rain, then all days are
    upserted by day."""
    path = scratch_path(spark, "upsert")
    w = daily.daily_weather(fx.weather_raw(spark, sf_dir))
    TB.upsert(spark, w.filter(F.col("record_date") < LOADED_BEFORE).withColumn("rain", F.lit(-1.0)), path, ["record_date"])
    TB.upsert(spark, w, path, ["record_date"])
    out = TB.read_versioned(spark, path, Z.SERVING_WEATHER)
    return out.select("record_date", *[round4(c).alias(c) for c in ("temperature", "rain", "sun")])


@query
def log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: each feed's log rows appended to one table, read back."""
    path = scratch_path(spark, "log")
    for rows in _logs(spark, sf_dir).values():
        TB.append_table(rows, path)
    return TB.read_table(spark, path, Z.SCRAPER_LOG)


@query
def api_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ17 + PRJ18: API articles without the removed and the empty ones, in
    the lake item shape."""
    n = fx.news_items(spark, sf_dir)
    a = n.select(F.when(F.col("doc_id") % 7 == 0, REMOVED_URL).otherwise(F.concat(F.lit("https://n/"), "doc_id")).alias("url"),
                 F.when(F.col("doc_id") % 11 != 0, F.col("data")).alias("text"), F.col("date").alias("publish_date"))
    return api_news_rows(a).select(F.md5("data").alias("data"), "date")


@query
def load_windows_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM8 with five-minute steps, DT4 for a feed without a log, PRJ19 + STR4
    for windows that the API refused as too far in the past."""
    e = fx.table(spark, sf_dir, "events").withColumn("feed", F.lit("newsapi"))
    fmt, step = "yyyy-MM-dd'T'HH:mm:ss", F.expr("INTERVAL 5 MINUTE")
    at = F.window(F.col("ts").cast("timestamp"), "5 minutes").start.cast("timestamp_ntz")
    e = e.withColumn("at", at)
    text = lambda c: F.date_format(c, fmt)
    log = e.filter("event_type <> 'error'").select("feed", "at").distinct().select(
        "feed", text(F.col("at")).alias("start_date"), text(F.col("at") + step).alias("end_date"))
    w = CUR.load_windows(log, AS_OF, feeds=["newsapi", "backup"], fmt=fmt, step_minutes=5)
    answers = e.filter("event_type = 'error'").select(
        "feed", text(F.col("at")).alias("start_date"), F.lit("error").alias("status"),
        F.when(F.col("event_id") % 2 == 0, NEWSAPI_TOO_FAR + " Upgrade.").otherwise("another error").alias("message"))
    return CUR.skip_refused(w, answers, "newsapi")


@query
def last_cursor_12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1 by parsed date: 12-hour strings, where midnight is written 12.  The
    strings have no half of the day, so an afternoon's hour is taken for the
    morning's that is written alike."""
    fmt = "yyyy-MM-dd hh:mm:ss"
    e = fx.table(spark, sf_dir, "events")
    log = e.select(F.col("event_type").alias("feed"), F.date_format(F.date_trunc("hour", "ts"), fmt).alias("end_date"))
    return CUR.last_cursor(log, fmt=fmt)


# --- fixed values: a word per event type, of each sign
EVENT_WORDS = {"view": "growth", "purchase": "profit", "error": "loss", "signup": "crisis", "click": "market"}


@query
def sentiment_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT1 + AGG9 on texts of all three labels: a user's events of a day as
    words, a text for each thousand of ids, so that no text is unbounded."""
    e = fx.table(spark, sf_dir, "events")
    word = F.create_map(*[F.lit(x) for kv in EVENT_WORDS.items() for x in kv])[F.col("event_type")]
    d = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", F.expr("event_id div 1000").alias("part")) \
        .agg(F.concat_ws(" ", F.sort_array(F.collect_list(word))).alias("text"))
    s = sentiment_scores(d, "text")
    return s.select("day", "user_id", "part", *[F.col(c).cast("long").alias(c) for c in ("n_tokens", "pos_hits", "neg_hits")], "sentiment")
