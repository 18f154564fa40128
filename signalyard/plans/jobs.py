"""Registered queries of the jobs that keep state from run to run: continued
training, maintained aggregates, bounded streams, gap planning.

They are added to ``catalog.QUERIES``; their DuckDB twins are in
``tools.oracle_jobs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as Z
from ..functions import tagstream as TS
from ..models import resume as RS
from ..operators import trigrams as TG
from ..operators import valence as VL
from ..operators.aggregates import round4
from ..operators.intervals import assign_intervals
from ..operators.partitioning import spread_scan
from ..session import materialise, scratch_path
from ..sinks import buckets as BK
from ..sinks import tables as TB
from ..sinks import triage as TR
from ..sinks.envelope import to_envelopes
from ..sources import fixtures as fx
from ..sources.envelope import parse_envelopes, valid
from ..streaming import cursor as CUR
from ..streaming import deltas as DL
from ..streaming import speed_layer as SL
from ..streaming import windows as WN
from . import daily, frames
from .catalog import AS_OF, FILES_A_TRIGGER, LOADED_BEFORE, QUERIES, TWIN_SLIDE, TWIN_WINDOW, _feeds, _with_month, query

__all__ = ["QUERIES"]


# --- continued training --------------------------------------------------------
def _training_frame(spark, sf_dir):
    """The inner frame with the next candle's opening price (null without one)."""
    news, weather, stock = _feeds(spark, sf_dir)
    stock = materialise(stock, "candles")
    return materialise(RS.with_next_open(frames.training_frame_inner(news, weather, stock), stock), "training-frame")


@query
def walk_forward_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML6: the model of each interval after two runs, the second of which
    goes on from the first one's store; with the number of rows that each read."""
    frame, store = _training_frame(spark, sf_dir), scratch_path(spark, "model-store")
    how = {"features": ["close"], "ridge": 0.0}
    first = RS.train(spark, frame.filter(F.col("date_start") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")), store, **how)
    second = RS.train(spark, frame, store, **how)
    models = RS.load_registry(spark, RS.registry_path(store))
    return models.select("the_date", "n_rows", round4("intercept").alias("intercept"), round4("w_close").alias("w_close"),
                         round4("train_loss").alias("loss"), F.lit(first.rows_read).cast("long").alias("first_rows_read"),
                         F.lit(second.rows_read).cast("long").alias("second_rows_read"))


@query
def walk_forward_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2 + ML3: the models of all ten features, and each row scored with its
    interval's; rows without a next candle are scored too."""
    run = RS.train(spark, _training_frame(spark, sf_dir), scratch_path(spark, "model-store"))
    return run.predictions.select("record_date", "interval", "the_date", round4("predicted_open").alias("predicted_open"))


@query
def walk_forward_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2: what is kept of each interval for later runs: rows, and of each pair
    of the ten features and the target the covariance and the second one's mean."""
    columns = [*Z.FEATURES, "target"]
    m = RS.interval_moments(assign_intervals(_training_frame(spark, sf_dir)), Z.FEATURES, "target")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    # one row an interval
    each = F.explode(F.array(*[F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col("comoments")[at].alias("c"), F.col("means")[j].alias("m"))
                               for at, (i, j) in enumerate(pairs)])).alias("pair")
    return m.select("interval", "n", each).select("interval", "n", "pair.a", "pair.b", round4(F.col("pair.c") / F.col("n")).alias("covariance"),
                                                  round4("pair.m").alias("mean_b"))


# --- maintained daily aggregates ---------------------------------------------------
def _maintained(spark, rows, sources, aggregate):
    """The lake grows lot by lot under the records' steps; the stream over it,
    restarted from its checkpoint after each lot, keeps the store up to date."""
    base, store, ckpt = (scratch_path(spark, n) for n in ("late-lake", "daily-store", "ckpt-daily"))
    rows = materialise(rows, "late-rows")
    for lot in range(fx.LOTS):
        for src in sources:
            own = rows.filter(F.col("source") == src) if "source" in rows.columns else rows
            TB.write_lake(own.filter(F.col("lot") == lot), base, src)
        streams = [spark.readStream.schema(_with_month(Z.LAKE_SCHEMAS[src])).option("maxFilesPerTrigger", 8).parquet(TB.lake_path(base, src))
                   .withColumn("source", F.lit(src.split("_")[-1])) for src in sources]
        stream = streams[0]
        for s in streams[1:]:
            stream = stream.unionByName(s)
        DL.start_maintained(spark, stream, store, aggregate, ckpt, {"availableNow": True}, compact_every=2).awaitTermination()
    return DL.read_daily(spark, store, aggregate)


@query
def refresh_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM7 + PIP1, maintained: articles a day and source, from files that come
    late and under two months."""
    out = _maintained(spark, fx.late_news(spark, sf_dir), [s for s in Z.ALL_SOURCES if Z.FEED_KIND[s] == "news"], DL.NEWS)
    return out.select("record_date", "source", "count", "n_text", round4("mean_chars").alias("mean_chars"))


@query
def refresh_replace_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM7 + PIP2, maintained: a day's weather from rows that come in several lots."""
    out = _maintained(spark, fx.late_weather(spark, sf_dir), [Z.SOURCE_WEATHER], DL.WEATHER)
    return out.select("record_date", *[round4(c).alias(c) for c in ("temperature", "rain", "sun")])


# --- windows in parts, late rows -------------------------------------------------------
# --- fixed values: settings of the window streams; a small bound, so that windows
# have several parts at the test sizes too
PART_BYTES = 20_000
TWIN = WN.Windows(TWIN_WINDOW, TWIN_SLIDE, "2 seconds", PART_BYTES)


@query
def window_join_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP12 + AGG7 + SNK6 in bounded messages: a stream of several micro-batches
    whose joined windows leave in parts, put together again.  One window holds a
    third of all items."""
    src, store, ckpt = (scratch_path(spark, n) for n in ("parts-in", "parts-store", "ckpt-parts"))
    fx.write_in_order(fx.hot_hour_messages(spark, sf_dir), src)
    stream = SL.read_stream(spark, src, fmt="text", max_files=FILES_A_TRIGGER)
    WN.start_windows(spark, stream, store, ckpt, TWIN).awaitTermination()
    parts, contents = WN.read_parts(spark, store)
    each = parts.select("*", F.size("items").alias("listed")).groupBy("window_start", "window_end", "side").agg(
        F.sum("listed").alias("n"), F.count(F.lit(1)).alias("n_parts"),
        # an item of its own may be larger
        F.max(F.when(F.col("listed") > 1, F.col("n_bytes")).otherwise(0)).alias("largest"),
        F.sum(F.aggregate(F.when(F.col("side") == "stock_list", F.col("items")).otherwise(F.array().cast("array<string>")), F.lit(0.0),
                          lambda s, i: s + F.get_json_object(i, "$.open").cast("double"))).alias("open_sum"))
    told = each.join(contents.select("window_start", "side", F.col("n_parts").alias("told_parts"), F.col("n_items").alias("told_items")), ["window_start", "side"])
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return told.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end")).agg(
        of("news_list", "n").alias("n_news"), of("stock_list", "n").alias("n_stock"), round4(of("stock_list", "open_sum")).alias("stock_open_sum"),
        (F.max("largest") <= PART_BYTES).alias("within_bound"),
        F.min((F.col("n_parts") == F.col("told_parts")) & (F.col("n") == F.col("told_items"))).alias("as_told"))


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM4: windows and sides of a stream of four micro-batches, with the rows
    that came in time, those that came behind the watermark, and all of them in
    the corrected windows."""
    src, store, ckpt = (scratch_path(spark, n) for n in ("late-in", "late-store", "ckpt-late"))
    messages = materialise(fx.late_messages(spark, sf_dir), "late-messages")
    for lot in range(fx.LATE_LOTS):
        fx.write_stream_input(messages.filter(F.col("lot") == lot), src)
        WN.start_windows(spark, SL.read_stream(spark, src, fmt="text"), store, ckpt, TWIN).awaitTermination()
    stored = WN.in_windows(WN.read_items(spark, store), TWIN).groupBy("window_start", "side").agg(F.count(F.lit(1)).alias("n"))
    late = WN.read_late(spark, store).groupBy("window_start", "side").agg(
        F.count(F.lit(1)).alias("late"), F.count_if("stored").alias("late_stored"))
    _, contents = WN.corrected(spark, store, TWIN)
    all_ = stored.join(late, ["window_start", "side"], "full").join(contents.select("window_start", "side", "n_items"), ["window_start", "side"], "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    return all_.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "side", (z("n") - z("late_stored")).alias("n_in_time"),
                       z("late").alias("n_late"), F.col("n_items").alias("n_corrected"))


# --- gaps of a log -------------------------------------------------------------------
@query
def load_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM8: what a log of mixed, overlapping, nested and touching ranges leaves
    to load, in windows of at most a day."""
    return CUR.load_gaps(fx.mixed_logs(spark, sf_dir), AS_OF)


# --- text with depth ------------------------------------------------------------------
@query
def page_paragraphs_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6: paragraph text of every page by the tag-stream machine."""
    p = spread_scan(fx.table(spark, sf_dir, "pages").select("page_id", "html"), ["page_id", "html"])
    p = p.select("page_id", TS.paragraphs("html").alias("texts"))
    joined = F.when(F.size("texts") > 0, F.array_join("texts", "\n")).otherwise(F.lit(TS.NO_CONTENT))
    return p.select("page_id", F.size("texts").cast("long").alias("n_paragraphs"), F.md5(joined).alias("text_md5"), F.length(joined).cast("long").alias("text_len"))


# --- fixed values: a quarter of the documents, by a hash of their id, is not learned from
HELD_OUT_OF, HELD_OUT = 4, 2


@query
def language_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT2: language of every document by trigram profiles learned from the
    documents outside the held-out fold."""
    d = fx.table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("long") % HELD_OUT_OF == HELD_OUT).alias("held_out"))
    d = spread_scan(d, ["text", "doc_id"])
    profile = TG.learn(d.filter(~F.col("held_out")))
    return TG.score(d, profile, "doc_id").join(d.select("doc_id", "lang", "held_out"), "doc_id").select(
        "doc_id", "lang", "held_out", "n_trigrams", "language")


@query
def sentiment_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT1: shares and label of every document, valences under negation,
    intensity and contrast."""
    d = VL.with_valence(spread_scan(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), ["text", "doc_id"]), "text")
    return d.select("doc_id", "n_words", "n_valued", *[round4(c).alias(c) for c in ("neg", "neu", "pos")], "sentiment")


# --- tables ------------------------------------------------------------------------------
# --- fixed values: the item that a third of all rows are, and a bound of a message
HOT_ITEM, HOT_DAY, MESSAGE_BYTES = "All rights reserved.", "2024-01-09", 20_000


@query
def envelope_hot_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8: messages of a feed in which a third of all rows are one item of one
    step, read back."""
    n = fx.news_items(spark, sf_dir)
    day, hot = F.substring("date", 1, 10), (F.col("doc_id") / 3).cast("long") % 3 == 0
    step = F.when(hot, HOT_DAY).otherwise(day)
    rows = n.select(F.when(hot, HOT_DAY).otherwise(F.col("date")).alias("date"), F.when(hot, HOT_ITEM).otherwise(F.col("data")).alias("data"),
                    step.alias("date_start"), F.date_format(F.date_add(F.to_date(step), 1), "yyyy-MM-dd").alias("date_end"))
    m = to_envelopes(rows, Z.SOURCE_NEWS_XTB, "news", "yyyy-MM-dd", MESSAGE_BYTES)
    e = valid(parse_envelopes(m, "value", keep=["value"])).select("date_start", "date_end", "news", F.octet_length("value").alias("bytes"))
    frame = 500  # of a message, around its items
    items = e.select("date_start", "date_end", F.explode("news").alias("item"),
                     ((F.size("news") == 1) | (F.col("bytes") <= MESSAGE_BYTES + frame)).alias("within"))
    return items.groupBy("date_start", "date_end").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("item.data") == HOT_ITEM).alias("n_hot"),
        F.sum(F.length("item.data").cast("long")).alias("chars"), F.bool_and("within").alias("within_bound"))


@query
def bucket_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4 in buckets: the days are stored with wrong rain, then upserted by day
    in three runs, each of which writes the buckets of its days alone."""
    path = scratch_path(spark, "buckets")
    w = materialise(daily.daily_weather(fx.weather_raw(spark, sf_dir)), "daily")
    BK.upsert(spark, w.withColumn("rain", F.lit(-1.0)), path, ["record_date"], buckets=16)
    for third in range(3):
        BK.upsert(spark, w.filter(F.dayofmonth(F.to_date("record_date")) % 3 == third), path, ["record_date"])
    out = BK.read(spark, path, Z.SERVING_WEATHER)
    return out.select("record_date", *[round4(c).alias(c) for c in ("temperature", "rain", "sun")])


@query
def lake_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1: the news feeds' lakes, to which a truncated copy of one of its files,
    an empty file and files of other kinds are added; the rows of the good files,
    and the number of files by what is wrong with them."""
    base = scratch_path(spark, "triage-lake")
    rows = fx.lake_feeds(spark, sf_dir)
    found = None
    for src in (s for s in Z.ALL_SOURCES if Z.FEED_KIND[s] == "news"):
        TB.write_lake(rows[src], base, src)
        fx.damage_lake(spark, TB.lake_path(base, src))
        report = TR.triage(spark, base, src)
        good = TR.scan_good(spark, base, src, report).groupBy(F.lit(src).alias("source"), F.lit("rows").alias("what")).agg(F.count(F.lit(1)).alias("n"))
        bad = report.filter("reason is not null").groupBy(F.lit(src).alias("source"), F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
        found = good.unionByName(bad) if found is None else found.unionByName(good).unionByName(bad)
    return found


# --- dates of a window's items ---------------------------------------------------------
@query
def window_item_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ6 + PRJ7: the first and last date that the news and the candles of each
    window carry themselves."""
    parsed = valid(parse_envelopes(fx.event_messages(spark, sf_dir), "value"))
    sides = []
    for side in SL._SIDES:
        items = WN.in_windows(SL.side_items(parsed, side).withColumn("item_date", F.col("item_date").cast("timestamp_ntz")), TWIN)
        sides.append(items.groupBy(F.lit(side).alias("side"), F.col("window_start").cast("timestamp_ntz").alias("window_start")).agg(
            F.min("item_date").alias("first_item"), F.max("item_date").alias("last_item"), F.count("item_date").alias("n_dated")))
    return sides[0].unionByName(sides[1])
