"""Reference feeds derived from the supplied tables.

The reference reads five lake feeds (three news feeds, candles, weather)
and two log tables.  We do not invent input: every feed below is a Spark
projection or aggregation of ``documents`` or ``events``, so its size
grows with the supplied data.  Each has a DuckDB twin in
``tools.oracle_sql`` (``FIXTURE_CTES``).

* news   - one item per document; feed chosen by ``doc_id % 3``, day by
           ``doc_id % 29`` from 2024-01-01 (a mapping, not a filter: every
           document lands in exactly one feed).
* stock  - one candle per event hour; close/high/low are offsets from
           open, as in the reference's mock candles.
* weather (raw) - one row per event; nulls on purpose per event type.
* logs   - scraper log rows: (feed, day) groups of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as Z

# --- fixed values: fixture parameters ------------------------------------
NEWS_ORIGIN = "2024-01-01"
NEWS_DAYS = 29
NEWS_FEEDS = {0: "newsapi", 1: "worldnewsapi", 2: "xtb"}
LOG_FEEDS = {"view": "newsapi", "click": "worldnewsapi", "error": "xtb",
             "signup": "openmeteo", "purchase": "stock"}
REGIONS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_string(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All news items with their feed tag: (doc_id, feed, date, data,
    date_start, date_end, lang).  The step range uses each feed's own key
    format: the two news APIs step 5 minutes ('T10:00:00'-'T10:05:00' and
    the 12-hour '10:00:00'-'10:05:00'), the broker steps one day - so raw
    keys only match candles/weather for the broker feed (Q6), and after
    day truncation the API feeds still have date_end == date_start (Q7)."""
    d = table(spark, sf_dir, "documents")
    day = F.date_add(F.lit(NEWS_ORIGIN).cast("date"), (F.col("doc_id") % NEWS_DAYS).cast("int"))
    k = F.col("doc_id") % 3
    feed = F.when(k == 0, NEWS_FEEDS[0]).when(k == 1, NEWS_FEEDS[1]).otherwise(NEWS_FEEDS[2])
    ds = _day_string(day)
    start = F.when(k == 0, F.concat(ds, F.lit("T10:00:00"))) \
        .when(k == 1, F.concat(ds, F.lit(" 10:00:00"))).otherwise(ds)
    end = F.when(k == 0, F.concat(ds, F.lit("T10:05:00"))) \
        .when(k == 1, F.concat(ds, F.lit(" 10:05:00"))).otherwise(_day_string(F.date_add(day, 1)))
    return d.select(
        "doc_id", feed.alias("feed"),
        F.date_format(day, "yyyy-MM-dd'T'10:00:00'Z'").alias("date"),
        F.col("text").alias("data"),
        start.alias("date_start"), end.alias("date_end"), "lang",
    )


def news_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """One news lake feed in the lake record schema (LAKE_NEWS)."""
    return news_items(spark, sf_dir).filter(F.col("feed") == feed) \
        .select(*Z.LAKE_NEWS.fieldNames())


def stock_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles (LAKE_STOCK)."""
    e = table(spark, sf_dir, "events")
    # date_trunc returns a zoned TIMESTAMP even for a zone-less input; the
    # lake declares ctm zone-less, so cast back (same wall clock in UTC).
    h = e.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), "ts", "value") \
        .groupBy("h").agg(
            F.min_by("value", "ts").alias("o"), F.max_by("value", "ts").alias("c"),
            F.max("value").alias("hi"), F.min("value").alias("lo"), F.count("*").alias("n"))
    day = F.to_date("h")
    return h.select(
        F.col("h").alias("ctm"),
        F.date_format("h", Z.CTM_STRING_FORMAT).alias("ctmString"),
        F.col("o").alias("open"), (F.col("c") - F.col("o")).alias("close"),
        (F.col("hi") - F.col("o")).alias("high"), (F.col("lo") - F.col("o")).alias("low"),
        F.col("n").cast("double").alias("vol"),
        _day_string(day).alias("date_start"), _day_string(F.date_add(day, 1)).alias("date_end"),
    )


def weather_raw(spark: SparkSession, sf_dir: str, keep: list[Column] | None = None) -> DataFrame:
    """Raw weather lake rows (LAKE_WEATHER), many per day, nulls on purpose;
    ``keep`` adds columns of the events."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    t = F.col("event_type")
    return e.select(
        *(keep or []), F.when(t.isin("view", "click"), F.col("value")).alias("temperature"),
        F.when(t == "error", F.col("value")).alias("rain"),
        F.when(t == "signup", F.col("value") * 60).alias("sun"),
        _day_string(day).alias("date_start"), _day_string(F.date_add(day, 1)).alias("date_end"),
    )


def scraper_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraper log rows (feed, start_date, end_date, record_count)."""
    e = table(spark, sf_dir, "events")
    feed = F.create_map(*[x for kv in LOG_FEEDS.items() for x in map(F.lit, kv)])[F.col("event_type")]
    day = F.to_date("ts")
    return e.groupBy(feed.alias("feed"), day.alias("d")).agg(F.count("*").alias("record_count")) \
        .select("feed", _day_string("d").alias("start_date"),
                _day_string(F.date_add("d", 1)).alias("end_date"), "record_count")


#: Feeds of the mixed log, and one range in so many is a whole day or hour.
MIXED_FEEDS, DAY_RANGES, HOUR_RANGES = 200, 1009, 13


def mixed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of mixed steps, overlapping, nested and touching: (feed,
    start_date, end_date).  Every event is a range of its user's feed: the five
    minutes or the hour it lies in, or its day and the next two (as dates)."""
    e = table(spark, sf_dir, "events")
    k, fmt = F.col("event_id"), "yyyy-MM-dd'T'HH:mm:ss"
    at = F.window(F.col("ts").cast("timestamp"), "5 minutes").start.cast("timestamp_ntz")
    hour, day = F.date_trunc("hour", "at").cast("timestamp_ntz"), F.to_date("at")
    e = e.withColumn("at", at)

    def pick(of_day, of_hour, of_minutes):
        return F.when(k % DAY_RANGES == 0, of_day).when(k % HOUR_RANGES == 0, of_hour).otherwise(of_minutes)
    start = pick(_day_string(day), F.date_format(hour, fmt), F.date_format("at", fmt))
    end = pick(_day_string(F.date_add(day, 3)), F.date_format(hour + F.expr("INTERVAL 1 HOUR"), fmt), F.date_format(F.col("at") + F.expr("INTERVAL 5 MINUTE"), fmt))
    return e.select(F.concat(F.lit("feed-"), F.col("user_id") % MIXED_FEEDS).alias("feed"), start.alias("start_date"), end.alias("end_date"))


def region_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (day, region) daily weather arrays as the weather API returns
    them (one-element daily arrays)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(_day_string(F.to_date("ts")).alias("day"),
                     (F.col("user_id") % REGIONS).cast("string").alias("region")).agg(
        F.array(F.min("value")).alias("temperature_2m_min"),
        F.array(F.max("value")).alias("temperature_2m_max"),
        F.array(F.sum("value")).alias("rain_sum"),
        F.array(F.sum("value") * 60).alias("sunshine_duration"),
    )


def weather_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather lake feed: one record per day step, as the weather
    producer sends (AGG2 of the raw rows per (date_start, date_end))."""
    return weather_raw(spark, sf_dir).groupBy("date_start", "date_end").agg(
        F.avg("temperature").alias("temperature"),
        F.coalesce(F.sum("rain"), F.lit(0.0)).alias("rain"),
        F.coalesce(F.sum("sun"), F.lit(0.0)).alias("sun"))


def lake_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five lake feeds keyed by producer source name."""
    return {
        Z.SOURCE_NEWSAPI: news_feed(spark, sf_dir, NEWS_FEEDS[0]),
        Z.SOURCE_WORLDNEWSAPI: news_feed(spark, sf_dir, NEWS_FEEDS[1]),
        Z.SOURCE_NEWS_XTB: news_feed(spark, sf_dir, NEWS_FEEDS[2]),
        Z.SOURCE_STOCK: stock_lake(spark, sf_dir),
        Z.SOURCE_WEATHER: weather_lake(spark, sf_dir),
    }


#: Lots in which the late feeds arrive.
LOTS = 3


def late_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All news items as they reach the lake late: (source, lot, LAKE_NEWS).  The
    step under which an item is stored is up to four days after its own date, so
    a day's items lie under two months, and they come in all lots."""
    n = news_items(spark, sf_dir)
    step = F.date_add(F.to_date(F.substring("date", 1, 10)), ((F.col("doc_id") / NEWS_DAYS).cast("long") % 5).cast("int"))
    return n.select(F.concat(F.lit("scraper_news_"), "feed").alias("source"), ((F.col("doc_id") / 7).cast("long") % LOTS).alias("lot"),
                    "date", "data", _day_string(step).alias("date_start"), _day_string(F.date_add(step, 1)).alias("date_end"))


def late_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw weather rows with the lot they arrive in: (lot, LAKE_WEATHER)."""
    lot = ((F.col("event_id") / 5).cast("long") % LOTS).alias("lot")
    return weather_raw(spark, sf_dir, keep=[lot])


def envelopes(spark: SparkSession, sf_dir: str, max_bytes: int | None = None,
              kinds: list[str] | None = None) -> DataFrame:
    """Messages as the producers publish them (SNK8 over every lake feed, or
    those of the given payload kinds): (source, date_start, date_end, part,
    value)."""
    from functools import reduce
    from ..sinks.envelope import DEFAULT_MAX_BYTES, to_envelopes
    parts = []
    for src, rows in lake_feeds(spark, sf_dir).items():
        if kinds and Z.FEED_KIND[src] not in kinds:
            continue
        e = to_envelopes(rows, src, Z.FEED_KIND[src], Z.DATE_FORMATS[src],
                         max_bytes or DEFAULT_MAX_BYTES)
        parts.append(e.select(F.lit(src).alias("source"), "date_start", "date_end", "part", "value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


#: The hour that a third of the events are moved to.
HOT_HOUR = "2024-01-10 05:00:00"
#: Lots in which late messages arrive, and days of event time that make a lot.
LATE_LOTS, LOT_DAYS = 4, 8


def hot_hour_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_messages`` with a third of the events at their minute and second
    of one hour, in the order of their times: (date_start, date_end, value)."""
    into = F.make_dt_interval(mins=F.minute("ts"), secs=F.second("ts"))
    at = F.when(F.col("event_id") % 3 == 0, F.lit(HOT_HOUR).cast("timestamp_ntz") + into).otherwise(F.col("ts").cast("timestamp_ntz"))
    m = event_messages(spark, sf_dir, at)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return m.select(stamp.alias("date_start"), stamp.alias("date_end"), "value")


def late_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_messages`` with the lot that each arrives in (lot, value): lots
    follow the event time, but a tenth comes one lot late and a tenth two."""
    delay = F.when(F.col("event_id") % 10 == 0, 1).when(F.col("event_id") % 10 == 1, 2).otherwise(0)
    day = F.datediff(F.to_date("ts"), F.lit(NEWS_ORIGIN).cast("date"))
    lot = F.least(F.floor(F.greatest(day, F.lit(0)) / LOT_DAYS) + delay, F.lit(LATE_LOTS - 1)).cast("int")
    return event_messages(spark, sf_dir, keep=[lot.alias("lot")]).drop("ts")


def event_messages(spark: SparkSession, sf_dir: str, at: Column | None = None, keep: list[Column] | None = None) -> DataFrame:
    """Stream twin input: one envelope per event, ``purchase`` events as
    candles, all others as news of the three news feeds; event time = ``ts``
    (or ``at``).  Columns (ts, value), after those in ``keep``."""
    e = table(spark, sf_dir, "events")
    if at is not None:
        e = e.withColumn("ts", at)
    t = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    news = F.array(F.struct(F.col("props").alias("data"),
                            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")))
    candle = F.array(F.struct(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ctm"),
        F.date_format("ts", Z.CTM_STRING_FORMAT).alias("ctmString"),
        F.col("value").alias("open"), F.lit(0.0).alias("close"), F.lit(0.0).alias("high"),
        F.lit(0.0).alias("low"), F.lit(1.0).alias("vol")))
    kind = F.col("event_type")
    feed = F.when(kind == "view", Z.SOURCE_NEWSAPI).when(kind == "click", Z.SOURCE_WORLDNEWSAPI) \
        .otherwise(Z.SOURCE_NEWS_XTB)
    value = F.when(kind == "purchase", F.to_json(F.struct(F.lit(Z.SOURCE_STOCK).alias("source"),
                                                          candle.alias("candlesticks"), t.alias("time")))) \
        .otherwise(F.to_json(F.struct(feed.alias("source"), news.alias("news"), t.alias("time"))))
    return e.select(*(keep or []), "ts", value.alias("value"))


def write_stream_input(df: DataFrame, path: str) -> None:
    """``df``'s messages as text files, for a file stream to read: one write, by
    all tasks at once, beside what ``path`` holds."""
    df.select("value").write.mode("append").text(path)


def damage_lake(spark: SparkSession, folder: str) -> None:
    """Adds to a feed's lake folder what a lake collects over time: the first half
    of one of its files, an empty file, a text under a Parquet name, a text file,
    and a Parquet file of another schema."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join([folder, *names]))
    fs = path().getFileSystem(conf)

    def write(name: str, content: bytes) -> None:
        out = fs.create(path("month=2024_01", name), True)
        out.write(bytearray(content))
        out.close()

    files = fs.listFiles(path(), True)
    good = None
    while good is None and files.hasNext():
        f = files.next()
        good = f if f.getPath().getName().endswith(".parquet") else None
    if good is not None:
        whole = spark.read.format("binaryFile").load(good.getPath().toString()).select(
            F.substring("content", 1, max(16, good.getLen() // 2)).alias("half")).first()["half"]
        write("part-truncated.parquet", bytes(whole))
    write("part-empty.parquet", b"")
    write("part-foreign.parquet", b"source,date,data and so on\n" * 5)
    write("notes.txt", b"not a record\n")
    spark.range(3).select("id").coalesce(1).write.mode("append").parquet(f"{folder}/month=2024_01")


#: Bytes of messages of a file of ``write_in_order``, on average.
ARRIVAL_BYTES = 256 * 1024 * 1024
MIN_FILES = 4


def write_in_order(messages: DataFrame, path: str, at: int = 0) -> int:
    """``messages`` (date_start, date_end, value) as text files beside what
    ``path`` holds, so that a file stream takes them in the order of their steps:
    ranges of steps, none divided, in files whose times ascend from ``at`` on.
    Returns the time after the last."""
    from ..session import materialise
    spark = messages.sparkSession
    m = materialise(messages.select("date_start", "date_end", "value"), "messages")
    size = m.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    m = m.repartitionByRange(max(MIN_FILES, -(-size // ARRIVAL_BYTES)), "date_start", "date_end")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = lambda: {f.getPath().toString() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")} if fs.exists(folder) else set()
    before = names()
    write_stream_input(m, path)
    # a call a file, of the file's date alone
    for name in sorted(names() - before):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 1000 * at, -1)
        at += 1
    return at
