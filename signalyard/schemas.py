"""Declared schemas.  Every frame has a schema even when it is empty, so
no operator needs an "empty input" branch (the reference's pandas frames
lose their columns when a folder is empty)."""

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()
# Batch timestamps are zone-less (TIMESTAMP_NTZ), as the lake files store
# them; streaming casts to TIMESTAMP only where a watermark needs it.
TS = T.TimestampNTZType()

# --- fixed values: feed names, as written by the producers -------------
SOURCE_NEWSAPI = "scraper_news_newsapi"
SOURCE_WORLDNEWSAPI = "scraper_news_worldnewsapi"
SOURCE_NEWS_XTB = "scraper_news_xtb"
SOURCE_STOCK = "scraper_stock_xtb"
SOURCE_WEATHER = "scraper_weather_openmeteo"
ALL_SOURCES = [SOURCE_NEWSAPI, SOURCE_WORLDNEWSAPI, SOURCE_NEWS_XTB, SOURCE_STOCK, SOURCE_WEATHER]

# --- fixed values: per-source date formats (Java patterns) --------------
# newsapi "%Y-%m-%dT%H:%M:%S", worldnewsapi "%Y-%m-%d %I:%M:%S" (12-hour,
# no AM/PM), the broker and the weather API "%Y-%m-%d".
DATE_FORMATS = {
    SOURCE_NEWSAPI: "yyyy-MM-dd'T'HH:mm:ss",
    SOURCE_WORLDNEWSAPI: "yyyy-MM-dd hh:mm:ss",
    SOURCE_NEWS_XTB: "yyyy-MM-dd",
    SOURCE_STOCK: "yyyy-MM-dd",
    SOURCE_WEATHER: "yyyy-MM-dd",
}
# Payload kind of each feed.
FEED_KIND = {SOURCE_NEWSAPI: "news", SOURCE_WORLDNEWSAPI: "news", SOURCE_NEWS_XTB: "news",
             SOURCE_STOCK: "candlesticks", SOURCE_WEATHER: "weather"}
# Candle label string, e.g. "Nov 22, 2024, 1:00:00 PM".
CTM_STRING_FORMAT = "MMM d, yyyy, h:mm:ss a"

# --- fixed values: count-based batch sizes per feed kind ----------------
BATCH_LIMITS = {"news": 5, "stock": 10, "weather": 1}

# --- fixed values: field names and types of messages, lake and serving tables
NEWS_ITEM = T.StructType([T.StructField("data", S), T.StructField("date", S)])
CANDLE = T.StructType([
    T.StructField("ctm", L), T.StructField("ctmString", S),
    T.StructField("open", D), T.StructField("close", D), T.StructField("high", D),
    T.StructField("low", D), T.StructField("vol", D),
])
WEATHER_ITEM = T.StructType([
    T.StructField("temperature", D), T.StructField("rain", D), T.StructField("sun", D),
])

# Superset of every key any producer writes (the reference's streaming
# schema dropped weather and the date range).
ENVELOPE = T.StructType([
    T.StructField("source", S),
    T.StructField("news", T.ArrayType(NEWS_ITEM)),
    T.StructField("candlesticks", T.ArrayType(CANDLE)),
    T.StructField("weather", T.ArrayType(WEATHER_ITEM)),
    T.StructField("time", S),
    T.StructField("date_start", S),
    T.StructField("date_end", S),
    T.StructField("date_format", S),
])

# Lake record schemas, one per feed (the .avsc files of the reference).
LAKE_NEWS = T.StructType([
    T.StructField("date", S), T.StructField("data", S),
    T.StructField("date_start", S), T.StructField("date_end", S),
])
LAKE_STOCK = T.StructType([
    T.StructField("ctm", TS), T.StructField("ctmString", S),
    T.StructField("open", D), T.StructField("close", D), T.StructField("high", D),
    T.StructField("low", D), T.StructField("vol", D),
    T.StructField("date_start", S), T.StructField("date_end", S),
])
LAKE_WEATHER = T.StructType([
    T.StructField("temperature", D), T.StructField("rain", D), T.StructField("sun", D),
    T.StructField("date_start", S), T.StructField("date_end", S),
])
LAKE_SCHEMAS = {
    SOURCE_NEWSAPI: LAKE_NEWS, SOURCE_WORLDNEWSAPI: LAKE_NEWS, SOURCE_NEWS_XTB: LAKE_NEWS,
    SOURCE_STOCK: LAKE_STOCK, SOURCE_WEATHER: LAKE_WEATHER,
}

# Serving tables.
SERVING_NEWS = T.StructType([T.StructField("record_date", S), T.StructField("source", S),
                             T.StructField("count", L)])
SERVING_WEATHER = T.StructType([T.StructField("record_date", S), T.StructField("temperature", D),
                                T.StructField("rain", D), T.StructField("sun", D)])
SERVING_OPEN = T.StructType([T.StructField("record_date", S), T.StructField("open", D)])
SCRAPER_LOG = T.StructType([T.StructField("start_date", S), T.StructField("end_date", S),
                            T.StructField("record_count", L)])
MODEL_LOG = T.StructType([T.StructField("the_date", S), T.StructField("loss", D)])

# --- fixed values: model features, in order (PRJ24); target is `open` ---
FEATURES = ["open", "close", "high", "low", "vol", "temperature", "rain", "sun",
            "sentiment", "language"]
NUMERIC_COLUMNS = ["ctm", "open", "close", "high", "low", "vol", "temperature", "rain", "sun"]
FINAL_COLUMNS = ["ctm", "ctmString", "open", "close", "high", "low", "vol",
                 "date_start", "date_end", "temperature", "rain", "sun",
                 "date", "data", "sentiment", "language"]
MEANS = T.StructType([T.StructField("_id", S)] + [T.StructField(c, D) for c in FEATURES])
