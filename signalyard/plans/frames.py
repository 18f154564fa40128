"""Training frames: PIP4 (inner), PIP5 (outer + imputation), ML4's range
frame, and the feature summaries built on them (PIP6, AGG11).

Shape of the work: the news side is large (one row per article, whole
text), the weather side holds one row per day and the candle side 24
rows per day.  The small sides and the scored articles are written once to
the shared folder: each base table is read once, the regex work over whole
texts runs once, and Spark sees the small sides' sizes and broadcasts them,
so that the article rows are not shuffled for the joins; the fan-out is
articles x candles of the same day (linear in articles, the candle count
per day being bounded by the candle frequency)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as Z
from ..functions.dates import coerce_timestamp
from ..functions.text import clean_text
from ..operators.aggregates import distinct_days, tail_summary
from ..operators.encode import label_encode
from ..operators.impute import impute_means
from ..operators.joins import full_outer_split, join_on_dates
from ..operators.text_scoring import with_text_scores
from ..session import materialise
from .daily import tag_and_union as tag_news  # noqa: F401  (PRJ11 + SET1)

KEYS = ["date_start", "date_end"]
SENTIMENT_CODES = {"pos": 1, "neu": 0, "neg": -1}


def union_news(feeds: list[DataFrame]) -> DataFrame:
    """SET1: union of the news feeds by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def sentiment_code(c="sentiment"):
    """PRJ22: pos 1 / neu 0 / neg -1, anything else null."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.lit(None).cast("long")
    for k, v in SENTIMENT_CODES.items():
        m = F.when(col == k, F.lit(v).cast("long")).otherwise(m)
    return m


def to_numeric(df: DataFrame, columns=Z.NUMERIC_COLUMNS) -> DataFrame:
    """PRJ21: ``try_cast`` to double per value (the reference casts per
    column and gives up on the whole column; documented deviation).  ``ctm``
    stays a timestamp, as it does in the reference."""
    return df.select(*[F.col(c).try_cast("double").alias(c)
                       if c in columns and c != "ctm" and c in df.columns else F.col(c)
                       for c in df.columns])


def scored_news(news: DataFrame, text_mode: str = "literal") -> DataFrame:
    """STR1 + TXT1 + TXT2: scores from the intended cleaning of the raw
    text (Q2 FIX), ``data`` cleaned in ``text_mode`` (Q1 KEEP by default).

    The frames built on it run several jobs (the label codes, the model
    statistics, the output), so the scored rows are written once."""
    out = with_text_scores(news, "data").withColumn("data", clean_text("data", text_mode))
    return materialise(out, "scored-news")


def lake_keys(news: DataFrame, normalise: bool) -> DataFrame:
    """Q6 option: the feed's own 5-minute or day range as the day range that
    candles and weather have, so that every feed's articles can match."""
    if not normalise:
        return news
    day = F.to_date(F.substring("date_start", 1, 10))
    return news.withColumn("date_end", F.date_format(F.date_add(day, 1), "yyyy-MM-dd")) \
        .withColumn("date_start", F.date_format(day, "yyyy-MM-dd"))


def truncate_keys(df: DataFrame) -> DataFrame:
    """PRJ13: day truncation of the date range (first ten characters),
    as a midnight timestamp."""
    return df.select(*[F.to_timestamp_ntz(F.substring(F.col(c).cast("string"), 1, 10),
                                          F.lit("yyyy-MM-dd")).alias(c)
                       if c in KEYS else F.col(c) for c in df.columns])


def training_frame_inner(news: DataFrame, weather: DataFrame, stock: DataFrame,
                         text_mode: str = "literal", normalise_keys: bool = False, scored: bool = False) -> DataFrame:
    """PIP4: inner joins on the raw date-range strings (JN1, JN2; Q6 KEEP, or
    on days with ``normalise_keys``),
    coerced keys (PRJ20), numeric casts (PRJ21), sentiment codes (PRJ22),
    language label codes (ENC1), fixed 16-column projection (PRJ23).
    ``scored``: ``news`` comes from ``scored_news``."""
    weather, stock = materialise(weather, "weather"), materialise(stock, "candles")
    # Only articles whose range has both weather and candles can reach the
    # inner frame: semi-join them to both first, so text is scored once per
    # surviving article, before the candle fan-out.
    news = lake_keys(news, normalise_keys)
    news = news.join(weather.select(*KEYS), KEYS, "left_semi").join(stock.select(*KEYS), KEYS, "left_semi")
    n = news if scored else scored_news(news, text_mode)
    j = join_on_dates(n, weather, KEYS, "inner")
    j = join_on_dates(j, stock, KEYS, "inner")
    j = j.withColumn("date_start", coerce_timestamp("date_start").cast("timestamp_ntz")) \
        .withColumn("date_end", coerce_timestamp("date_end").cast("timestamp_ntz")) \
        .withColumn("sentiment", sentiment_code())
    j = to_numeric(j)
    j = label_encode(j, "language")
    return j.select(*Z.FINAL_COLUMNS)


def _outer_join(n: DataFrame, w: DataFrame, s: DataFrame) -> DataFrame:
    news_keys = materialise(n.select(*KEYS).distinct(), "news-keys")
    j = full_outer_split(n, w, KEYS, big_keys=news_keys)
    j = full_outer_split(j, s, KEYS, big_keys=news_keys.unionByName(w.select(*KEYS)))
    return to_numeric(j.withColumn("sentiment", sentiment_code()))


def in_key_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """PRJ14: ``date_start >= start AND date_end <= end`` (inclusive)."""
    return df.filter((F.col("date_start") >= F.lit(start).cast("timestamp_ntz")) &
                     (F.col("date_end") <= F.lit(end).cast("timestamp_ntz")))


def training_frame_outer(news: DataFrame, weather: DataFrame, stock: DataFrame,
                         text_mode: str = "literal", day_keys: bool = True, key: str = "range",
                         impute: bool = True, key_range: tuple[str, str] | None = None, scored: bool = False) -> DataFrame:
    """PIP5: full outer joins (JN3) on day-truncated keys (PRJ13; Q7 KEEP),
    numeric casts, sentiment codes, language codes with missing as the
    category 'nan' (ENC2), then mean imputation of the nine numeric
    columns over the whole joined frame (IMP1).

    ``key_range`` returns only the rows inside an inclusive day range
    (ML4).  Catalyst cannot push a filter on the coalesced keys of a full
    outer join, so the range is applied by hand to all three inputs (a
    matched row has the same key on both sides, so this equals filtering
    the joined frame); the language codes and the IMP1 means are still
    fitted on the unfiltered frame, as the reference does.

    ``key="date_start"`` (Q7 option) joins on the start day alone; all rows
    then end a day after they start, so that the API feeds' 5-minute ranges
    meet the day ranges of candles and weather.  ``scored``: ``news`` comes from
    ``scored_news``."""
    n = news if scored else scored_news(news, text_mode)
    w, s = materialise(weather, "weather"), materialise(stock, "candles")
    if day_keys:
        n, w, s = truncate_keys(n), truncate_keys(w), truncate_keys(s)
    if key == "date_start":
        n, w, s = (d.withColumn("date_end", F.col("date_start") + F.expr("INTERVAL 1 DAY")) for d in (n, w, s))
    elif key != "range":
        raise ValueError("key is 'range' or 'date_start'")
    full = _outer_join(n, w, s)
    if key_range is None:
        j = full
    else:
        a, b = key_range
        j = _outer_join(in_key_range(n, a, b), in_key_range(w, a, b), in_key_range(s, a, b))
    j = label_encode(j, "language", missing_as="nan", codes_from=full if key_range else None)
    j = j.select(*Z.FINAL_COLUMNS)
    return impute_means(j, Z.NUMERIC_COLUMNS, means_from=full if key_range else None) if impute else j


def frame_in_range(frame: DataFrame, start: str, end: str) -> DataFrame:
    """ML4 steps PRJ14 + IMP2: ``date_start >= start AND date_end <= end``
    (both inclusive), then mean-impute the ten features with the means of
    the filtered rows.  (Build ``frame`` with ``key_range`` to have the
    range applied before the joins.)"""
    f = in_key_range(frame, start, end)
    f = f.withColumn("sentiment", F.col("sentiment").cast("double")) \
        .withColumn("language", F.col("language").cast("double"))
    return impute_means(f, Z.FEATURES)


def range_dates(frame: DataFrame) -> DataFrame:
    """AGG11: sorted distinct start dates of a frame."""
    return distinct_days(frame, "date_start")


TAIL_ORDER = ["date_start", "date_end", "ctm", "date", "data"]


def feature_means(frame: DataFrame, n: int = 7) -> DataFrame:
    """PIP6/AGG3: means of eight features and medians of sentiment and
    language over the last ``n`` rows of the total order TAIL_ORDER (Q11
    FIX), keyed 'means' for the upsert (SNK4)."""
    summary = tail_summary(frame, [F.col(c) for c in TAIL_ORDER], Z.FEATURES[:8],
                           ["sentiment", "language"], n)
    return summary.select(F.lit("means").alias("_id"), *Z.FEATURES)


def store_feature_means(frame: DataFrame, path: str, n: int = 7) -> int:
    """PIP6: AGG3 summary upserted under key 'means' (SNK4, new version)."""
    from ..sinks.tables import upsert
    return upsert(frame.sparkSession, feature_means(frame, n), path, ["_id"])
