"""Tier 1: operators on tiny frames - nulls, empties, ties, duplicate keys,
and the reference quirks by number (SURVEY §2.13)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from signalyard import schemas as Z
from signalyard.functions import dates as DT
from signalyard.functions import html as H
from signalyard.functions import text as TX
from signalyard.operators import aggregates as AG
from signalyard.operators import joins as J
from signalyard.operators.batching import count_batches, group_row_numbers
from signalyard.operators.encode import label_encode
from signalyard.operators.envelope import explode_items, payload_kind, record_count, to_lake_rows
from signalyard.operators.impute import impute_means, impute_zero
from signalyard.operators.text_scoring import sentiment_scores, with_language
from signalyard.sources.envelope import parse_envelopes, quarantine, valid


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


# --- STR1 / Q1 ---------------------------------------------------------------
def test_clean_text_literal_deletes_whitespace_q1(spark):
    s = "<p>Hello World a@b.com http://x.y 12345678901</p>"
    got = one(spark, TX.clean_text(F.col("t"), "literal"), t=s)
    assert got == "helloworldabcomhttpxy12345678901"


def test_clean_text_intended(spark):
    s = "<p>Hello  World a@b.com see http://x.y/z and 12345678901 ok!</p>"
    got = one(spark, TX.clean_text(F.col("t"), "intended"), t=s)
    assert got == "hello world see and ok"


def test_clean_text_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(TX.clean_text("t")).first()[0] == ""


# --- PRJ16 ---------------------------------------------------------------------
def test_contains_all_modes(spark):
    df = spark.createDataFrame([("Cocoa prices in Africa",), ("cocoa only",)], ["b"])
    lit = df.filter(TX.contains_all("b", ["Africa"], "literal")).count()
    intended = df.filter(TX.contains_all("b", ["Africa", "cocoa"], "intended")).count()
    assert (lit, intended) == (0, 1)


# --- PRJ17, PRJ19, STR4, STR5, SRC5 -------------------------------------------------
def test_error_predicates(spark):
    rows = [("error", TX.NEWSAPI_TOO_FAR + " more"), ("ok", None), (None, None),
            ("error", "something else")]
    df = spark.createDataFrame(rows, "status string, message string")
    got = [r[0] for r in df.select(TX.too_far_in_past("status", "message")).collect()]
    assert got == [True, False, False, False]
    df2 = spark.createDataFrame([("failure", TX.WORLDNEWSAPI_TOO_FAR + "x")], "status string, message string")
    assert df2.select(TX.too_far_in_past("status", "message", "worldnewsapi")).first()[0]


def test_keep_article(spark):
    df = spark.createDataFrame([(TX.REMOVED_URL, "x"), ("http://a", None), ("http://a", "t")],
                               "url string, text string")
    assert df.filter(TX.keep_article("url", "text")).count() == 1


def test_feed_kind_and_backslashes(spark):
    assert one(spark, TX.feed_kind(F.col("s")), s="scraper_news_newsapi") == "news"
    assert one(spark, TX.strip_backslashes(F.col("s")), s='{\\"a\\": 1}') == '{"a": 1}'


# --- STR6 ---------------------------------------------------------------------------
def test_paragraphs_skip_script_and_blank(spark):
    html = ('<html><script>var t="</p>";</script><p class="x">One &amp; <b>two</b></p>'
            '<p>  </p><P>Three</P></html>')
    got = one(spark, H.paragraph_text(F.col("h")), h=html)
    assert got == "One & two\nThree"
    assert one(spark, H.paragraph_text(F.col("h")), h="<div>none</div>") == H.NO_CONTENT


# --- dates -------------------------------------------------------------------------
def test_record_date_and_strictness(spark):
    assert one(spark, DT.record_date(F.col("d")), d="2024-11-06T19: 47: 29Z") == "2024-11-06"
    df = spark.createDataFrame([("not a date",)], ["d"])
    assert df.select(DT.record_date("d", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(DT.record_date("d", strict=True)).collect()


def test_broker_time_and_shifts(spark):
    assert one(spark, DT.reformat_broker_time(F.col("s")), s="Nov 22, 2024, 1:00:00 PM") == \
        "2024-11-22T13:00:00Z"
    assert one(spark, DT.shift_days(F.col("d"), -1), d="2024-03-01") == "2024-02-29"
    assert one(spark, DT.shift_minutes(F.col("d"), 5), d="2024-01-01T23:58:00") == "2024-01-02T00:03:00"


def test_twelve_hour_without_marker_q8(spark):
    got = one(spark, F.to_timestamp(F.col("d"), "yyyy-MM-dd hh:mm:ss"), d="2024-01-01 12:05:00")
    assert got.hour == 0


def test_compare_dates_unknown_operator_is_null(spark):
    assert one(spark, DT.compare_dates(F.col("a"), F.col("b"), op="<"), a="2024-01-01", b="2024-01-02")
    assert one(spark, DT.compare_dates(F.col("a"), F.col("b"), op="!="), a="2024-01-01", b="2024-01-02") is None


def test_date_range_inclusive_and_raises(spark):
    got = one(spark, F.size(DT.date_range(F.col("a"), F.col("b"))), a="2024-01-30", b="2024-02-02")
    assert got == 4
    df = spark.createDataFrame([("2024-02-02", "2024-01-01")], ["a", "b"])
    with pytest.raises(Exception):
        df.select(DT.date_range("a", "b")).collect()


# --- aggregates (R8: pandas null rules) -------------------------------------------------
def test_count_drops_null_keys(spark):
    df = spark.createDataFrame([("d", "s"), ("d", "s"), (None, "s")], "record_date string, source string")
    assert [tuple(r) for r in AG.count_per_key(df, ["record_date", "source"]).collect()] == [("d", "s", 2)]


def test_daily_weather_all_null_sums_to_zero(spark):
    df = spark.createDataFrame([("d", 1.0, None, None), ("d", 3.0, None, None)],
                               "record_date string, temperature double, rain double, sun double")
    r = AG.daily_weather(df).first()
    assert (r["temperature"], r["rain"], r["sun"]) == (2.0, 0.0, 0.0)


def test_argmax_ties_resolve_in_order(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (0.2, 0.5, 0.5), (0.1, 0.1, 0.8)], "n double, u double, p double")
    assert [r[0] for r in df.select(AG.argmax_label("n", "u", "p")).collect()] == ["neg", "neu", "pos"]


def test_tail_summary_uses_total_order(spark):
    rows = [(i, float(i), float(i % 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, x double, s double")
    r = AG.tail_summary(df, [F.col("k")], ["x"], ["s"], n=7).first()
    assert r["x"] == pytest.approx(sum(range(3, 10)) / 7)
    assert r["s"] == 1.0


def test_column_means_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), 1.0), (dt.datetime(2024, 1, 1, 2, 0), None)],
                               "ts timestamp_ntz, x double")
    r = AG.column_means(df, ["ts", "x"]).first()
    assert r["ts"] == dt.datetime(2024, 1, 1, 1, 0) and r["x"] == 1.0


# --- joins ----------------------------------------------------------------------------
def test_rows_to_add_is_true_anti_join_q3(spark):
    new = spark.createDataFrame([("d1", "a", 1), ("d2", "a", 2)], "record_date string, source string, count long")
    old = spark.createDataFrame([("d1", "a", 9)], "record_date string, source string, count long")
    out = J.rows_to_add(new, old, ["record_date", "source"])
    assert out.columns == ["record_date", "source", "count"]
    assert [tuple(r) for r in out.collect()] == [("d2", "a", 2)]
    empty = spark.createDataFrame([], old.schema)
    assert J.rows_to_add(new, empty, ["record_date", "source"]).count() == 2
    # idempotent: applying the load twice adds nothing the second time
    assert J.rows_to_add(new, new.unionByName(old), ["record_date", "source"]).count() == 0


def test_replace_or_add_q5_option(spark):
    new = spark.createDataFrame([("d1", 5)], "k string, v long")
    old = spark.createDataFrame([("d1", 1), ("d2", 2)], "k string, v long")
    got = sorted(tuple(r) for r in J.replace_or_add(new, old, ["k"]).collect())
    assert got == [("d1", 5), ("d2", 2)]


def test_salted_join_equals_plain_join(spark):
    big = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, w string")
    plain = sorted(tuple(r) for r in big.join(small, "k").collect())
    salted = sorted(tuple(r) for r in J.salted_join(big, small, ["k"], salt=7).collect())
    assert plain == salted
    with pytest.raises(ValueError):
        J.salted_join(big, small, ["k"], "full_outer")


def test_full_outer_split_equals_full_outer(spark):
    big = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "k long, x string")
    small = spark.createDataFrame([(2, 20.0), (3, 30.0), (None, 0.0)], "k long, y double")
    rows = lambda df: sorted(map(tuple, df.select("k", "x", "y").collect()), key=str)
    for null_safe in (False, True):
        ref = rows(J.full_outer_on(big, small, ["k"], null_safe))
        assert rows(J.full_outer_split(big, small, ["k"], null_safe)) == ref
        keys = big.select("k").distinct()
        assert rows(J.full_outer_split(big, small, ["k"], null_safe, keys)) == ref


def test_with_defaults_means_then_zero(spark):
    req = spark.createDataFrame([(None, 2.0)], "open double, close double")
    means = spark.createDataFrame([("means", 10.0, None)], "_id string, open double, close double")
    r = J.with_defaults(req, means, ["open", "close"]).first()
    assert (r["open"], r["close"]) == (10.0, 2.0)
    none = spark.createDataFrame([], means.schema)
    r = J.with_defaults(req, none, ["open", "close"]).first()
    assert (r["open"], r["close"]) == (0.0, 2.0)


# --- imputation -------------------------------------------------------------------------
def test_impute_means_and_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    got = [tuple(r) for r in impute_means(df, ["a", "b"]).collect()]
    assert got == [(1.0, None), (2.0, None), (3.0, None)]
    z = [tuple(r) for r in impute_zero(df, ["a"]).collect()]
    assert z == [(1.0, None), (0.0, None), (3.0, None)]


# --- encoders -------------------------------------------------------------------------
def test_label_encode_sorted_and_missing(spark):
    df = spark.createDataFrame([("fr",), ("de",), (None,), ("fr",)], "l string")
    enc = [r["code"] for r in label_encode(df, "l", "code").collect()]
    assert sorted(enc, key=lambda x: (x is None, x)) == [0, 1, 1, None]
    enc2 = sorted(tuple(r) for r in label_encode(df, "l", "code", missing_as="nan").collect())
    assert enc2 == [("de", 0), ("fr", 1), ("fr", 1), ("nan", 2)]


def test_label_encode_matches_dense_rank(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 503).cast("string").alias("l"))
    got = label_encode(df, "l", "code")
    ref = df.select("l", (F.dense_rank().over(Window.orderBy("l")) - 1).alias("code"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


# --- WIN1: scalable row numbers ------------------------------------------------------------
def test_group_row_numbers_match_window(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 10 < 6, "hot").otherwise(
        (F.col("id") % 10).cast("string")).alias("g"), (F.col("id") * 37 % 3001).alias("o"))
    got = group_row_numbers(df, "g", ["o"], partitions=7).select("g", "o", "rn")
    ref = df.select("g", "o", F.row_number().over(Window.partitionBy("g").orderBy("o")).alias("rn"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def test_count_batches_keeps_only_full_batches_q14(spark):
    rows = [("scraper_news_a", i, 3) for i in range(12)] + [("scraper_stock_xtb", i, 1) for i in range(9)]
    df = spark.createDataFrame(rows, "source string, off long, n long")
    b = count_batches(df, ["off"])
    got = sorted((r["source"], r["batch_id"], r["c"]) for r in
                 b.groupBy("source", "batch_id").agg(F.count("*").alias("c")).collect())
    assert got == [("scraper_news_a", 0, 5), ("scraper_news_a", 1, 5)]


# --- envelopes --------------------------------------------------------------------------
def test_envelope_parse_dispatch_quarantine(spark):
    msgs = [
        '{"source": "scraper_news_xtb", "news": [{"data": "a", "date": "2024-01-01"}], '
        '"time": "2024-01-01", "date_start": "2024-01-01", "date_end": "2024-01-02"}',
        '{"source": "scraper_stock_xtb", "candlesticks": [], "time": "2024-01-01"}',
        '{"source": "scraper_weather_openmeteo", "weather": [{"temperature": 1.5, "rain": 0.0, "sun": 60.0}],'
        ' "time": "2024-01-01", "date_start": "2024-01-01", "date_end": "2024-01-02"}',
        '{"source": "x", "time": "t"}',
        'not json',
    ]
    raw = spark.createDataFrame([(m,) for m in msgs], "value string")
    parsed = parse_envelopes(raw)
    assert quarantine(parsed).count() == 1
    v = valid(parsed)
    kinds = [(r[0], r[1]) for r in v.select(payload_kind(), record_count()).collect()]
    assert kinds == [("news", 1), ("candlesticks", 0), ("weather", 1), (None, 0)]
    with pytest.raises(Exception):
        v.select(payload_kind(strict=True)).collect()
    news = explode_items(v, "news")
    assert [tuple(r) for r in news.collect()] == [("a", "2024-01-01", "2024-01-01", "2024-01-02")]
    assert explode_items(v, "candlesticks").count() == 0  # empty payload adds nothing
    w = to_lake_rows(explode_items(v, "weather"), Z.SOURCE_WEATHER)
    assert w.columns == Z.LAKE_WEATHER.fieldNames()


def test_envelope_repair(spark):
    raw = spark.createDataFrame([('{\\"source\\": \\"scraper_news_xtb\\", \\"time\\": \\"t\\"}',)], "value string")
    assert valid(parse_envelopes(raw)).count() == 0
    assert valid(parse_envelopes(raw, repair=True)).count() == 1


def test_envelope_writer_bounds_message_size(spark):
    from signalyard.sinks.envelope import to_envelopes
    rows = spark.range(95).select(F.col("id").cast("string").alias("data"), F.lit("2024-01-01").alias("date"),
                                  F.lit("2024-01-01").alias("date_start"), F.lit("2024-01-02").alias("date_end"))
    env = to_envelopes(rows, Z.SOURCE_NEWS_XTB, "news", "yyyy-MM-dd", max_bytes=400)
    assert all(len(r["value"]) <= 400 + 150 for r in env.collect())  # items and the envelope's own fields
    parsed = valid(parse_envelopes(env))
    sizes = [r[0] for r in parsed.select(record_count()).collect()]
    assert sum(sizes) == 95 and len(sizes) >= 95 * 30 // 400
    back = sorted(r["data"] for r in explode_items(parsed, "news").collect())
    assert back == sorted(str(i) for i in range(95))


# --- text scoring ------------------------------------------------------------------------
def test_sentiment_and_language(spark):
    df = spark.createDataFrame([(1, "Great gains and strong growth"), (2, "the loss was bad"), (3, ""),
                                (4, "der die und das"), (5, "xyz qqq")], "id long, t string")
    s = {r["id"]: r["sentiment"] for r in sentiment_scores(df, "t").collect()}
    # row 2: neg 0.5 ties neu 0.5 -> neg; row 3: empty text 0/0/0 -> neg (tie order)
    assert s == {1: "pos", 2: "neg", 3: "neg", 4: "neu", 5: "neu"}
    lang = {r["id"]: r["language"] for r in with_language(df, "t").collect()}
    assert lang[4] == "de" and lang[5] is None and lang[3] is None


def test_language_guess_accuracy(spark):
    from signalyard.sources.fixtures import table
    from .conftest import SF_ORACLE
    d = with_language(table(spark, SF_ORACLE, "documents"), "text")
    acc = d.select(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert acc > 0.95


# text, what the literal patterns leave, what the intended patterns leave
CLEAN_SAMPLES = [
    ("plain words only", "plainwordsonly", "plain words only"),
    ("mail a@b.com and a@b\\.com", "mailabcomand", "mail and abcom"),
    ("see http://x.y and http://\\Sz", "seehttpxyandz", "see and"),
    ("www.site.org \\www\\.\\Sq", "wwwsiteorg\\q", "wwwsq"),
    ("nums 12345678901 \\b\\dddddddddddd\\b x", "nums12345678901x", "nums bddddddddddddb x"),
    ("tab\\ss\\sss  here", "tabhere", "tabsssss here"),
    ("<b>tag</b> \\ back", "tag\\back", "tag  back"),
    ("", "", ""),
    ("no break space", "nobreakspace", "no break space"),
    ("\t lead and trail \n", "leadandtrail", "lead and trail"),
]


@pytest.mark.parametrize("mode", ["literal", "intended"])
def test_clean_text_gives_the_written_results(spark, mode):
    df = spark.createDataFrame([(x[0],) for x in CLEAN_SAMPLES], "t string")
    got = [r[0] for r in df.select(TX.clean_text("t", mode)).collect()]
    assert got == [x[1 if mode == "literal" else 2] for x in CLEAN_SAMPLES]


def test_hot_day_join_paths_agree(spark):
    """One day holds a third of all articles: the broadcast path (bound
    proven) and the salted fallback (bound not proven) give the same rows,
    and the default path does not shuffle the article side."""
    n = 3000
    news = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-07"))
        .otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")),
                                 "yyyy-MM-dd")).alias("date_start"),
        F.col("id").alias("doc"))
    news = news.withColumn("date_end", F.date_format(F.date_add(F.to_date("date_start"), 1), "yyyy-MM-dd"))
    stock = spark.range(20 * 24).select(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 24).cast("int")),
                      "yyyy-MM-dd").alias("date_start"), (F.col("id") % 24).alias("hour"))
    stock = stock.withColumn("date_end", F.date_format(F.date_add(F.to_date("date_start"), 1), "yyyy-MM-dd"))
    keys = ["date_start", "date_end"]
    joined = J.join_on_dates(news, stock, keys)
    salted = J.salted_join(news, stock, keys, salt=8)
    rows = lambda df: sorted(map(tuple, df.select("doc", "hour").collect()))
    assert rows(joined) == rows(salted)
    assert joined.count() == n * 24


def test_spread_scan_keeps_rows(spark):
    from signalyard.operators.partitioning import spread_scan
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"))
    one = df.coalesce(1)
    out = spread_scan(one, ["t"])
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in out.collect()) == sorted(r[0] for r in one.collect())
    assert spread_scan(df, ["t"]) is df  # enough partitions already


def test_load_windows_defaults_and_edge(spark):
    from signalyard.streaming.cursor import last_cursor, load_windows
    log = spark.createDataFrame([("a", "2024-01-01", "2024-01-02", 3), ("a", "2024-01-03", "2024-01-04", 1),
                                 ("b", "2024-02-01", "2024-02-02", 2)],
                                "feed string, start_date string, end_date string, record_count long")
    gaps = sorted(map(tuple, load_windows(log, "2024-01-05", feeds=["a", "c"]).select("feed", "start_date")
                      .collect()))
    # a: hole on the 2nd and the tail on the 4th; c: no log -> 30 days back
    assert gaps[:2] == [("a", "2024-01-02"), ("a", "2024-01-04")]
    assert [g for g in gaps if g[0] == "c"][0] == ("c", "2023-12-06") and len(gaps) == 2 + 30
    tail = load_windows(log.filter("feed = 'b'"), "2024-02-02", mode="tail").collect()
    assert [(r["start_date"], r["end_date"]) for r in tail] == [("2024-02-02", "2024-02-03")]
    assert {r["feed"]: r["end_date"] for r in last_cursor(log).collect()} == {"a": "2024-01-04", "b": "2024-02-02"}
