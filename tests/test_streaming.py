"""Tier 3: streaming - late data, restart from checkpoint, stream scoring."""

import json
import os

from pyspark.sql import types as T

from signalyard import schemas as Z
from signalyard.session import scratch_path
from signalyard.streaming import speed_layer as SL

from .conftest import local


def _news(t, tag):
    return json.dumps({"source": Z.SOURCE_NEWSAPI, "news": [{"data": tag, "date": "2024-01-01"}],
                       "time": f"2024-01-01 00:00:{t:02d}"})


def _candle(t, v):
    return json.dumps({"source": Z.SOURCE_STOCK, "time": f"2024-01-01 00:00:{t:02d}",
                       "candlesticks": [{"ctm": t * 1000, "ctmString": "Jan 1, 2024, 12:00:00 AM",
                                         "open": v, "close": 0.0, "high": 0.0, "low": 0.0, "vol": 1.0}]})


def _write(path, name, lines):
    path = local(path)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _run(spark, src, out, ckpt):
    stream = SL.read_stream(spark, src, fmt="text", max_files=1)
    SL.start_window_join(spark, stream, out, checkpoint=ckpt).awaitTermination()
    if not os.path.exists(local(out)):
        return []
    return [json.loads(r["value"]) for r in spark.read.json(out).collect()]


def test_late_data_dropped_and_restart(spark):
    src, out = scratch_path(spark, "t-src"), scratch_path(spark, "t-out")
    ckpt = scratch_path(spark, "t-ckpt")
    _write(src, "a.json", [_news(t, f"n{t}") for t in range(0, 21, 2)] +
           [_candle(t, float(t)) for t in range(1, 21, 2)])
    first = _run(spark, src, out, ckpt)
    # after the first run the watermark is 18 s: windows ending by then are out
    assert first, "closed windows are emitted"
    # a late item for an already closed window, plus newer data
    _write(src, "b.json", [_news(2, "late")] + [_news(40, "n40"), _candle(41, 41.0)])
    second = _run(spark, src, out, ckpt)  # restarted from the same checkpoint
    items = [n["data"] for v in second for n in v["news_list"]]
    assert "late" not in items
    # no window emitted twice across the restart
    assert len(second) == len({json.dumps(v, sort_keys=True) for v in second})
    assert len(second) > len(first)


def test_batch_twin_sees_every_window(spark):
    lines = [_news(t, f"n{t}") for t in range(0, 21, 2)] + [_candle(t, float(t)) for t in range(1, 21, 2)]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    from signalyard.sources.envelope import parse_envelopes, valid
    j = SL.window_join(valid(parse_envelopes(raw)), watermark=None)
    # 3 s slide over 0..20 s: windows starting -9..18 that hold both kinds
    starts = sorted(r[0].second for r in j.select("window.start").collect())
    assert starts and all(s % 3 == 0 for s in starts)


def test_stream_features_take_means(spark):
    src = scratch_path(spark, "t-feat")
    _write(src, "a.json", [_candle(5, 7.5)])
    means = spark.createDataFrame([("means",) + tuple(float(i) for i in range(10))],
                                  Z.MEANS)
    stream = SL.read_stream(spark, src, fmt="text")
    from signalyard.sources.envelope import parse_envelopes, valid
    feats = SL.stream_features(valid(parse_envelopes(stream)), means, watermark=None)
    out = scratch_path(spark, "t-feat-out")
    q = feats.drop("at", "item_date").writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", scratch_path(spark, "t-feat-ckpt")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.read.parquet(out).first()
    assert r["open"] == 7.5 and r["close"] == 0.0 and r["temperature"] == 5.0 and r["language"] == 9.0


def test_dropped_rows_counter_and_stream_predictions(spark):
    from signalyard.models import walk_forward as WF
    src = scratch_path(spark, "t-pred")
    _write(src, "a.json", [_candle(5, 7.5), _candle(8, 9.0)])
    means = spark.createDataFrame([("means",) + tuple(float(i) for i in range(10))], Z.MEANS)
    coef = spark.createDataFrame([(0, "2024-01-06", 1, 1.0) + (2.0,) + (0.0,) * 9 + (0.0,)],
                                 WF.COEF_SCHEMA)
    out = scratch_path(spark, "t-pred-out")
    q = SL.start_stream_predictions(spark, SL.read_stream(spark, src, fmt="text"), means, coef, out)
    q.awaitTermination()
    got = sorted(r["open"] for r in spark.read.parquet(out).collect())
    assert got == [16.0, 19.0]  # 1 + 2 * open
    assert SL.dropped_by_watermark(q) == 0


def test_text_scoring_on_a_stream(spark):
    from signalyard.operators.text_scoring import with_text_scores
    src = scratch_path(spark, "t-text")
    _write(src, "a.json", ['{"data": "great strong growth and gains"}', '{"data": "der die und"}'])
    stream = spark.readStream.schema("data string").json(src)
    out = scratch_path(spark, "t-text-out")
    q = with_text_scores(stream, "data").writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", scratch_path(spark, "t-text-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["sentiment"], r["language"]) for r in spark.read.parquet(out).collect())
    assert got == [("neu", "de"), ("pos", "en")]


def test_stateful_batches_per_source_and_partition(spark):
    from signalyard.streaming.batcher import stateful_batches
    src = scratch_path(spark, "t-batch")
    rows = [json.dumps({"source": "scraper_news_x", "part": p, "off": i, "n_records": 1})
            for p in (0, 1) for i in range(12)]
    _write(src, "a.json", rows)
    stream = spark.readStream.schema("source string, part long, off long, n_records long").json(src)
    out = scratch_path(spark, "t-batch-out")
    q = stateful_batches(stream, ["off"], key_cols=["source", "part"]).writeStream.format("parquet") \
        .option("path", out).option("checkpointLocation", scratch_path(spark, "t-batch-ckpt")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["part"], r["batch_id"], r["off"]) for r in spark.read.parquet(out).collect())
    # news batches of 5 per (source, partition); 2 of 12 messages stay buffered in each
    assert len(got) == 20
    assert [g for g in got if g[0] == 1][:6] == [(1, 0, 0), (1, 0, 1), (1, 0, 2), (1, 0, 3), (1, 0, 4), (1, 1, 5)]


def test_batches_are_emitted_in_linear_time():
    import time
    import pandas as pd
    from signalyard.streaming.batcher import _emitter

    class State:
        exists = False

        def update(self, value):
            self.value = value

    new = pd.DataFrame({"off": range(100_000), "n_records": 1})
    began, state = time.time(), State()
    out = list(_emitter(["source"], ["off"], {"weather": 1}, [], None)(("scraper_weather_x",), iter([new]), state))[0]
    assert len(out) == 100_000 and out["batch_id"].tolist() == list(range(100_000))
    assert time.time() - began < 1 and state.value == ("[]", 100_000)


def test_parts_of_a_step_count_once():
    import pandas as pd
    from signalyard.streaming.batcher import _emitter

    class State:
        exists = True
        get = ('[{"date_start": "a", "msg": "1", "n_records": 1}]', 4)

        def update(self, value):
            self.value = value

    new = pd.DataFrame({"date_start": ["a", "b", "b", "c"], "msg": list("2345"), "n_records": 1})
    state = State()
    emit = _emitter(["source"], ["date_start", "msg"], {"news": 2}, [], ["date_start"])
    out = list(emit(("scraper_news_x",), iter([new]), state))[0]
    assert out["msg"].tolist() == list("1234") and set(out["batch_id"]) == {4}
    assert json.loads(state.value[0])[0]["date_start"] == "c" and state.value[1] == 5


def test_equal_items_keep_the_message_bound(spark):
    from pyspark.sql import functions as F
    from signalyard.sinks.envelope import to_envelopes
    rows = spark.range(5000).select(F.lit("same text of an item").alias("data"), F.lit("d").alias("date"),
                                    F.lit("2024-01-01").alias("date_start"), F.lit("2024-01-02").alias("date_end"))
    rows = rows.unionByName(rows.limit(2).withColumn("data", F.lit("x" * 30_000)))
    m = to_envelopes(rows, Z.SOURCE_NEWSAPI, "news", "yyyy-MM-dd", max_bytes=20_000).collect()
    assert sum(len(json.loads(r["value"])["news"]) for r in m) == 5002
    assert len(m) >= 20 and len({r["part"] for r in m}) == len(m)
    big = [r for r in m if len(r["value"]) > 21_000]
    assert len(big) == 2 and all(len(json.loads(r["value"])["news"]) == 1 for r in big)


def test_refresh_reads_only_touched_months(spark):
    from signalyard.sinks import tables as TB
    from signalyard.streaming.refresh import touched_lake
    base = scratch_path(spark, "lake")
    rows = spark.createDataFrame([(1.0, 0.0, 1.0, "2024-01-31", "2024-02-01"), (2.0, 1.0, 0.0, "2024-02-01", "2024-02-02")],
                                 Z.LAKE_WEATHER)
    TB.write_lake(rows, base, Z.SOURCE_WEATHER)
    df = touched_lake(TB.scan_lake(spark, base, Z.SOURCE_WEATHER), ["2024_02"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert df.count() == 1


def test_refresh_replaces_days_when_asked(spark):
    from signalyard.plans import daily
    from signalyard.sinks import tables as TB
    from signalyard.streaming import refresh as RF
    base, serving, ckpt = (scratch_path(spark, n) for n in ("lake", "serving", "ckpt"))
    for temperature in (1.0, 3.0):
        TB.write_lake(spark.createDataFrame([(temperature, 0.0, 1.0, "2024-01-31", "2024-02-01")], Z.LAKE_WEATHER),
                      base, Z.SOURCE_WEATHER)
        stream = spark.readStream.schema(T.StructType([*Z.LAKE_WEATHER.fields, T.StructField("month", T.StringType())])).parquet(
            TB.lake_path(base, Z.SOURCE_WEATHER))
        RF.start_refresh(spark, stream, lambda: TB.scan_lake(spark, base, Z.SOURCE_WEATHER), daily.daily_weather, serving,
                         ["record_date"], "date_start", ckpt, {"availableNow": True}, on_conflict="replace").awaitTermination()
    got = TB.read_versioned(spark, serving, Z.SERVING_WEATHER).collect()
    assert [(r["record_date"], r["temperature"]) for r in got] == [("2024-01-31", 2.0)]


def test_cluster_session_needs_a_shared_folder():
    import pytest
    from signalyard.session import NoSharedFolder, ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(NoSharedFolder):
        ensure_checkpoint_dir(Session())


def _batches(spark, out):
    return sorted((r["source"], r["batch_id"], r["off"]) for r in spark.read.parquet(out).collect())


def test_bounded_batches_equal_win1_over_triggers_restarts_and_retries(spark):
    """Micro-batches of any cut give the batches of the whole table, also when an
    epoch is run twice; nothing of the hot source is one Python group."""
    from signalyard.operators.batching import count_batches
    from signalyard.streaming import ordered as OB
    rng = __import__("random").Random(3)
    hot = [("scraper_news_hot", i, 1) for i in range(93)]
    rows = sorted(hot + [(rng.choice(["scraper_stock_x", "scraper_weather_y", "scraper_news_z"]), i, 2) for i in range(60)], key=lambda r: r[1])
    schema = "source string, off long, n_records long"
    whole = count_batches(spark.createDataFrame(rows, schema), ["off"])
    want = sorted((r["source"], r["batch_id"], r["off"]) for r in whole.collect())
    for cuts in ([0, 153], [0, 1, 2, 7, 80, 81, 153]):
        state, got = scratch_path(spark, "t-held"), []
        for epoch, (a, b) in enumerate(zip(cuts, cuts[1:])):
            new = spark.createDataFrame(rows[a:b], schema)
            for _ in range(1 + epoch % 2):  # every second epoch is run again
                done = OB.release(new, state, epoch, ["off"]).collect()
            got += [(r["source"], r["batch_id"], r["off"]) for r in done]
        assert sorted(got) == want


def test_bounded_batches_of_steps_with_parts_and_of_two_keys(spark):
    from signalyard.streaming import ordered as OB
    schema = "source string, part long, date_start string, off long, n_records long"
    rows = [("scraper_news_a", p, f"s{i // 3:02d}", i, 1) for p in (0, 1) for i in range(36)]  # 12 steps of 3 parts
    state = scratch_path(spark, "t-steps")
    first = OB.release(spark.createDataFrame(rows, schema), state, 0, ["date_start", "off"], ["source", "part"], steps=["date_start"]).collect()
    assert len(first) == 2 * 10 * 3 and {r["batch_id"] for r in first} == {0, 1}
    more = [("scraper_news_a", 1, f"t{i}", i, 1) for i in range(3)]
    second = OB.release(spark.createDataFrame(more, schema), state, 1, ["date_start", "off"], ["source", "part"], steps=["date_start"]).collect()
    assert sorted((r["part"], r["batch_id"], r["date_start"]) for r in second) == [(1, 2, d) for d in ["s10"] * 3 + ["s11"] * 3 + ["t0", "t1", "t2"]]
    assert OB.release(spark.createDataFrame([], schema), state, 2, ["date_start", "off"], ["source", "part"], steps=["date_start"]).count() == 0


def test_a_feed_without_a_batch_size_is_an_error(spark):
    import pytest
    from signalyard.streaming import ordered as OB
    new = spark.createDataFrame([("scraper_other_x", 1, 1)], "source string, off long, n_records long")
    with pytest.raises(Exception, match="no batch size"):
        OB.release(new, scratch_path(spark, "t-unknown"), 0, ["off"]).collect()


def test_files_of_a_stream_arrive_in_the_order_of_their_steps(spark):
    from signalyard.sources import fixtures as fx
    path = scratch_path(spark, "t-order")
    at = 0
    for half in (0, 1):
        rows = [(f"d{half}{i:02d}", f"d{half}{i:02d}", f"v{half}{i:02d}") for i in range(40)]
        at = fx.write_in_order(spark.createDataFrame(rows[::-1], "date_start string, date_end string, value string"), path, at)
    seen = []
    q = SL.read_stream(spark, path, fmt="text", max_files=2).writeStream.foreachBatch(
        lambda b, e: seen.append(sorted(r["value"] for r in b.collect()))).option("checkpointLocation", scratch_path(spark, "t-order-ckpt"))
    q.trigger(availableNow=True).start().awaitTermination()
    assert len(seen) >= 3 and sum(seen, []) == sorted(sum(seen, []))


# --- maintained aggregates ----------------------------------------------------------
def _daily(spark, store, aggregate):
    from signalyard.streaming import deltas as DL
    return {tuple(r)[0]: tuple(r)[1:] for r in DL.read_daily(spark, store, aggregate).collect()}


def test_deltas_count_once_over_retries_late_rows_and_compaction(spark):
    from signalyard.streaming import deltas as DL
    store = scratch_path(spark, "t-deltas")
    schema = "temperature double, rain double, sun double, date_start string, month string"
    day = lambda d, t, r, m="2024_01": (t, r, None, d, m)
    assert DL.read_daily(spark, store, DL.WEATHER) is None and DL.compact(spark, store, DL.WEATHER) is None

    def write(run, epoch, rows):
        DL.write_delta(spark.createDataFrame(rows, schema), store, DL.WEATHER, run, epoch)
    write("a", 0, [day("2024-01-31", 1.0, 1.0), day("2024-01-31", None, 2.0), day("nonsense", 9.0, 9.0)])
    write("a", 0, [day("2024-01-31", 1.0, 1.0), day("2024-01-31", None, 2.0)])  # run again
    write("a", 1, [day("2024-01-31", 4.0, None, "2024_02"), day("2024-02-01", None, None, "2024_02")])  # one day under two months
    want = {"2024-01-31": (2.5, 3.0, 0.0), "2024-02-01": (None, 0.0, 0.0)}
    assert _daily(spark, store, DL.WEATHER) == want
    assert DL.compact(spark, store, DL.WEATHER) == 1 and DL.compact(spark, store, DL.WEATHER) is None
    assert _daily(spark, store, DL.WEATHER) == want
    write("a", 1, [day("2024-01-31", 4.0, None, "2024_02"), day("2024-02-01", None, None, "2024_02")])  # covered, and run again
    write("b", 0, [day("2024-02-01", 7.0, 1.0, "2024_02")])  # another stream, late
    write("a", 3, [day("2024-02-01", 1.0, 1.0, "2024_02")])  # epoch 2 is still being written
    want["2024-02-01"] = (4.0, 2.0, 0.0)
    assert _daily(spark, store, DL.WEATHER) == want
    assert DL.compact(spark, store, DL.WEATHER) == 2 and DL.open_epochs(spark, store, {"a": 1, "b": 0}) == {"a": [3]}
    assert DL.vacuum(spark, store) == 2  # epochs 0 and 1 of run a, which version 1 covers
    write("a", 2, [day("2024-02-02", 3.0, 0.0, "2024_02")])
    want["2024-02-02"] = (3.0, 0.0, 0.0)
    assert _daily(spark, store, DL.WEATHER) == want
    assert DL.compact(spark, store, DL.WEATHER) == 3 and _daily(spark, store, DL.WEATHER) == want


def test_a_base_that_was_not_finished_is_not_read(spark):
    from signalyard.streaming import deltas as DL
    store = scratch_path(spark, "t-broken")
    schema = "temperature double, rain double, sun double, date_start string"
    DL.write_delta(spark.createDataFrame([(1.0, 1.0, 1.0, "2024-01-01")], schema), store, DL.WEATHER, "a", 0)
    DL._summed(DL._parts(spark, store, {"a": [0]}), DL.WEATHER).write.parquet(DL._base(store, 1, "rows"))  # no ``covered``
    assert _daily(spark, store, DL.WEATHER) == {"2024-01-01": (1.0, 1.0, 1.0)}
    assert DL.compact(spark, store, DL.WEATHER) == 2


# --- windows in parts, late rows -----------------------------------------------------
def _at(rows, spark):
    return spark.createDataFrame(rows, "side string, at string, item string").selectExpr("side", "CAST(at AS TIMESTAMP) AS at", "item")


def _seconds(*rows):
    return [("stock_list" if s == "s" else "news_list", None if t is None else f"2024-01-01 00:00:{t:02d}", item) for s, t, item in rows]


def test_windows_leave_in_parts_and_late_rows_are_kept(spark):
    from signalyard.streaming import windows as WN
    store, w = scratch_path(spark, "t-windows"), WN.Windows(max_bytes=300)
    hot = [("n", 11, f"hot{i % 7}") for i in range(400)]
    first = _seconds(*[("n", t, f"n{t}") for t in range(0, 21, 2)], *[("s", t, f"s{t}") for t in range(1, 21, 2)], *hot, ("n", None, "timeless"))
    for _ in range(2):  # run again
        WN.handle(_at(first, spark), store, 0, w)
    parts, contents = WN.read_parts(spark, store)
    # the watermark is 17 s: windows of 10 s that end by then have left
    ends = {r["window_end"].second for r in contents.collect()}
    assert ends == {4, 7, 10, 13, 16}
    assert all(r["n_bytes"] <= 300 or r["n_items"] == 1 for r in parts.collect())
    per = {(r["window_end"].second, r["side"]): (r["n_items"], r["n_parts"]) for r in contents.collect()}
    assert per[(16, "news_list")][0] == 405 and per[(16, "news_list")][1] > 10
    got = sorted(i for r in parts.filter("side = 'news_list' AND second(window_end) = 16").collect() for i in r["items"])
    assert got == sorted([f"n{t}" for t in range(6, 16, 2)] + [x[2] for x in hot])
    second = _seconds(("n", 2, "late"), ("n", 15, "half late"), ("n", 50, "n50"), ("s", 51, "s51"), ("s", 52, "s52"))
    WN.handle(_at(second, spark), store, 1, w)
    late = sorted((r["item"], r["window_start"] and r["window_start"].second, r["stored"]) for r in WN.read_late(spark, store).collect())
    # windows that had left: those that end by 17 s; of the item at 15 s that is the window from 6 s
    assert late == [("half late", 6, True), ("late", 0, False), ("late", 54, False), ("late", 57, False), ("timeless", None, False)]
    assert "late" not in {i for r in parts.collect() for i in r["items"]}
    _, fixed = WN.corrected(spark, store, w)
    fixed = {(r["window_end"].second, r["side"]): r["n_items"] for r in fixed.collect()}
    assert fixed[(16, "news_list")] == 406 and fixed[(10, "news_list")] == 6 and fixed[(10, "stock_list")] == 5
    assert set(e for e, _ in fixed) == {4, 7, 10, 16}
    _, contents = WN.read_parts(spark, store)
    after = {(r["window_end"].second, r["side"]): r["n_items"] for r in contents.filter("epoch = 1").collect()}
    assert after[(25, "news_list")] == 4 and (16, "news_list") not in after  # 16 18 20, and the item at 15 s


def test_a_side_that_never_comes_lets_no_window_leave(spark):
    from signalyard.streaming import windows as WN
    store = scratch_path(spark, "t-one-side")
    for epoch in range(2):
        WN.handle(_at(_seconds(*[("n", t, f"n{t}") for t in range(0, 50, 5)]), spark), store, epoch, WN.Windows())
    parts, _ = WN.read_parts(spark, store)
    assert parts.count() == 0 and WN.read_late(spark, store).count() == 0
    WN.handle(_at(_seconds(("s", 30, "s")), spark), store, 2, WN.Windows())
    _, contents = WN.read_parts(spark, store)
    assert contents.count() == 0  # both sides are seen, but no window with both has closed
    WN.handle(_at(_seconds(("s", 59, "s"), ("n", 59, "n")), spark), store, 3, WN.Windows())
    assert WN.read_parts(spark, store)[1].filter("side = 'stock_list'").count() == 4


def test_parts_split_the_copies_of_one_item(spark):
    """A third of all rows is one item: its copies lie in many parts and tasks,
    none of which is much larger than the others."""
    from signalyard.operators.parts import bounded_parts
    rows = [("k", "x" * 20)] * 3000 + [(f"k{i % 5}" if i % 2 else "k", f"item {i:06d} {'y' * 8}") for i in range(6000)] + [(None, "n")] * 3 + [("big", "z" * 5000)] * 4
    df = spark.createDataFrame(rows, "key string, item string")
    parts = bounded_parts(df, ["key"], 4000).collect()
    assert sorted((p["key"] or "", i) for p in parts for i in p["items"]) == sorted((k or "", i) for k, i in rows)
    assert all(p["n_items"] == len(p["items"]) and (p["n_bytes"] <= 4000 or p["n_items"] == 1) for p in parts)
    assert len({(p["key"], p["part"]) for p in parts}) == len(parts)
    with_hot = [p for p in parts if "x" * 20 in p["items"]]
    tasks = {}
    for p in parts:
        tasks[p["part"] >> 32] = tasks.get(p["part"] >> 32, 0) + p["n_bytes"]
    assert len(with_hot) >= 3000 * 23 // 4000 and max(tasks.values()) < 3 * sorted(tasks.values())[len(tasks) // 2]
