"""Walk-forward model against a brute-force numpy fit; sinks and scans."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalyard import schemas as Z
from signalyard.models import walk_forward as WF
from signalyard.operators.intervals import assign_intervals
from signalyard.session import scratch_path
from signalyard.sinks import tables as TB

from .conftest import local


def _frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    day0 = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        d = day0 + dt.timedelta(days=int(rng.integers(0, 23)))
        x = rng.normal(size=10) * np.arange(1, 11)
        y = 3.0 + x @ np.linspace(0.5, -0.4, 10) + rng.normal() * 0.01
        rows.append((d.isoformat(), (d + dt.timedelta(days=1)).isoformat(), float(y), *map(float, x)))
    cols = ["date_start", "date_end", "target"] + Z.FEATURES
    return spark.createDataFrame(rows, cols), rows


def test_interval_assignment_covers_each_row_once(spark):
    df, rows = _frame(spark)
    a = assign_intervals(df)
    # a day-long range starting on an interval's last day ends at the
    # interval end and is dropped (date_end < interval end, as the reference)
    day0 = dt.date(2024, 1, 1)
    kept = [r for r in rows if (dt.date.fromisoformat(r[0]) - day0).days % 5 != 4]
    assert a.count() == len(kept)
    got = a.select(F.datediff(F.to_date("date_start"), F.col("interval_start")).alias("d")).agg(
        F.min("d"), F.max("d")).first()
    assert got[0] >= 0 and got[1] < 5


def test_walk_forward_matches_numpy(spark):
    df, rows = _frame(spark)
    coef = WF.fit_walk_forward(df, target="target", ridge=0.0).orderBy("interval").collect()
    day0 = dt.date(2024, 1, 1)
    X = np.array([[1.0] + list(r[3:]) for r in rows])
    y = np.array([r[2] for r in rows])
    days = np.array([(dt.date.fromisoformat(r[0]) - day0).days for r in rows])
    k = np.where(days % 5 == 4, -1, days // 5)  # -1: straddles the interval end
    for c in coef:
        m = (k >= 0) & (k <= c["interval"])
        w, *_ = np.linalg.lstsq(X[m], y[m], rcond=None)
        got = np.array([c["intercept"]] + [c[f"w_{f}"] for f in Z.FEATURES])
        assert np.allclose(got, w, atol=1e-6), (c["interval"], got, w)
        mk = k == c["interval"]
        mse = float(np.mean((X[mk] @ got - y[mk]) ** 2))
        assert c["train_loss"] == pytest.approx(mse, rel=1e-3, abs=1e-9)


def test_fit_and_score_clamps_and_logs(spark):
    df, rows = _frame(spark)
    preds, log = WF.fit_and_score(df, target="target")
    assert preds.count() == assign_intervals(df).count()
    assert preds.filter(F.col("predicted_open") < 0).count() == 0  # ReLU clamp
    assert log.count() == df.select(F.floor(F.datediff(F.to_date("date_start"),
                                                       F.lit("2024-01-01").cast("date")) / 5)).distinct().count()


def test_prediction_nan_and_null_to_zero(spark):
    coef = spark.createDataFrame([(0, "2024-01-06", 1, float("nan")) + (1.0,) * 10 + (0.0,)], WF.COEF_SCHEMA)
    req = spark.createDataFrame([tuple([None] * 10)], ", ".join(f"{c} double" for c in Z.FEATURES))
    assert WF.score_with(req, coef).first()["predicted_open"] == 0.0


def test_registry_latest_and_missing(spark):
    reg = scratch_path(spark, "registry")
    with pytest.raises(WF.ModelMissing):
        WF.require_model(spark, reg)
    df, _ = _frame(spark)
    WF.save_model(WF.fit_walk_forward(df, target="target"), reg)
    assert WF.require_model(spark, reg).first()["the_date"] == "2024-01-26"
    # the same date saved again: one row, the newest save
    again = WF.latest_model(WF.load_registry(spark, reg)).withColumn("intercept", F.lit(2.0))
    WF.save_model(again, reg)
    saved = WF.load_registry(spark, reg)
    assert saved.count() == saved.select("the_date").distinct().count()
    assert WF.require_model(spark, reg).first()["intercept"] == 2.0


def test_upsert_versions(spark):
    path = scratch_path(spark, "means")
    a = spark.createDataFrame([("means", 1.0), ("other", 2.0)], "_id string, v double")
    b = spark.createDataFrame([("means", 5.0)], "_id string, v double")
    assert TB.upsert(spark, a, path, ["_id"]) == 1
    assert TB.upsert(spark, b, path, ["_id"]) == 2
    got = sorted(map(tuple, TB.read_versioned(spark, path, a.schema).collect()))
    assert got == [("means", 5.0), ("other", 2.0)]
    assert TB.lookup(spark, path, a.schema, "_id", "absent").count() == 0


def test_lake_write_scan_and_missing(spark):
    base = scratch_path(spark, "lake")
    assert TB.scan_lake(spark, base, Z.SOURCE_WEATHER).count() == 0
    assert TB.unreadable_files(spark, base, Z.SOURCE_WEATHER) == []
    rows = spark.createDataFrame([(1.0, 0.0, 60.0, "2024-01-31", "2024-02-01"),
                                  (2.0, 1.0, 0.0, "2024-02-01", "2024-02-02")], Z.LAKE_WEATHER)
    TB.write_lake(rows, base, Z.SOURCE_WEATHER)
    months = sorted(d for d in os.listdir(local(TB.lake_path(base, Z.SOURCE_WEATHER))) if d.startswith("month="))
    assert months == ["month=2024_01", "month=2024_02"]
    # a corrupt file is an error unless it is to be skipped, and can be named
    with open(os.path.join(local(TB.lake_path(base, Z.SOURCE_WEATHER)), "month=2024_01", "bad.parquet"), "w") as f:
        f.write("garbage")
    with pytest.raises(Exception):
        TB.scan_lake(spark, base, Z.SOURCE_WEATHER).collect()
    back = TB.scan_lake(spark, base, Z.SOURCE_WEATHER, skip_corrupt=True)
    assert back.filter(F.col("month") == "2024_02").count() == 1 and back.count() == 2
    assert [f.rsplit("/", 1)[1] for f in TB.unreadable_files(spark, base, Z.SOURCE_WEATHER)] == ["bad.parquet"]


def test_predict_one_defaults(spark):
    coef = spark.createDataFrame([(0, "2024-01-06", 1, 0.0) + (1.0,) * 10 + (0.0,)], WF.COEF_SCHEMA)
    means = spark.createDataFrame([("means",) + (2.0,) * 10], Z.MEANS)
    r = WF.predict_one(spark, coef, means, {"open": 10.0}, "2024-02-01").first()
    assert (r["record_date"], r["open"]) == ("2024-02-01", 10.0 + 9 * 2.0)
    empty = spark.createDataFrame([], Z.MEANS)
    assert WF.predict_one(spark, coef, empty, {"open": 10.0}, "2024-02-01").first()["open"] == 10.0


def test_recorded_envelope_file(spark):
    """SRC4 + PRJ12 on a retyped recorded envelope: no date range, dates with
    blanks after the colons still give the day."""
    import json
    from signalyard.functions.dates import record_date
    from signalyard.operators.envelope import explode_items
    from signalyard.sources.envelope import read_envelope_files
    path = local(scratch_path(spark, "recorded"))
    os.makedirs(path)
    doc = {"source": "scraper_news_xtb", "time": "2024-11-06",
           "news": [{"data": "<p>Ceny kakao</p>", "date": "2024-11-06T19: 47: 29Z"},
                    {"data": "<p>Afryka</p>", "date": "2024-11-05T08: 01: 00Z"}]}
    with open(os.path.join(path, "xtb.json"), "w") as f:
        json.dump(doc, f, indent=2)
    env = read_envelope_files(spark, path)
    items = explode_items(env, "news")
    got = sorted(r[0] for r in items.select(record_date("date")).collect())
    assert got == ["2024-11-05", "2024-11-06"]
    assert items.filter(F.col("date_start").isNull()).count() == 2


def test_store_feature_means(spark):
    from signalyard.plans.frames import store_feature_means
    rows = [(dt.datetime(2024, 1, 1, h), "2024-01-01", "2024-01-02", "d", "x") + (float(h),) * 10
            for h in range(10)]
    cols = ["ctm", "date_start", "date_end", "date", "data"] + Z.FEATURES
    frame = spark.createDataFrame(rows, cols)
    path = scratch_path(spark, "means-store")
    assert store_feature_means(frame, path) == 1
    m = TB.lookup(spark, path, Z.MEANS, "_id", "means").first()
    assert m["open"] == pytest.approx(sum(range(3, 10)) / 7) and m["sentiment"] == 6.0


def test_cluster_conf_sizing():
    from signalyard.session import cluster_conf
    # no cap: 100 TB shuffled in slices of about 128 MB, in whole waves of the cores
    assert cluster_conf(100 * 2 ** 40, 8000)["spark.sql.shuffle.partitions"] == "824000"
    assert cluster_conf(10 ** 9, 8)["spark.sql.shuffle.partitions"] == "8"


def test_outer_frame_key_range_equals_filter(spark):
    """The hand-pushed day range (ML4 option) equals filtering the frame."""
    from signalyard.plans import catalog as C
    from signalyard.plans import frames
    from .conftest import SF_SMALL
    news, weather, stock = C._feeds(spark, SF_SMALL)
    a, b = "2024-01-05", "2024-01-20"
    pushed = frames.frame_in_range(frames.training_frame_outer(news, weather, stock, key_range=(a, b)), a, b)
    plain = frames.frame_in_range(frames.training_frame_outer(news, weather, stock), a, b)
    cols = [c for c in plain.columns if c != "data"]
    r = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in row)
                          for row in df.select(*cols).collect())
    assert r(pushed) == r(plain)


def test_lead_target_takes_the_next_candle(spark):
    h = [dt.datetime(2024, 1, 1, i) for i in range(4)]
    stock = spark.createDataFrame([(h[i], float(i)) for i in (0, 1, 3)], "ctm timestamp_ntz, open double")
    got = {r["ctm"].hour: r["target"] for r in WF.lead_target(stock.select("ctm"), stock).collect()}
    assert got == {0: 1.0}
    assert {r["ctm"].hour: r["target"] for r in WF.lead_target(stock.select("ctm"), stock, steps=2).collect()} == {1: 3.0}


def test_statistics_hold_at_large_offsets(spark):
    rng = np.random.default_rng(5)
    x = 1e8 + rng.normal(size=300)
    rows = [("2024-01-01", "2024-01-02", float(v), float(3 * v + 1)) for v in x]
    df = spark.createDataFrame(rows, "date_start string, date_end string, close double, target double")
    c = WF.fit_walk_forward(df, target="target", features=["close"], ridge=0.0).first()
    assert c["w_close"] == pytest.approx(3.0, abs=1e-6) and c["w_open"] == 0.0


def test_key_options_reach_every_feed(spark):
    from signalyard.plans import catalog as C
    from signalyard.plans import frames
    from .conftest import SF_SMALL
    news, weather, stock = C._feeds(spark, SF_SMALL)
    plain = frames.training_frame_inner(news, weather, stock)
    wide = frames.training_frame_inner(news, weather, stock, normalise_keys=True)
    n = news.count()
    assert plain.select("data", "date").distinct().count() < wide.select("data", "date").distinct().count() <= n
    outer = frames.training_frame_outer(news, weather, stock, key="date_start", impute=False)
    matched = outer.filter("data is not null and ctm is not null")
    assert matched.select("date").distinct().count() == news.select("date").distinct().count()
    with pytest.raises(ValueError):
        frames.training_frame_outer(news, weather, stock, key="other")
