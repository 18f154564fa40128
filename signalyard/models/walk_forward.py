"""Walk-forward regression over 5-day intervals: ML2 (fit), ML3 (fit then
score the same interval), ML4 (historical scoring), ML5 (single and
stream prediction), ML6 (registry), MTH2-MTH3, AGG10.

The reference continues training one network interval after interval.
Here the model after interval k is the (ridge-stabilised) least-squares
fit on every row of intervals 0..k.  All those fits come from one
distributed pass: rows -> per-interval sufficient statistics (sums of
x x^T, x y, y y and counts; a partial aggregate per task, so a hot
interval is pre-combined before the shuffle) -> running sums over the
intervals -> a small solve per interval on the driver.  The driver only
ever holds (#intervals x ~80) numbers; the number of intervals is the
time span divided by five days, independent of the row count.  Scoring
is a broadcast join of the coefficient table (one row per interval,
bounded the same way) and a linear expression in whole-stage codegen.

The model family differs from the reference's LSTM (SURVEY R5): values
are not comparable, the contract is - one prediction per input row,
clamped at zero (ReLU), NaN/null -> 0, a loss per interval, a model per
interval end date, the latest model found through the log."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.intervals import assign_intervals
from ..schemas import FEATURES
from ..session import materialise

RIDGE = 1e-6
#: Intervals whose statistics the driver takes: 1,300 years of 5-day intervals.
MAX_INTERVALS = 100_000

COEF_SCHEMA = T.StructType(
    [T.StructField("interval", T.LongType()), T.StructField("the_date", T.StringType()),
     T.StructField("n_rows", T.LongType()), T.StructField("intercept", T.DoubleType())] +
    [T.StructField(f"w_{c}", T.DoubleType()) for c in FEATURES] +
    [T.StructField("train_loss", T.DoubleType())])


def _design(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """IMP3: features and target with null/NaN -> 0.0."""
    z = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.select("*", *[z(c).alias(f"_x{i}") for i, c in enumerate(features)],
                     z(target).alias("_y"))


def overall_means(df: DataFrame, features: list[str], target: str) -> dict[str, float]:
    """One constant per design column (its mean), to subtract before squares are
    summed: prices near 10,000 would otherwise cancel most digits."""
    names = [f"_x{i}" for i in range(len(features))] + ["_y"]
    row = _design(df, features, target).agg(*[F.avg(c).alias(c) for c in names]).first()
    return {c: float(row[c] or 0.0) for c in names}


def interval_stats(df: DataFrame, features: list[str], target: str,
                   shifts: dict[str, float] | None = None) -> DataFrame:
    """Per-interval sufficient statistics of the augmented design [1, x], each
    column less its shift."""
    d = _design(df, features, target)
    for c, shift in (shifts or {}).items():
        d = d.withColumn(c, F.col(c) - F.lit(shift))
    xs = [F.lit(1.0)] + [F.col(f"_x{i}") for i in range(len(features))]
    aggs = [F.count(F.lit(1)).alias("n")]
    p = len(xs)
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.sum(xs[i] * xs[j]).alias(f"g_{i}_{j}"))
        aggs.append(F.sum(xs[i] * F.col("_y")).alias(f"b_{i}"))
    aggs.append(F.sum(F.col("_y") * F.col("_y")).alias("yy"))
    return d.groupBy("interval", "interval_end").agg(*aggs)


def _solve(G: np.ndarray, b: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge-stabilised normal equations on the centred problem, so the
    intercept is not penalised and scale differences are absorbed."""
    n = G[0, 0]
    mx = G[0, 1:] / n
    my = b[0] / n
    C = G[1:, 1:] / n - np.outer(mx, mx)
    c = b[1:] / n - mx * my
    d = np.diag(C).copy()
    d[d <= 0] = 1.0
    w = np.linalg.solve(C + ridge * np.diag(d) + 1e-12 * np.eye(len(c)), c)
    return np.concatenate([[my - w @ mx], w])


def fit_walk_forward(frame: DataFrame, origin: str | None = None, target: str = "open",
                     features: list[str] = FEATURES, ridge: float = RIDGE,
                     cumulative: bool = True) -> DataFrame:
    """ML2: one model per interval (fit on intervals <= k, or on interval k
    alone with ``cumulative=False``), named by the interval end date, with
    its in-sample loss on interval k (AGG10).  Returns the coefficient
    table (COEF_SCHEMA)."""
    spark = frame.sparkSession
    rows = assign_intervals(frame, origin)
    shifts = overall_means(rows, features, target)
    shift_x, shift_y = np.array([shifts[f"_x{i}"] for i in range(len(features))]), shifts["_y"]
    # one row per interval that has rows
    stats = interval_stats(rows, features, target, shifts).orderBy("interval").limit(MAX_INTERVALS + 1).collect()
    if len(stats) > MAX_INTERVALS:
        raise ValueError(f"more than {MAX_INTERVALS} intervals; is there a wrong date?")
    p = len(features) + 1
    G_run, b_run = np.zeros((p, p)), np.zeros(p)
    out = []
    for r in stats:
        G, b = np.zeros((p, p)), np.zeros(p)
        for i in range(p):
            for j in range(i, p):
                G[i, j] = G[j, i] = r[f"g_{i}_{j}"]
            b[i] = r[f"b_{i}"]
        if cumulative:
            G_run, b_run = G_run + G, b_run + b
            Gf, bf = G_run, b_run
        else:
            Gf, bf = G, b
        w = _solve(Gf, bf, ridge)
        sse = r["yy"] - 2 * w @ b + w @ G @ w
        loss = max(float(sse), 0.0) / r["n"]
        weights = dict(zip(features, w[1:]))
        out.append((int(r["interval"]), r["interval_end"].isoformat(), int(r["n"]),
                    float(w[0] + shift_y - w[1:] @ shift_x), *[float(weights.get(c, 0.0)) for c in FEATURES], loss))
    return spark.createDataFrame(out, COEF_SCHEMA)


def prediction(coef_prefix: str = "", features: list[str] = FEATURES) -> Column:
    """MTH2 + MTH3: intercept + w.x (inputs null/NaN -> 0.0), clamped at
    zero; a NaN or null result becomes 0.0."""
    z = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    lin = F.col(f"{coef_prefix}intercept")
    for c in features:
        lin = lin + F.col(f"{coef_prefix}w_{c}") * z(c)
    p = F.greatest(lin, F.lit(0.0))
    return F.coalesce(F.nanvl(p, F.lit(0.0)), F.lit(0.0))


def fit_and_score(frame: DataFrame, origin: str | None = None, target: str = "open",
                  features: list[str] = FEATURES, ridge: float = RIDGE) -> tuple[DataFrame, DataFrame]:
    """ML3: fit through each interval, score that interval's rows with its
    model.  Returns (predictions, model log): predictions carry
    ``record_date`` (date_start as 'yyyy-MM-dd'), ``interval`` and
    ``predicted_open``; the log has (the_date, loss) with the loss the
    MSE of those predictions (AGG10).  The frame's columns that are needed are
    written once for the statistics and the scores."""
    needed = dict.fromkeys(["date_start", "date_end", *features, target])
    frame = materialise(frame.select(*needed), "model-frame")
    coef = fit_walk_forward(frame, origin, target, features, ridge)
    rows = assign_intervals(frame, origin)
    # one row per interval, at most MAX_INTERVALS
    scored = rows.join(F.broadcast(coef.drop("n_rows", "train_loss")), "interval") \
        .withColumn("predicted_open", prediction("", features))
    preds = scored.select(F.date_format(F.col("date_start"), "yyyy-MM-dd").alias("record_date"),
                          "interval", "predicted_open", F.col(target).cast("double").alias("actual"))
    log = preds.groupBy("interval").agg(
        F.avg((F.col("predicted_open") - F.coalesce(F.col("actual"), F.lit(0.0))) ** 2).alias("loss")) \
        .join(F.broadcast(coef.select("interval", "the_date")), "interval") \
        .select("the_date", "loss")
    return preds.drop("actual"), log


def lead_target(frame: DataFrame, stock: DataFrame, steps: int = 1, step: str = "1 hour",
                name: str = "target") -> DataFrame:
    """ML2 option ``target_lead``: the frame's rows with the opening price of
    the candle ``steps`` later as ``name``, so that a model predicts it rather
    than copies its own input; rows without such a candle are left out."""
    ahead = stock.select((F.col("ctm") - steps * F.expr(f"INTERVAL {step}")).alias("ctm"), F.col("open").alias(name))
    return frame.join(ahead, "ctm")


def latest_model(coef: DataFrame) -> DataFrame:
    """SRT2/ML6: the model with the largest ``the_date`` (one row)."""
    return coef.orderBy(F.col("the_date").desc()).limit(1)


class ModelMissing(RuntimeError):
    """No model in the registry (the reference answers 'Model does not exist')."""


def score_with(df: DataFrame, model: DataFrame, features: list[str] = FEATURES,
               out: str = "predicted_open") -> DataFrame:
    """ML4/ML5: score any frame (static or streaming) with a one-row model
    attached as a scalar subquery (no join, evaluated once).  The
    prediction is a column of the scored row itself (ARR2: no zipping of
    rows with a separate prediction list)."""
    s = model.limit(1).select(F.struct(*model.columns)).scalar()
    d = df.withColumn("_model", s)
    return d.withColumn(out, prediction("_model.", features)).drop("_model")


def save_model(coef: DataFrame, registry: str) -> None:
    """ML6: upsert models by ``the_date`` (SNK4): one row per interval end, the
    newest save in place of an older one - the log (the_date, loss) is a
    projection of the same table."""
    from ..sinks.tables import upsert
    upsert(coef.sparkSession, coef, registry, ["the_date"])


def load_registry(spark: SparkSession, registry: str) -> DataFrame:
    from ..sinks.tables import read_versioned
    return read_versioned(spark, registry, COEF_SCHEMA)


def require_model(spark: SparkSession, registry: str) -> DataFrame:
    """Latest model or ``ModelMissing``."""
    m = latest_model(load_registry(spark, registry))
    if m.limit(1).count() == 0:
        raise ModelMissing("Model does not exist")
    return m


def predict_one(spark: SparkSession, model: DataFrame, means: DataFrame, inputs: dict,
                prediction_date: str | None = None) -> DataFrame:
    """ML5: one prediction from query-style inputs; missing inputs take
    the stored means, else 0.0 (IMP4).  Returns (record_date, open) ready
    to append to the predictions table; the date defaults to today."""
    from ..operators.joins import with_defaults
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in FEATURES])
    req = spark.createDataFrame([tuple(inputs.get(c) for c in FEATURES)], schema)
    filled = with_defaults(req, means, FEATURES)
    day = F.lit(prediction_date) if prediction_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    return score_with(filled, model).select(day.alias("record_date"),
                                            F.col("predicted_open").alias("open"))
