"""STM7, maintained: the daily aggregates as a store of mergeable parts.

A refresh that aggregates touched days again must read all of a day's rows, and
those can lie under any month of the lake.  Here a micro-batch is aggregated once,
as it comes, into partial aggregates (counts, sums, numbers of non-null values)
per day and source, and these are kept:

* ``<store>/deltas/run=<query>/epoch=<n>``: the parts of one micro-batch.  ``run``
  is the query's id, which belongs to the checkpoint; a micro-batch that is run
  again overwrites its own partition, so nothing counts twice.
* ``<store>/base/v=<n>/rows`` and ``.../covered``: what ``compact`` made of all
  parts up to the epochs listed in ``covered``, which is written last; a version
  without it is not there.

A reader sums the newest base and the parts it does not cover: late files change
the days they belong to, whenever and under whichever month they come, and the lake
is read once.  Deltas are a row per day, source and micro-batch, so merging shuffles
few rows; ``vacuum`` removes parts that the version before the newest covers, so a
reader that has begun keeps its files."""

from __future__ import annotations

import os
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import record_date
from ..sinks.tables import _exists, _list_dirs


class Aggregate(NamedTuple):
    """``keys`` of the serving rows; ``day``: the lake column that record_date
    comes from; ``parts``: name and SQL of each partial, an aggregate of the lake
    rows whose values add up; ``serve``: name and SQL of the serving columns, of
    the added partials."""
    keys: list[str]
    day: str
    parts: dict[str, str]
    serve: dict[str, str]


#: PIP1: articles of a day and source, those with a text, and their mean length.
NEWS = Aggregate(["record_date", "source"], "date",
                 {"n": "count(1)", "n_text": "count(data)", "chars": "sum(length(data))"},
                 {"count": "n", "n_text": "n_text", "mean_chars": "try_divide(chars, n_text)"})
#: PIP2: mean temperature, summed rain and sun of a day.
WEATHER = Aggregate(["record_date"], "date_start",
                    {"t_sum": "sum(temperature)", "t_n": "count(temperature)", "rain_sum": "sum(rain)", "sun_sum": "sum(sun)"},
                    {"temperature": "try_divide(t_sum, t_n)", "rain": "coalesce(rain_sum, 0.0D)", "sun": "coalesce(sun_sum, 0.0D)"})


def partials(rows: DataFrame, aggregate: Aggregate) -> DataFrame:
    """The parts that lake ``rows`` add (rows without a valid day are left out)."""
    dated = rows.withColumn("record_date", record_date(aggregate.day, strict=False)).filter(F.col("record_date").isNotNull())
    return dated.groupBy(*aggregate.keys).agg(*[F.expr(sql).alias(name) for name, sql in aggregate.parts.items()])


def _summed(parts: DataFrame, aggregate: Aggregate) -> DataFrame:
    return parts.groupBy(*aggregate.keys).agg(*[F.sum(name).alias(name) for name in aggregate.parts])


def _deltas(store: str) -> str:
    return os.path.join(store, "deltas")


def _base(store: str, version: int, what: str) -> str:
    return os.path.join(store, "base", f"v={version}", what)


def versions(spark: SparkSession, store: str) -> tuple[list[int], int]:
    """Complete versions of the base, oldest first, and the next free number."""
    seen = sorted(int(d[2:]) for d in _list_dirs(spark, os.path.join(store, "base")) if d.startswith("v="))
    done = [v for v in seen if _exists(spark, os.path.join(_base(store, v, "covered"), "_SUCCESS"))]
    return done, (seen[-1] + 1 if seen else 1)


def _covered(spark: SparkSession, store: str, version: int) -> dict[str, int]:
    # one row for each query that has ever written to the store
    return {r["run"]: r["epoch"] for r in spark.read.parquet(_base(store, version, "covered")).collect()}


def open_epochs(spark: SparkSession, store: str, covered: dict[str, int]) -> dict[str, list[int]]:
    """The completely written epochs of each run that ``covered`` does not name;
    at most those since the last compaction."""
    out = {}
    for folder in _list_dirs(spark, _deltas(store)):
        run, path = folder[4:], os.path.join(_deltas(store), folder)
        new = sorted(int(e[6:]) for e in _list_dirs(spark, path) if e.startswith("epoch=") and int(e[6:]) > covered.get(run, -1))
        done = [e for e in new if _exists(spark, os.path.join(path, f"epoch={e}", "_SUCCESS"))]
        if done:
            out[run] = done
    return out


def _parts(spark: SparkSession, store: str, epochs: dict[str, list[int]]) -> DataFrame | None:
    """The parts of these epochs; a filter on the partition columns."""
    if not epochs:
        return None
    parts = spark.read.schema(_delta_schema(spark, store)).parquet(_deltas(store))
    wanted = F.lit(False)
    for run, some in epochs.items():
        wanted = wanted | ((F.col("run") == run) & F.col("epoch").isin(some))
    return parts.filter(wanted)


def _delta_schema(spark: SparkSession, store: str) -> T.StructType:
    found = spark.read.parquet(_deltas(store)).schema
    kinds = {"run": T.StringType(), "epoch": T.LongType()}
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.fields])


def _all_parts(spark: SparkSession, store: str, aggregate: Aggregate, base: int | None, epochs: dict[str, list[int]]) -> DataFrame | None:
    names = [*aggregate.keys, *aggregate.parts]
    parts = _parts(spark, store, epochs)
    if base is None:
        return parts and parts.select(*names)
    rows = spark.read.parquet(_base(store, base, "rows")).select(*names)
    return rows if parts is None else rows.unionByName(parts.select(*names))


def read_daily(spark: SparkSession, store: str, aggregate: Aggregate) -> DataFrame | None:
    """The serving rows: ``keys`` and the ``serve`` columns; None of a store that
    nothing has been written to."""
    done, _ = versions(spark, store)
    covered = _covered(spark, store, done[-1]) if done else {}
    parts = _all_parts(spark, store, aggregate, done[-1] if done else None, open_epochs(spark, store, covered))
    if parts is None:
        return None
    return _summed(parts, aggregate).select(*aggregate.keys, *[F.expr(sql).alias(name) for name, sql in aggregate.serve.items()])


def compact(spark: SparkSession, store: str, aggregate: Aggregate) -> int | None:
    """A new version of the base that holds all parts written so far; its number,
    or None if there is nothing new.  What is written meanwhile stays open, and so
    does all that a run wrote after an epoch that is not complete."""
    done, free = versions(spark, store)
    covered = _covered(spark, store, done[-1]) if done else {}
    epochs = {}
    for run, some in open_epochs(spark, store, covered).items():
        first = covered.get(run, -1) + 1  # a run's epochs have no gaps
        whole = [e for i, e in enumerate(some) if e == first + i]
        if whole:
            epochs[run] = whole
    if not epochs:
        return None
    parts = _all_parts(spark, store, aggregate, done[-1] if done else None, epochs)
    _summed(parts, aggregate).write.parquet(_base(store, free, "rows"))
    now = {**covered, **{run: some[-1] for run, some in epochs.items()}}
    spark.createDataFrame(sorted(now.items()), "run string, epoch long").coalesce(1).write.parquet(_base(store, free, "covered"))
    return free


def vacuum(spark: SparkSession, store: str) -> int:
    """Deletes the parts that the version before the newest covers, and older
    versions of the base; the number of folders deleted.  The newest version's
    own parts stay for readers that began before it."""
    done, _ = versions(spark, store)
    if len(done) < 2:
        return 0
    covered = _covered(spark, store, done[-2])
    gone = [os.path.join(_deltas(store), f"run={run}", e) for run, epoch in covered.items()
            for e in _list_dirs(spark, os.path.join(_deltas(store), f"run={run}")) if e.startswith("epoch=") and int(e[6:]) <= epoch]
    gone += [os.path.join(store, "base", f"v={v}") for v in done[:-2]]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in gone:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)


def write_delta(batch: DataFrame, store: str, aggregate: Aggregate, run: str, epoch: int) -> None:
    """The parts of one micro-batch, in place of those that an earlier try of it wrote."""
    partials(batch, aggregate).write.mode("overwrite").parquet(os.path.join(_deltas(store), f"run={run}", f"epoch={epoch}"))


def start_maintained(spark: SparkSession, lake_stream: DataFrame, store: str, aggregate: Aggregate, checkpoint: str,
                     trigger: dict | None = None, compact_every: int = 100,
                     after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Keeps ``store`` up to date with the rows of ``lake_stream``; compacts it
    every so many micro-batches.  ``after`` is called with each epoch's number."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_delta(batch, store, aggregate, run, epoch)
        if (epoch + 1) % compact_every == 0 and compact(batch.sparkSession, store, aggregate):
            vacuum(batch.sparkSession, store)
        if after:
            after(epoch)

    w = lake_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
