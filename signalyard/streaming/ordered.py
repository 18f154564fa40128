"""STM6 / PIP14 in bounded groups: count-triggered batches of a stream whose
sources may be of any size.

A micro-batch is numbered as the batch operator WIN1 numbers a table: its steps,
and those held from before, are range-partitioned by (source, order), counted per
range, and get their positions from the prefix counts (``group_row_numbers``), so
a source spans as many tasks as it needs and batches are cut wherever their border
falls.  No Python worker and no group holds a source.

What a micro-batch leaves behind is a small table per epoch in the shared folder:

* ``held``: the messages of the last, incomplete batch of each source,
* ``next``: the number of each source's next batch, written last.

Epoch n goes on from the newest complete epoch before n, so an epoch that is run
again gives the same batches and overwrites its own tables; a restart from the
checkpoint goes on likewise.  Messages must arrive in order (as offsets do): those
of one micro-batch are sorted, and follow those held.  How much a micro-batch
holds is the trigger's bound (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import feed_kind
from ..operators.batching import group_row_numbers
from ..operators.envelope import explode_items, record_count
from ..schemas import BATCH_LIMITS, FEED_KIND
from ..session import materialise
from ..sinks.tables import _exists, _list_dirs, write_lake
from ..sources.envelope import parse_envelopes, valid
from .batcher import quarantine_path, rejected

STEP = ["date_start", "date_end"]


def _epoch(store: str, epoch: int, what: str) -> str:
    return os.path.join(store, f"epoch={epoch}", what)


def _before(spark: SparkSession, store: str, epoch: int) -> int | None:
    """The newest complete epoch before ``epoch``."""
    known = sorted((int(d[6:]) for d in _list_dirs(spark, store) if d.startswith("epoch=")), reverse=True)
    return next((e for e in known if e < epoch and _exists(spark, os.path.join(_epoch(store, e, "next"), "_SUCCESS"))), None)


def _limit(source: str, limits: dict[str, int]) -> Column:
    sizes = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    unknown = F.raise_error(F.concat(F.lit("no batch size for feed "), F.coalesce(F.col(source), F.lit("null"))))
    return F.coalesce(F.try_element_at(sizes, feed_kind(source)), unknown.cast("int"))


def release(new: DataFrame, state: str, epoch: int, order: list[str], keys: list[str] | None = None,
            limits: dict[str, int] = BATCH_LIMITS, steps: list[str] | None = None) -> DataFrame:
    """The messages of the batches that ``new`` completes, with their
    ``batch_id``; brings ``state`` to ``epoch``.

    ``new``: narrow rows (``keys``, of which the first is the source, ``order``,
    anything else that travels with a message).  ``steps``, the first of
    ``order``, say which rows are parts of one message; a part that comes after
    its step was released is a message of its own."""
    spark = new.sparkSession
    keys = keys or ["source"]
    before = _before(spark, state, epoch)
    held, next_ = None, spark.createDataFrame([], new.select(*keys).schema).withColumn("next_batch", F.lit(0).cast("long"))
    if before is not None:
        held = spark.read.schema(new.schema).parquet(_epoch(state, before, "held"))
        next_ = spark.read.schema(next_.schema).parquet(_epoch(state, before, "next"))
    messages = (new if held is None else new.unionByName(held)).withColumn("_key", F.struct(*keys))
    counted = messages.select("_key", *steps).distinct() if steps else messages
    numbered = group_row_numbers(counted, "_key", steps or order).withColumn("_size", _limit(f"_key.{keys[0]}", limits))
    numbered = numbered.withColumn("_batch", F.floor((F.col("rn") - 1) / F.col("_size"))) \
        .withColumn("_full", F.floor(F.col("_group_n") / F.col("_size")))
    full = numbered.groupBy("_key").agg(F.max("_full").alias("full")).select(*[F.col(f"_key.{k}").alias(k) for k in keys], "full")
    if steps:
        of_step = numbered.select("_key", *steps, "_batch", "_full")
        same = [F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("_key", *steps)]
        placed = messages.alias("m").join(of_step.alias("s"), same).select("m.*", "s._batch", "s._full")
    else:
        placed = numbered
    placed.filter(F.col("_batch") >= F.col("_full")).select(*new.columns).write.mode("overwrite").parquet(_epoch(state, epoch, "held"))
    following = next_.unionByName(full.withColumnRenamed("full", "next_batch")).groupBy(*keys).agg(F.sum("next_batch").alias("next_batch"))
    following.write.mode("overwrite").parquet(_epoch(state, epoch, "next"))
    done = placed.filter(F.col("_batch") < F.col("_full"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    return done.alias("d").join(next_.alias("n"), same, "left").select(
        *[F.col(f"d.{c}").alias(c) for c in new.columns], (F.coalesce("n.next_batch", F.lit(0)) + F.col("d._batch")).alias("batch_id"))


def start_batches(spark: SparkSession, messages: DataFrame, out: str, checkpoint: str, order: list[str],
                  keys: list[str] | None = None, limits: dict[str, int] = BATCH_LIMITS, steps: list[str] | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """STM6: the batches of a stream of ``messages`` (narrow, as ``release``
    takes them), written to ``out``, one ``epoch`` partition a micro-batch."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        released = release(materialise(batch, "batch"), os.path.join(checkpoint, "held"), epoch, order, keys, limits, steps)
        released.write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    w = messages.writeStream.foreachBatch(per_batch).option("checkpointLocation", os.path.join(checkpoint, "query"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_envelope_batches(spark: SparkSession, stream: DataFrame, lake_base: str, checkpoint: str,
                           trigger: dict | None = None, fmt: str = "parquet", key_cols: list[str] | None = None) -> StreamingQuery:
    """PIP14: message stream (SRC3) -> JSON decode (JSN1) -> messages that cannot
    be batched to ``<lake_base>/quarantine`` with their reason, the others to
    ``<checkpoint>/messages`` -> count-triggered batches of their places in that
    store (STM6) -> the payloads of completed batches, exploded and stamped with
    their step (PRJ9-10, ARR1) -> the source's lake schema (SNK2) -> one ``(month,
    run, epoch)`` partition of the lake a micro-batch (SNK1).

    All that a micro-batch writes is in a partition of its epoch, which a second
    try overwrites; ``run`` is the query's id, which belongs to the checkpoint, so
    a stream with a fresh checkpoint adds to a lake and overwrites nothing.  A
    payload is stored once and read once, when its batch is complete."""
    keys = ["source", *(key_cols or [])]
    store, state = os.path.join(checkpoint, "messages"), os.path.join(checkpoint, "held")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        parsed = parse_envelopes(batch, "value", keep=["value", *(key_cols or [])]).withColumn("reason", rejected())
        bad = parsed.filter("reason is not null").select("reason", F.col("value").cast("string").alias("value"))
        bad.write.mode("overwrite").parquet(os.path.join(quarantine_path(lake_base), f"run={run}", f"epoch={epoch}"))
        good = parsed.filter("reason is null").select(
            *keys, *STEP, F.md5("value").alias("msg"), record_count().alias("n_records"), F.lit(epoch).cast("long").alias("stored"),
            F.monotonically_increasing_id().alias("at"), F.col("value").cast("string").alias("value"))
        path = os.path.join(store, f"epoch={epoch}")
        good.write.mode("overwrite").parquet(path)
        places = session.read.schema(good.schema).parquet(path).drop("value")
        done = release(places, state, epoch, [*STEP, "msg"], keys, steps=STEP).checkpoint()
        # the epochs of this micro-batch and of what was held before it; a source each
        epochs = [r[0] for r in done.select("stored").distinct().collect()]
        sources = [r[0] for r in done.select("source").distinct().collect()]
        if not epochs:
            return
        payloads = session.read.schema(good.schema).parquet(*[os.path.join(store, f"epoch={e}") for e in epochs])
        for src in sources:
            mine = payloads.filter(F.col("source") == src).join(done.select("stored", "at"), ["stored", "at"], "left_semi")
            items = explode_items(valid(parse_envelopes(mine, "value")), FEED_KIND[src])
            write_lake(items.withColumn("run", F.lit(run)).withColumn("epoch", F.lit(epoch)), lake_base, src, fmt, extra_partitions=["run", "epoch"])

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", os.path.join(checkpoint, "query"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
