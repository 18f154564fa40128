"""PIP12 in bounded messages, with its late rows: STM2-STM4, AGG7, JN6, SNK6.

``speed_layer`` gathers a window's items into one value, and Spark drops what
comes behind the watermark.  Here a window leaves in numbered parts of at most
``max_bytes``, and no row is dropped.  A micro-batch (epoch n) is handled by Spark
jobs over tables in the shared folder ``store``; all that it writes lies in
partitions of its epoch, which a second try overwrites, and it goes on from the
newest epoch before n that wrote its ``state``, which is written last:

* ``items``: the items that came in time, once each, by day;
* ``late``: (item, window) of each item and window that had left before the item
  came, by the watermark of the epoch before (STM4), and items without a time;
* ``parts``: of each window that closes now and has items of both sides (JN6), the
  items of a side in parts (``operators.parts``), so a window that holds a third of
  all items is many rows made by many tasks, and ``windows``, its table of
  contents: items and parts of each side;
* ``state``: the latest time of each side, and up to which end windows have left.

The watermark is the smaller of both sides' latest times, less the delay, as Spark
has it for a join.  A window leaves in the epoch whose data lift the watermark over
its end.  ``corrected`` makes the parts of the windows with late rows again, of all
their rows; a window that late rows give its second side is among them."""

from __future__ import annotations

import os
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.parts import bounded_parts
from ..session import materialise
from ..sinks.tables import _exists, _list_dirs
from ..sources.envelope import parse_envelopes, valid
from .speed_layer import SLIDE, WATERMARK, WINDOW, _SIDES, side_items

MAX_BYTES = 900_000
SIDES = list(_SIDES)
_STATE = "news_list long, stock_list long, left long"  # microseconds
#: Item as JSON; ``day`` and ``epoch`` are the partitions.
_ITEMS = "side string, at timestamp, item string, day date, epoch long"
_LATE = "side string, at timestamp, item string, window_start timestamp, stored boolean, epoch long"
_PARTS = "window_start timestamp, window_end timestamp, side string, part long, n_items long, n_bytes long, items array<string>, epoch long"
_WINDOWS = "window_start timestamp, window_end timestamp, side string, n_items long, n_parts long, epoch long"


class Windows(NamedTuple):
    """Length, slide and delay of the windows (interval strings), and the bound of
    a part."""
    length: str = WINDOW
    slide: str = SLIDE
    delay: str = WATERMARK
    max_bytes: int = MAX_BYTES


def items_of(messages: DataFrame) -> DataFrame:
    """PRJ1-PRJ7 of both sides: (side, at, item), the item as JSON."""
    parsed = valid(parse_envelopes(messages, "value"))
    sides = [side_items(parsed, s).select(F.lit(s).alias("side"), "at", F.to_json("item").alias("item")) for s in SIDES]
    return sides[0].unionByName(sides[1])


def in_windows(items: DataFrame, w: Windows) -> DataFrame:
    """Each item once for each window it lies in (window_start, window_end)."""
    return items.withColumn("_w", F.window("at", w.length, w.slide)).select(
        "*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")).drop("_w")


def _path(store: str, what: str, epoch: int | None = None) -> str:
    return os.path.join(store, what, *([f"epoch={epoch}"] if epoch is not None else []))


def _state_before(spark: SparkSession, store: str, epoch: int) -> dict:
    """The newest complete state before ``epoch``: one row."""
    known = sorted((int(d[6:]) for d in _list_dirs(spark, _path(store, "state")) if d.startswith("epoch=")), reverse=True)
    for e in known:
        if e < epoch and _exists(spark, os.path.join(_path(store, "state", e), "_SUCCESS")):
            return spark.read.schema(_STATE).parquet(_path(store, "state", e)).first().asDict()
    return {"news_list": None, "stock_list": None, "left": None}


def _table(spark: SparkSession, store: str, what: str, schema: str) -> DataFrame:
    if not _list_dirs(spark, _path(store, what)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_path(store, what))


def _stamp(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _parts(rows: DataFrame, w: Windows) -> tuple[DataFrame, DataFrame]:
    """Parts and contents of the windows of ``rows`` (side, item, window_start,
    window_end) that have items of both sides."""
    rows = rows.select("window_start", "window_end", "side", "item")
    # one row a window and side
    counts = rows.groupBy("window_start", "window_end", "side").agg(F.count(F.lit(1)).alias("n_items"))
    both = materialise(counts.groupBy("window_start").agg(F.count(F.lit(1)).alias("sides")).filter(F.col("sides") == len(SIDES))
                       .select("window_start"), "joined-windows")
    kept = rows.join(both, "window_start", "left_semi")
    parts = materialise(bounded_parts(kept, ["window_start", "window_end", "side"], w.max_bytes), "window-parts").select(
        "window_start", "window_end", "side", "part", "n_items", "n_bytes", "items")
    contents = parts.groupBy("window_start", "window_end", "side").agg(F.sum("n_items").alias("n_items"), F.count(F.lit(1)).alias("n_parts"))
    return parts, contents


def handle(batch: DataFrame, store: str, epoch: int, w: Windows) -> None:
    """One micro-batch of items (side, at, item)."""
    spark = batch.sparkSession
    before = _state_before(spark, store, epoch)
    left = before["left"]
    items = materialise(batch.select("side", "at", "item"), "window-items")
    timed = items.filter("at is not null")
    gone = in_windows(timed, w).filter(F.col("window_end") <= _stamp(left)) if left is not None else None
    # an item is stored if one of its windows is still open
    open_ = timed if left is None else timed.filter(_last_end(w) > _stamp(left))
    open_.withColumn("day", F.to_date("at")).write.mode("overwrite").partitionBy("day").parquet(_path(store, "items", epoch))
    no_time = items.filter("at is null").select("side", "at", "item", F.lit(None).cast("timestamp").alias("window_start"), F.lit(False).alias("stored"))
    late = no_time if gone is None else no_time.unionByName(
        gone.select("side", "at", "item", "window_start", (_last_end(w) > _stamp(left)).alias("stored")))
    late.write.mode("overwrite").parquet(_path(store, "late", epoch))
    latest = {r["side"]: r["at"] for r in timed.groupBy("side").agg(F.max(F.unix_micros("at")).alias("at")).collect()}  # a row a side
    now = {s: max((t for t in (before[s], latest.get(s)) if t is not None), default=None) for s in SIDES}
    reached = None
    if None not in now.values():
        watermark = _stamp(min(now.values())) - F.expr(f"INTERVAL {w.delay}")
        reached = spark.range(1).select(F.unix_micros(watermark).alias("t")).first()["t"]
        reached = reached if left is None else max(left, reached)
        parts, contents = _parts(_closing(spark, store, epoch, left, reached, w), w)
        parts.write.mode("overwrite").parquet(_path(store, "parts", epoch))
        contents.write.mode("overwrite").parquet(_path(store, "windows", epoch))
    spark.createDataFrame([(*[now[s] for s in SIDES], reached)], _STATE).coalesce(1).write.mode("overwrite").parquet(_path(store, "state", epoch))


def _last_end(w: Windows) -> Column:
    """End of the last window that a row lies in: the one that starts at its slide."""
    return F.window("at", w.slide).start + F.expr(f"INTERVAL {w.length}")


def _closing(spark: SparkSession, store: str, epoch: int, left: int | None, reached: int, w: Windows) -> DataFrame:
    """The stored rows of the windows that end after ``left``, at ``reached`` at the latest."""
    stored = _table(spark, store, "items", _ITEMS).filter(F.col("epoch") <= epoch)
    span = F.expr(f"INTERVAL {w.length}")
    stored = stored.filter((F.col("day") <= F.to_date(_stamp(reached))) & (F.col("at") < _stamp(reached)))
    if left is not None:
        stored = stored.filter((F.col("day") >= F.to_date(_stamp(left) - span)) & (F.col("at") >= _stamp(left) - span))
    rows = in_windows(stored, w).filter(F.col("window_end") <= _stamp(reached))
    if left is not None:
        rows = rows.filter(F.col("window_end") > _stamp(left))
    return rows


def start_windows(spark: SparkSession, source: DataFrame, store: str, checkpoint: str, windows: Windows = Windows(),
                  trigger: dict | None = None) -> StreamingQuery:
    """PIP12: raw messages (``value``) -> items of both sides -> windows in parts."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        handle(items_of(batch), store, epoch, windows)

    q = source.select("value").writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"availableNow": True})).start()


def read_parts(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """All parts that have left, and the contents of their windows."""
    return _table(spark, store, "parts", _PARTS), _table(spark, store, "windows", _WINDOWS)


def read_items(spark: SparkSession, store: str) -> DataFrame:
    """The items that came in time for a window, once each."""
    return _table(spark, store, "items", _ITEMS)


def read_late(spark: SparkSession, store: str) -> DataFrame:
    """STM4: the rows that came behind the watermark, one for each window that
    had left, and those without a time."""
    return _table(spark, store, "late", _LATE)


def corrected(spark: SparkSession, store: str, windows: Windows = Windows()) -> tuple[DataFrame, DataFrame]:
    """Parts and contents of the windows that have late rows, of all their rows:
    those in time are among the stored items, and so are late ones that came in
    time for a later window."""
    late = materialise(read_late(spark, store).filter("window_start is not null"), "late")
    touched = materialise(late.select("window_start").distinct(), "touched-windows")
    length = F.expr(f"INTERVAL {windows.length}")
    stored = in_windows(_table(spark, store, "items", _ITEMS), windows).join(touched, "window_start", "left_semi")
    rows = stored.select("side", "item", "window_start", "window_end").unionByName(
        late.filter(~F.col("stored")).select("side", "item", "window_start", (F.col("window_start") + length).alias("window_end")))
    return _parts(rows, windows)
