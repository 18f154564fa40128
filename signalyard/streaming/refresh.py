"""STM7: the polling refresh of the daily serving tables as a stream.

The reference re-read the whole lake every minute and inserted days not
yet loaded.  Here a file stream over the lake drives ``foreachBatch``:
each micro-batch names the days and the lake months it touched, those days
are aggregated again from those months alone (partition pruning), and the
rows whose key is not in the serving table are appended (JN4).  A retried
batch appends nothing twice (the anti join makes it idempotent), and a
restart resumes from the checkpoint.  ``on_conflict="ignore"`` (KEEP Q5): a
day already loaded is not updated; ``"replace"``: its rows are replaced, in a
new version of the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import record_date
from ..operators.joins import rows_to_add
from ..session import materialise
from ..sinks.tables import append_table, read_table, upsert


def touched_lake(lake: DataFrame, months: list[str]) -> DataFrame:
    """The lake's rows of the given months (a filter on the partition column)."""
    return lake.filter(F.col("month").isin(months))


def start_refresh(spark: SparkSession, lake_stream: DataFrame, lake_static: Callable[[], DataFrame],
                  aggregate: Callable[[DataFrame], DataFrame], serving_path: str, keys: list[str],
                  day_source_col: str, checkpoint: str, trigger: dict | None = None,
                  on_conflict: str = "ignore") -> StreamingQuery:
    """Start the refresh query.  ``aggregate`` maps lake rows to serving rows
    (daily.count_news, daily.daily_weather, daily.daily_open); ``day_source_col``
    is the lake column the record_date comes from.  A day's rows are taken to
    lie in the months that the batch's rows of that day came from, as the lake
    puts a record under the month of its own range; where a day's rows can come
    late or lie under several months, ``deltas`` keeps the aggregates right."""
    if on_conflict not in ("ignore", "replace"):
        raise ValueError("on_conflict is 'ignore' or 'replace'")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        touched = materialise(batch.select(record_date(day_source_col, strict=False).alias("record_date"), "month")
                              .where(F.col("record_date").isNotNull()).distinct(), "touched")
        months = [r[0] for r in touched.select("month").distinct().collect()]  # bounded by the calendar
        if not months:
            return
        rows = aggregate(touched_lake(lake_static(), months)).join(touched.select("record_date"), "record_date", "left_semi")
        if on_conflict == "replace":
            upsert(spark, rows, serving_path, keys)
        else:
            append_table(rows_to_add(rows, read_table(spark, serving_path, rows.schema), keys), serving_path)

    w = lake_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
