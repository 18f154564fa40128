"""STM6 / PIP14: count-triggered batching as a stateful stream operator.

Per key (the feed, plus the Kafka partition when there is one) the
operator buffers messages and releases them as a batch once ``N`` have
arrived (news 5, stock 10, weather 1).  State per key is the buffer, so
it never exceeds ``N - 1`` messages, plus the next batch id.  Within a
micro-batch the new messages are sorted by their order key (offset)
before they join the buffer, so the result equals the batch operator
WIN1 on the same order.  A key's new messages of one micro-batch are one
Python group, of order keys and counts alone: payloads stay in files and are
joined back on Spark.  Bound the group by the trigger
(``maxOffsetsPerTrigger``) and key by (source, partition), which spreads a source
over its topic partitions; ``streaming.ordered`` batches a source of any size
without a group.

Messages that cannot be batched - malformed, of an unknown feed, or with
another feed's payload - are never dropped: ``rejected`` names the reason
and ``ordered.start_envelope_batches`` writes them to a quarantine table."""

from __future__ import annotations

import json
import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.envelope import payload_kind
from ..schemas import BATCH_LIMITS, FEED_KIND

STATE_SCHEMA = "buffer string, next_batch long"


def _emitter(key_cols: list[str], order_cols: list[str], limits: dict[str, int], carry_cols: list[str],
             step_cols: list[str] | None):
    kept = order_cols + ["n_records"] + carry_cols

    def emit(key, frames, state):
        buffered, next_batch = state.get if state.exists else ("[]", 0)
        new = pd.concat([f[kept] for f in frames], ignore_index=True).sort_values(order_cols, kind="mergesort")
        held = pd.DataFrame(json.loads(buffered), columns=kept)
        rows = pd.concat([held.astype(new.dtypes.to_dict()), new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        # an unknown feed is the caller's to reject; it has no batch size
        n = limits[str(key[0]).split("_")[1]]
        if step_cols:  # neighbouring parts of one step are one message
            steps = rows[step_cols].astype(str)
            message = (steps != steps.shift()).any(axis=1).cumsum() - 1
        else:
            message = pd.Series(range(len(rows)))
        batches = int(message.max() + 1) // n
        whole = message < batches * n
        out, rest = rows[whole].copy(), rows[~whole]
        for c, v in zip(key_cols, key):
            out[c] = v
        out["batch_id"] = next_batch + message[whole] // n
        state.update((json.dumps(rest.astype(object).to_dict("records"), default=str), int(next_batch + batches)))
        yield out[key_cols + kept + ["batch_id"]]
    return emit


def stateful_batches(messages: DataFrame, order_cols: list[str], key_cols: list[str] | None = None,
                     limits: dict[str, int] = BATCH_LIMITS,
                     carry_cols: list[str] | None = None, step_cols: list[str] | None = None) -> DataFrame:
    """Messages (``source``, ``order_cols``, ``n_records``, ``carry_cols``)
    -> the messages of every completed batch with their ``batch_id``;
    ``carry_cols`` (e.g. where the raw message is stored, not the message
    itself) travel through the buffer.
    ``step_cols``, the first of ``order_cols``, say which rows are parts of
    one message (SNK8); a part that arrives after its step was released counts
    as a message of its own.  On a stream: output mode append."""
    key_cols = key_cols or ["source"]
    carry_cols = carry_cols or []
    cols = key_cols + order_cols + ["n_records"] + carry_cols
    m = messages.select(*cols)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.schema.fields)
    return m.groupBy(*key_cols).applyInPandasWithState(
        _emitter(key_cols, order_cols, limits, carry_cols, step_cols), f"{fields}, batch_id long", STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)


def rejected() -> Column:
    """Why a parsed message cannot be batched (PRJ2, PRJ9), null if it can."""
    feeds = F.create_map(*[x for kv in FEED_KIND.items() for x in map(F.lit, kv)])
    kind = F.try_element_at(feeds, F.coalesce("source", F.lit("")))
    return F.when(F.col("source").isNull(), F.lit("malformed")) \
        .when(kind.isNull(), F.lit("unknown source")) \
        .when(payload_kind().isNull() | (payload_kind() != kind), F.lit("payload of another kind"))


def quarantine_path(lake_base: str) -> str:
    return os.path.join(lake_base, "quarantine")
