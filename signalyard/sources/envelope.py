"""Envelope reading: SRC4 (JSON documents), SRC5 (backslash repair),
PRJ1 (binary -> string), PRJ2 (from_json with the declared schema),
PRJ3 (star expansion), and the quarantine of malformed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as Z
from ..functions.text import strip_backslashes


def read_envelope_files(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """SRC4: recorded envelopes, one JSON document per file (multiLine)."""
    return spark.read.schema(Z.ENVELOPE).option("multiLine", multiline).json(path)


def parse_envelopes(raw: DataFrame, value_col: str = "value", repair: bool = False,
                    keep: list[str] | None = None) -> DataFrame:
    """PRJ1-PRJ3 (+SRC5 with ``repair``): message value -> envelope columns.
    Malformed JSON gives an all-null envelope (``source`` null) - route
    those with ``quarantine``.  ``keep`` carries extra columns (offset,
    partition, ...) through."""
    keep = keep or []
    s = F.col(value_col).cast("string")
    if repair:
        s = strip_backslashes(s)
    p = raw.select(*keep, s.alias("_json"))
    p = p.select(*keep, "_json", F.from_json("_json", Z.ENVELOPE).alias("_e"))
    return p.select(*keep, "_e.*", "_json")


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("source").isNotNull()).drop("_json")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that did not parse (kept whole for inspection)."""
    return parsed.filter(F.col("source").isNull()).select("_json")
