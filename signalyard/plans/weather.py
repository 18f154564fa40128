"""PIP15: regional weather - SRC8 location dimension, DT5 date range,
WIN2 consecutive day pairs, SRT6 first element of each daily array, MTH1
weighted temperature, AGG5 two-level weighted mean.

The reference calls the weather API once per (region, day pair) and
averages in Python; here the per-region daily readings are a table and
the two averaging levels are two grouped aggregates after a
join with the location dimension (a configuration table of a few rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_range

LOCATION_SCHEMA = T.StructType([
    T.StructField("country", T.StringType()), T.StructField("country_weight", T.DoubleType()),
    T.StructField("region", T.StringType()), T.StructField("region_weight", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
])

# --- fixed values: the reference's one cocoa location ----------------------
COCOA_LOCATIONS = [("Ivory Coast", 0.4, "Soubre", 0.4, 5.46, 6.36)]


def locations(spark: SparkSession, rows=None) -> DataFrame:
    """SRC8: weighted location dimension (country -> regions -> weights)."""
    return spark.createDataFrame(rows or COCOA_LOCATIONS, LOCATION_SCHEMA)


def day_pairs(start: str, end: str, spark: SparkSession | None = None, frame: DataFrame | None = None,
              start_col: str = "start", end_col: str = "end") -> DataFrame:
    """DT5 + WIN2: (d[i], d[i+1]) for consecutive days of the inclusive
    range; start after end raises.  Either literal bounds or per-row
    bounds from ``frame``."""
    if frame is None:
        frame = spark.range(1).select(F.lit(start).alias(start_col), F.lit(end).alias(end_col))
    days = frame.select(F.explode(date_range(start_col, end_col)).alias("d"), F.to_date(end_col).alias("_e"))
    return days.filter(F.col("d") < F.col("_e")).select(
        F.date_format("d", "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.date_add("d", 1), "yyyy-MM-dd").alias("end_date"))


def regional_weather(daily: DataFrame, locs: DataFrame, day_col: str = "day") -> DataFrame:
    """AGG5: per day, per country: mean over regions of value x region
    weight, times the country weight; then the mean over countries.  Note
    the reference divides by counts, not by the sum of weights (KEEP).
    ``daily`` has one row per (day, region) with the API's daily arrays;
    the first element of each array is the day's value (SRT6, null when
    empty)."""
    j = daily.join(locs.select("region", "country", "country_weight", "region_weight"), "region")
    rw = F.col("region_weight")
    temp = (F.get("temperature_2m_min", 0) + F.get("temperature_2m_max", 0)) / 2 * rw  # MTH1
    per_country = j.groupBy(day_col, "country").agg(
        (F.avg(temp) * F.max("country_weight")).alias("temperature"),
        (F.avg(F.get("rain_sum", 0) * rw) * F.max("country_weight")).alias("rain"),
        (F.avg(F.get("sunshine_duration", 0) * rw) * F.max("country_weight")).alias("sun"))
    return per_country.groupBy(day_col).agg(
        F.avg("temperature").alias("temperature"), F.avg("rain").alias("rain"),
        F.avg("sun").alias("sun"))
