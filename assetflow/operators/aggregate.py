"""Aggregates over readings.

Every aggregate here is a hash aggregate with a map-side partial step, so a hot
asset is pre-combined inside each input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import avg_channels, window_start


def with_reading_date(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Bronze projection: add the calendar date used to partition tables."""
    return df.withColumn("reading_date", F.to_date(ts))


def hourly_min(readings: DataFrame, ts: str = "event_time") -> DataFrame:
    """Minimum of the first two channels per truncated hour."""
    hour = F.date_trunc("hour", ts)
    return (readings.groupBy(hour.alias("event_hour"))
            .agg(F.min("sensor1").alias("sensor1"), F.min("sensor2").alias("sensor2"))
            .select("sensor1", "sensor2", "event_hour"))


def count_by_asset(readings: DataFrame) -> DataFrame:
    """Non-null counts per asset (``count(col)`` skips NULLs), ordered by asset."""
    return (readings.groupBy("asset_id")
            .agg(F.count("sensor1").alias("n_sensor1"), F.count("sensor9").alias("n_sensor9"))
            .orderBy("asset_id"))


def windowed_avg(readings: DataFrame, length: str = config.WINDOW,
                 channels: list[str] = config.CHANNELS, ts: str = "event_time") -> DataFrame:
    """Mean of every channel per (asset, tumbling window).

    The calendar date is derived from the window start, so a window never splits
    over two dates (the date is not an independent group key).

    On a stream the group key is the ``window`` struct itself: it carries the
    event-time watermark, which is what lets Spark drop late rows and evict
    closed windows from the state store (a flat start column would keep every
    window in state forever). In batch the flat start is the key, so the
    result stays hash-partitioned on ``(asset_id, window_start)`` for joins.
    """
    if readings.isStreaming:
        agg = (readings.groupBy("asset_id", F.window(ts, length).alias("window"))
               .agg(*avg_channels(channels))
               .select("asset_id", F.col("window.start").alias("window_start"),
                       F.col("window.end").alias("window_end"), *channels))
    else:
        agg = (readings.groupBy("asset_id", window_start(ts, length).alias("window_start"))
               .agg(*avg_channels(channels))
               .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {length}")))
    return agg.select("asset_id", F.to_date("window_start").alias("reading_date"), "window_start",
                      "window_end", *channels)


def date_bounds(df: DataFrame, col: str = "reading_date") -> DataFrame:
    """Global first and last date (one row)."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def reading_dates(df: DataFrame) -> DataFrame:
    """Distinct (date, asset) pairs."""
    return df.select("reading_date", "asset_id").distinct()


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One surviving row per key: the one greatest by ``order`` (a total order).

    ``max_by`` over a struct is a partial aggregate, so a key holding a large
    share of the rows is reduced per partition before it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")
