"""Telemetry tables derived from the driver's parquet tables.

``events`` becomes a stream of asset readings with nine channels, a user being an asset;
``customer``, ``nation`` and ``region`` become asset metadata; output and maintenance history are aggregates of
the events. All of it is lazy DataFrame code: the scans prune to the columns used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.columns import window_start

# --- fixed values of the mapping -----------------------------------------
MANUFACTURERS = 5        # manufacturer = 'M' || c_nationkey % 5
MAINT_MIN_K = 95         # maintenance rows: event_type = 'error' and k >= 95
# ------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    """The events table; ``before`` (a date) keeps events before its midnight.

    The bound is a plain comparison on the stored ``ts`` column, so Parquet
    skips row groups by their statistics (events arrive in time order).
    """
    e = table(spark, sf_dir, "events")
    if before is not None:
        e = e.where(F.col("ts") < F.lit(_dt.datetime.combine(before, _dt.time())).cast("timestamp_ntz"))
    return e


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def reading_columns(events: DataFrame) -> DataFrame:
    """One reading per event: ``event_time, reading_date, asset_id, sensor1..9``."""
    v = F.col("value")
    k = F.col("k").cast("double")
    return (events
            .select(F.col("ts").cast("timestamp").alias("event_time"),
                    F.col("user_id").cast("int").alias("asset_id"),
                    "event_type", "value", _k().alias("k"))
            .select("event_time",
                    F.to_date("event_time").alias("reading_date"),
                    "asset_id",
                    v.alias("sensor1"),
                    k.alias("sensor2"),
                    (v / 10).alias("sensor3"),
                    (v - k).alias("sensor4"),
                    (k / 10).alias("sensor5"),
                    (v * k / 100).alias("sensor6"),
                    F.sqrt(F.abs(v)).alias("sensor7"),
                    (-v).alias("sensor8"),
                    F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                     .otherwise(v + k).alias("sensor9")))


def readings(spark: SparkSession, sf_dir: str, before=None) -> DataFrame:
    return reading_columns(events(spark, sf_dir, before))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset metadata: ``country, manufacturer, asset_id, region``."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("country"),
                    F.concat(F.lit("M"), (F.col("c_nationkey") % MANUFACTURERS).cast("string")).alias("manufacturer"),
                    F.col("c_custkey").cast("int").alias("asset_id"),
                    F.col("r_name").alias("region")))


def output(spark: SparkSession, sf_dir: str, length: str = config.WINDOW, before=None) -> DataFrame:
    """Output per (asset, window): sum of ``value`` over all its events.

    Grouped on ``(asset_id, window_start)`` in that order, the same keys the
    hourly sensor aggregate uses, so the two can be joined without a re-shuffle.
    """
    e = events(spark, sf_dir, before)
    return (e.select(F.col("ts").cast("timestamp").alias("event_time"),
                    F.col("user_id").cast("int").alias("asset_id"), "value")
            .groupBy("asset_id", window_start("event_time", length).alias("window_start"))
            .agg(F.sum("value").alias("oil_output"))
            .select(F.to_date("window_start").alias("reading_date"), "window_start",
                    "asset_id", "oil_output"))


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maintenance history: one row per (date, asset) with a severe error."""
    e = events(spark, sf_dir)
    return (e.where((F.col("event_type") == "error"))
            .select(F.col("ts").cast("timestamp").alias("event_time"),
                    F.col("user_id").cast("int").alias("asset_id"),
                    _k().alias("k"))
            .where(F.col("k") >= MAINT_MIN_K)
            .groupBy(F.to_date("event_time").alias("reading_date"), "asset_id")
            .agg(F.bool_or(F.col("k") % 4 != 0).alias("maintenance"))
            .select("reading_date", "maintenance", "asset_id"))
