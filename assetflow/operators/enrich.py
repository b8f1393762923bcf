"""Enrichment joins: metadata, output and maintenance onto the hourly readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_assets(hourly: DataFrame, assets: DataFrame) -> DataFrame:
    """Inner join with asset metadata; the planner broadcasts it if it proves small at run time."""
    return hourly.join(assets, "asset_id", "inner")


def gold_readings(enriched: DataFrame, output: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Readings with their output and a maintenance flag (NULL -> false).

    Output is joined on ``(asset_id, window_start)``: the date is a function of
    the window start on both sides, and this key order matches how both
    aggregates are partitioned, so the sort-merge join needs no extra exchange.
    Maintenance has at most one row per (asset, day), an aggregate of the events;
    whether it is small enough to broadcast is known, and decided, at run time, so
    building the view starts no job. A day with two maintenance rows repeats the
    readings of that day, as a plain LEFT JOIN does.
    """
    o = output.select("asset_id", "window_start", "oil_output")
    m = maintenance.select("reading_date", "asset_id", F.col("maintenance").alias("_m"))
    return (enriched.join(o, ["asset_id", "window_start"], "inner").join(m, ["reading_date", "asset_id"], "left")
            .withColumn("maintenance", F.coalesce(F.col("_m"), F.lit(False)))
            .drop("_m"))
