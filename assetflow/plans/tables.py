"""Named tables and views: the view stack in the session's catalog, declared tables, snapshots, reset.

Views are lazy and belong to the session; tables live in a database of the warehouse, which on a
cluster is shared by the driver and all executors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .. import config
from .views import Views

_SENSORS = ", ".join(f"{c} DOUBLE" for c in config.CHANNELS)
#: Declared columns and partition column of each stored table.
TABLES = {
    "asset_metadata": ("country STRING, manufacturer STRING, asset_id INT, region STRING", None),
    "maintenance_history": ("reading_date DATE, maintenance BOOLEAN, asset_id INT", None),
    "asset_output": ("reading_date DATE, window_start TIMESTAMP, asset_id INT, oil_output DOUBLE", None),
    "enriched_readings": (f"asset_id INT, window_start TIMESTAMP, window_end TIMESTAMP, {_SENSORS}, "
                          "country STRING, manufacturer STRING, region STRING, reading_date DATE", "reading_date"),
}


def create_tables(spark: SparkSession, database: str) -> None:
    """The declared tables, where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, by) in TABLES.items():
        parts = f" PARTITIONED BY ({by})" if by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parts}")


def reset(spark: SparkSession, database: str) -> None:
    """Drop the database with all it holds and declare its tables anew."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    create_tables(spark, database)


def load_snapshot(spark: SparkSession, path: str, table: str, replace: bool = False) -> bool:
    """Load a stored Parquet snapshot into a declared table, by column names.

    A table that already has rows is left alone unless ``replace``; returns whether rows were written.
    """
    if not replace and not spark.table(table).isEmpty():
        return False
    target = spark.table(table).columns
    spark.read.parquet(path).select(*target).write.mode("overwrite").insertInto(table, overwrite=True)
    return True


def save_predictions(df: DataFrame, table: str, date_col: str = "reading_date") -> None:
    """Predictions as a date-partitioned table, replaced as a whole."""
    df.write.mode("overwrite").partitionBy(date_col).saveAsTable(table)


def create_views(spark: SparkSession, sf_dir: str, as_of: _dt.date = config.AS_OF) -> list[str]:
    """Temporary views of the whole stack, each replaced if it exists; returns their names."""
    v = Views(spark, sf_dir, as_of)
    frames = {"readings": v.readings, "asset_metadata": v.assets, "asset_output": v.output,
              "maintenance_history": v.maintenance, "hourly_readings": v.hourly, "enriched_readings": v.enriched,
              "gold_readings": v.gold, "asset_age": v.age, "feature_table": v.features}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
