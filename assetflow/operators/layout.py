"""File layout jobs for date-partitioned Parquet tables.

* compaction: rewrite the closed partitions (dates before a cutoff) into fewer,
  larger files, sized from the bytes they hold;
* clustering: within the rewrite, rows are range-partitioned and sorted by the
  interleaved bits of the range buckets of the columns queries filter on (asset,
  window), so Parquet min/max statistics prune row groups for either column.

The rewrite reads the closed partitions, cuts the lineage with a reliable
checkpoint (so the source files are no longer an input of the plan), then
replaces exactly those partitions with dynamic partition overwrite. Open
partitions that a stream is still appending to are never touched.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root

TARGET_FILE_BYTES = 128 * 1024 * 1024


def closed_partitions(df: DataFrame, date_col: str, before: _dt.date) -> DataFrame:
    return df.where(F.col(date_col) < F.lit(before))


def file_stats(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """Files and rows per partition (from the file names Spark reads)."""
    df = spark.read.parquet(path).withColumn("_file", F.input_file_name())
    return df.groupBy(date_col).agg(F.countDistinct("_file").alias("files"), F.count(F.lit(1)).alias("rows"))


def _streamed(spark: SparkSession, path: str) -> bool:
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def _buckets(rows: DataFrame, columns: list[str], bits: int, accuracy: int = 10_000) -> list[Column]:
    """For each column the number (0 to 2^bits - 1) of the range a value falls in; ranges hold about equally many rows.

    Range ends are approximate quantiles, a bounded sketch. Nulls are in the first range.
    """
    number = {c: F.unix_micros(F.col(c)) if isinstance(rows.schema[c].dataType, T.TimestampType) else
              F.xxhash64(c) if isinstance(rows.schema[c].dataType, T.StringType) else F.col(c) for c in columns}
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    ends = rows.agg(*[F.percentile_approx(number[c], share, accuracy).alias(f"e{i}") for i, c in enumerate(columns)]).first()
    def range_of(value: Column, found: list | None) -> Column:
        if not found:
            return F.lit(0)
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(F.array(*[F.lit(x) for x in found]), lambda e: e < value)))

    return [range_of(number[c], ends[f"e{i}"]) for i, c in enumerate(columns)]


def interleaved(rows: DataFrame, columns: list[str], bits: int = 6) -> Column:
    """The bits of the columns' range numbers, the highest of each first."""
    # a table of each number's bits set apart, so that an expression is used once per column
    apart = [sum((i >> b & 1) << (b * len(columns)) for b in range(bits)) for i in range(1 << bits)]
    table = F.array(*[F.lit(x) for x in apart])
    z = F.lit(0)
    for j, n in enumerate(_buckets(rows, columns, bits)):
        z = z + F.get(table, n) * (1 << (len(columns) - 1 - j))
    return z


def clustered(rows: DataFrame, date_col: str, columns: list[str], n: int) -> DataFrame:
    """``rows`` in about ``n`` partitions, by date and within a date by the interleaved ranges of ``columns``."""
    keyed = rows.withColumn("__z", interleaved(rows, columns)) if len(columns) > 1 else rows.withColumn("__z", F.col(columns[0]))
    return keyed.repartitionByRange(n, date_col, "__z").sortWithinPartitions(date_col, "__z", *columns).drop("__z")


def compact(spark: SparkSession, path: str, date_col: str, before: _dt.date,
            cluster_by: list[str], target_file_bytes: int = TARGET_FILE_BYTES,
            bytes_per_row: int | None = None) -> int:
    """Compact and cluster the partitions of ``path`` older than ``before`` that have too many files.

    Rows are range-partitioned by (date, clustering), so n tasks over d
    dates write at most n + d files; n follows the size of the rewritten data
    (rows times an estimated row width). Returns the rows rewritten. A table
    written by Spark's file stream sink is refused: its readers go by the sink's
    own list of files.
    """
    if _streamed(spark, path):
        raise ValueError(f"{path} is written by a file stream, whose own list of files would name the replaced ones")
    table = spark.read.parquet(path)
    width = bytes_per_row or 8 * max(1, len(table.columns))
    found = file_stats(spark, path, date_col).where(F.col(date_col) < F.lit(before))
    # dates with more files than their size needs; the others are left alone
    todo = found.where(F.col("files") > F.ceil(F.col("rows") * F.lit(width) / F.lit(target_file_bytes)))
    rows = todo.agg(F.sum("rows")).first()[0]
    if not rows:
        return 0
    closed = closed_partitions(table, date_col, before).join(todo.select(date_col), date_col, "left_semi")
    n = max(1, math.ceil(rows * width / target_file_bytes))
    checkpoint_root(spark)
    staged = clustered(closed, date_col, cluster_by, n).checkpoint(eager=True)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    return rows
