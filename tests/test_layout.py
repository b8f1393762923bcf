import datetime as dt

from pyspark.sql import functions as F

from assetflow.operators import layout
from assetflow.session import scratch_path


def test_compaction_keeps_rows_and_reduces_files(spark):
    path = scratch_path(spark, "t_layout")
    df = spark.range(0, 4000).select(
        (F.col("id") % 9).cast("int").alias("asset_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600).alias("window_start"),
        (F.col("id") * 0.5).alias("x"))
    df = df.withColumn("reading_date", F.to_date("window_start"))
    df.repartition(16).write.partitionBy("reading_date").parquet(path)
    before = {r.reading_date: r.files for r in layout.file_stats(spark, path, "reading_date").collect()}
    cutoff = dt.date(2024, 1, 20)
    n = layout.compact(spark, path, "reading_date", cutoff, ["asset_id", "window_start"])
    after = {r.reading_date: r.files for r in layout.file_stats(spark, path, "reading_date").collect()}
    assert n == df.where(F.col("reading_date") < F.lit(cutoff)).count()
    assert spark.read.parquet(path).count() == 4000
    assert spark.read.parquet(path).agg(F.sum("x")).first()[0] == df.agg(F.sum("x")).first()[0]
    for d, files in after.items():
        if d < cutoff:
            assert files == 1 and before[d] > 1
        else:
            assert files == before[d]  # open partitions untouched


def test_compaction_of_many_dates_with_several_tasks(spark):
    path = scratch_path(spark, "t_many")
    df = spark.range(0, 9000).select((F.col("id") % 50).cast("int").alias("asset_id"), (F.col("id") * 0.5).alias("x"),
                                     F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 31).cast("int")).alias("reading_date"))
    df.repartition(4).write.partitionBy("reading_date").parquet(path)
    n = layout.compact(spark, path, "reading_date", dt.date(2024, 2, 1), ["asset_id"], target_file_bytes=20_000)
    after = layout.file_stats(spark, path, "reading_date").collect()
    tasks = -(-9000 * 24 // 20_000)
    assert n == 9000 and sum(r["files"] for r in after) <= 31 + tasks < 124 and sum(r["rows"] for r in after) == 9000


def test_streamed_tables_are_refused(spark):
    import pytest

    path = scratch_path(spark, "t_streamed")
    spark.range(1).write.parquet(f"{path}/_spark_metadata")
    with pytest.raises(ValueError):
        layout.compact(spark, path, "reading_date", dt.date(2024, 2, 1), ["asset_id"])


def test_clustering_prunes_on_either_column(spark):
    """Row groups' statistics: a filter on the asset alone and one on the window alone both skip most row groups."""
    import glob

    import pyarrow.parquet as pq

    from assetflow.operators import layout
    from assetflow.session import scratch_path

    n = 64
    df = spark.range(n * n).selectExpr("cast(id % 64 as int) asset_id", "timestamp_seconds(1704067200 + cast(id / 64 as bigint) * 60) window_start",
                                       "date '2024-01-01' reading_date", "cast(id as double) x")
    path = scratch_path(spark, "t_z")
    layout.clustered(df.repartition(8), "reading_date", ["asset_id", "window_start"], 64).write.parquet(path)
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(f"{path}/*.parquet") for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(groups) >= 32

    def read(column, lo, hi):
        stats = [next(g.column(i).statistics for i in range(g.num_columns) if g.column(i).path_in_schema == column) for g in groups]
        return sum(s.min <= hi and lo <= s.max for s in stats) / len(groups)

    rows = df.where("asset_id = 17").select("window_start").collect()
    assert read("asset_id", 17, 17) <= 0.3
    # Spark writes timestamps as INT96 without statistics by default: the micros type has them
    import os
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    try:
        layout.clustered(df.repartition(8), "reading_date", ["asset_id", "window_start"], 64).write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    groups[:] = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(f"{path}/*.parquet") for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    one = rows[20].window_start.replace(tzinfo=__import__("datetime").timezone.utc)
    assert read("window_start", one, one) <= 0.3 and read("asset_id", 17, 17) <= 0.3 and os.path.isdir(path)
