"""Upsert and change feed on plain Parquet, as an append-only change log.

Open Spark cannot MERGE into Parquet, so a keyed table is kept as a log of
versions: each upsert appends its rows under ``_commit_version = v``. Writing
uses dynamic partition overwrite, so replaying version ``v`` replaces it and
an at-least-once writer (``foreachBatch``) stays idempotent. Readers derive:

* ``current``      the newest row per key (what a MERGE would leave behind),
* ``change_feed``  insert / update_preimage / update_postimage rows per version,
* ``latest_change`` the newest non-preimage change per key in a feed slice.

No write ever reads or rewrites the target, so an upsert costs one append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VERSION = "_commit_version"
TIMESTAMP = "_commit_timestamp"
CHANGE = "_change_type"
META = [CHANGE, VERSION, TIMESTAMP]


def stamp(df: DataFrame, version: int) -> DataFrame:
    return (df.withColumn(VERSION, F.lit(int(version)).cast("long"))
              .withColumn(TIMESTAMP, F.current_timestamp()))


def append_version(df: DataFrame, log_path: str, version: int) -> None:
    """Write ``df`` as version ``version`` of the log (replay-safe)."""
    (stamp(df, version).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(VERSION).parquet(log_path))


def read_log(spark, log_path: str) -> DataFrame:
    """Read a change log; the version comes back from directory names, whose
    type inference narrows it, so it is restored to BIGINT."""
    return spark.read.parquet(log_path).withColumn(VERSION, F.col(VERSION).cast("long"))


def current(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key.

    ``max_by`` keeps one row per key with a partial aggregate on each side of
    the shuffle, so a key with many versions is reduced before it moves.
    """
    vals = [c for c in log.columns if c not in keys and c not in META]
    return (log.groupBy(*keys)
            .agg(F.max_by(F.struct(*vals), F.col(VERSION)).alias("_row"))
            .select(*keys, "_row.*"))


def fold(log: DataFrame, keys: list[str], snapshot_path: str) -> int:
    """Write the current state as a snapshot (a base) and return the version it covers.

    Reads after a fold take the base plus only the newer log versions
    (``current_from``), so the cost of ``current`` stops growing with history;
    partitions up to the base version are no longer read.
    """
    through = log.agg(F.max(VERSION)).first()[0]  # one value
    if through is None:
        return -1
    (current(log.where(F.col(VERSION) <= F.lit(through)), keys)
     .withColumn(VERSION, F.lit(int(through)).cast("long"))
     .write.mode("overwrite").parquet(snapshot_path))
    return int(through)


def current_from(base: DataFrame, log: DataFrame, keys: list[str], base_version: int) -> DataFrame:
    """``current`` over a folded base and the log versions after it (pruned by partition)."""
    newer = log.where(F.col(VERSION) > F.lit(int(base_version)))
    cols = [c for c in newer.columns if c != TIMESTAMP]
    return current(base.select(*cols).unionByName(newer.select(*cols)), keys)


def change_feed(log: DataFrame, keys: list[str], minimal: bool = False) -> DataFrame:
    """Typed changes: the first version of a key is an ``insert``; every later
    version gives an ``update_preimage`` (previous values) and an
    ``update_postimage``, both stamped with the later version.

    One window pass over the versions of each key; the images are produced with
    ``explode`` rather than a union, so the log is read and sorted once. With
    ``minimal``, re-emitted rows whose values did not change are dropped.
    """
    vals = [c for c in log.columns if c not in keys and c not in META]
    w = Window.partitionBy(*keys).orderBy(VERSION)
    cur = F.struct(*[F.col(c) for c in vals])
    prev = F.lag(cur).over(w)
    staged = log.select(*keys, F.col(VERSION), F.col(TIMESTAMP),
                        cur.alias("_cur"), prev.alias("_prev"))
    if minimal:
        staged = staged.where(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.col("_cur")))
    images = F.when(F.col("_prev").isNull(),
                    F.array(F.struct(F.lit("insert").alias(CHANGE), F.col("_cur").alias("v"))))\
              .otherwise(F.array(F.struct(F.lit("update_preimage").alias(CHANGE), F.col("_prev").alias("v")),
                                 F.struct(F.lit("update_postimage").alias(CHANGE), F.col("_cur").alias("v"))))
    return (staged.select(*keys, VERSION, TIMESTAMP, F.explode(images).alias("_img"))
            .select(*keys, "_img.v.*", F.col(f"_img.{CHANGE}").alias(CHANGE), VERSION, TIMESTAMP))


def latest_change(feed: DataFrame, keys: list[str]) -> DataFrame:
    """Newest change per key, pre-images excluded, metadata dropped; a key whose
    newest change is a ``delete`` is gone.

    ``dense_rank() = 1`` over descending versions; Spark plans this as a
    window-group limit that also runs before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(VERSION).desc())
    return (feed.withColumn("_rank", F.dense_rank().over(w))
            .where((F.col("_rank") == 1) & ~F.col(CHANGE).isin("update_preimage", "delete"))
            .drop("_rank", *META))


def write_log(df: DataFrame, log_path: str) -> None:
    """Write a frame that already carries ``_commit_version`` (several versions at once)."""
    if TIMESTAMP not in df.columns:
        df = df.withColumn(TIMESTAMP, F.current_timestamp())
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(VERSION).parquet(log_path))


def backfill_versions(readings: DataFrame, cutoffs: list, length: str,
                      channels: list[str], ts: str = "event_time") -> DataFrame:
    """Rebuild a windowed-mean change log from history in one batch job.

    The versions are those an update-mode stream writes when input arrives in
    time slices: slice ``b`` holds readings with ``cutoffs[b-1] <= ts <
    cutoffs[b]``, and version ``b`` holds every (asset, window) that received
    rows in slice ``b``, with the mean over all its rows up to then. One pass:
    partial sums per (key, slice), then running sums over the slices of a key
    (at most ``len(cutoffs) + 1`` rows per key).
    """
    sl = sum((F.col(ts) >= F.lit(c).cast("timestamp")).cast("int") for c in cutoffs) if cutoffs else F.lit(0)
    per = (readings
           .groupBy("asset_id", F.window(ts, length).start.alias("window_start"), sl.alias(VERSION))
           .agg(*[F.sum(c).alias(f"_s_{c}") for c in channels],
                *[F.count(c).alias(f"_n_{c}") for c in channels]))
    w = Window.partitionBy("asset_id", "window_start").orderBy(VERSION)\
              .rowsBetween(Window.unboundedPreceding, 0)
    means = [(F.sum(f"_s_{c}").over(w) / F.nullif(F.sum(f"_n_{c}").over(w), F.lit(0))).alias(c)
             for c in channels]
    return per.select("asset_id", F.to_date("window_start").alias("reading_date"), "window_start",
                      (F.col("window_start") + F.expr(f"INTERVAL {length}")).alias("window_end"),
                      *means, F.col(VERSION).cast("long").alias(VERSION))
