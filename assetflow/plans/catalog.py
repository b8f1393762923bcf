"""Registered analytics: name -> f(spark, sf_dir) -> DataFrame.

Every entry reads the given tables (or tables Spark derives from them) in full.
Outputs use wall-clock timestamps and doubles rounded to 6 digits so they can
be compared with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.columns import ntz_all, round_doubles
from ..operators import aggregate, changelog, features, keyed, models, scenario
from ..session import scratch_path
from ..sources import files
from ..streaming.medallion import KEYS, SILVER_FIELDS, Medallion, stream_in_slices
from . import modeling as M
from . import tables
from .views import Views


def _out(df: DataFrame) -> DataFrame:
    return round_doubles(ntz_all(df))


def bronze_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings landed as CSV files, ingested by the bronze stream into a
    date-partitioned table, read back."""
    m = Medallion(spark, scratch_path(spark, "bronze"))
    m.ensure_dirs()
    files.write_landing(Views(spark, sf_dir).readings.select(*[f.name for f in m.schema.fields]), m.landing)
    m.run_available_now(upto="bronze")
    return _out(m.bronze_table())


def hourly_min(spark, sf_dir):
    return _out(aggregate.hourly_min(Views(spark, sf_dir).readings))


def count_by_asset(spark, sf_dir):
    return _out(aggregate.count_by_asset(Views(spark, sf_dir).readings))


def windowed_avg(spark, sf_dir):
    return _out(Views(spark, sf_dir).hourly)


def date_bounds(spark, sf_dir):
    return _out(aggregate.date_bounds(Views(spark, sf_dir).readings))


def reading_dates(spark, sf_dir):
    return _out(aggregate.reading_dates(Views(spark, sf_dir).output))


def dedup_keys(spark, sf_dir):
    """Last reading per (asset, hour); survivor chosen by (event_time, channels)."""
    v = Views(spark, sf_dir)
    r = v.readings.withColumn("window_start", F.date_trunc("hour", "event_time"))
    return _out(aggregate.last_per_key(r, ["asset_id", "window_start"],
                                       ["event_time"] + config.CHANNELS))


def enriched_assets(spark, sf_dir):
    return _out(Views(spark, sf_dir).enriched)


def gold_readings(spark, sf_dir):
    return _out(Views(spark, sf_dir).gold.orderBy("asset_id", "window_start"))


def asset_age(spark, sf_dir):
    return _out(Views(spark, sf_dir).age)


def feature_table(spark, sf_dir):
    return _out(Views(spark, sf_dir).features)


def feature_table_by_name(spark, sf_dir):
    """The feature table as a user reads it: by name, through the session's views."""
    tables.create_views(spark, sf_dir)
    return _out(spark.sql("SELECT * FROM feature_table"))


def feature_table_by_block(spark, sf_dir):
    """The feature table for series of any length: rows numbered over periods, leads within blocks of rows."""
    v = Views(spark, sf_dir)
    base = v.materialized("feature_base", lambda: features.feature_base(v.gold, v.maintenance, v.as_of))
    return _out(features.feature_table_by_block(base))


def label_by_time(spark, sf_dir):
    v = Views(spark, sf_dir)
    return _out(features.label_by_time(features.feature_base(v.gold, v.maintenance, v.as_of)))


def life_curve(spark, sf_dir):
    return _out(features.life_curve(Views(spark, sf_dir).features))


# --- change log -------------------------------------------------------------

def _backfilled_log(spark, sf_dir) -> DataFrame:
    """History written into a change log as the versions of an update-mode stream."""
    v = Views(spark, sf_dir)
    path = scratch_path(spark, "silver_log")
    changelog.write_log(changelog.backfill_versions(v.readings, config.BATCH_CUTOFFS, config.WINDOW,
                                                    config.CHANNELS), path)
    return changelog.read_log(spark, path)


def upsert_latest(spark, sf_dir):
    return _out(changelog.current(_backfilled_log(spark, sf_dir), KEYS))


def change_feed(spark, sf_dir):
    feed = changelog.change_feed(_backfilled_log(spark, sf_dir), KEYS)
    return _out(feed.drop(changelog.TIMESTAMP))


def latest_change(spark, sf_dir):
    feed = changelog.change_feed(_backfilled_log(spark, sf_dir), KEYS)
    return _out(changelog.latest_change(feed, KEYS))


def typed_feed_stream(spark, sf_dir):
    """A keyed table by date under a stream of change sets, deletes among them; its typed feed as a stream.

    The change sets are the versions of an update-mode stream, then the windows of retired assets are deleted,
    then those of some of them come back. The feed is streamed from the second version on, and started twice.
    """
    v = Views(spark, sf_dir)
    root = scratch_path(spark, "typed_feed")
    fields = [f for f in SILVER_FIELDS]
    cols = [f.name for f in fields]
    sets = changelog.backfill_versions(v.readings, config.BATCH_CUTOFFS, config.WINDOW, config.CHANNELS).withColumn(keyed.DELETED, F.lit(False))
    n = len(config.BATCH_CUTOFFS) + 1
    again = lambda every, gone, version: (v.hourly.where(F.col("asset_id") % every == 0).select(*cols)
                                          .withColumn(keyed.DELETED, F.lit(gone)).withColumn(changelog.VERSION, F.lit(version).cast("long")))
    order = [*cols, keyed.DELETED, changelog.VERSION]
    every = sets.select(*order).unionByName(again(config.RETIRED_EVERY, True, n)).unionByName(again(2 * config.RETIRED_EVERY, False, n + 1))
    every.write.partitionBy(changelog.VERSION).parquet(f"{root}/sets")
    table = keyed.KeyedTable(spark, f"{root}/table", fields, KEYS, fold_every=2)

    def apply(batch: DataFrame, _: int) -> None:
        for r in batch.select(changelog.VERSION).distinct().orderBy(changelog.VERSION).collect():  # one row a version
            table.upsert(batch.where(F.col(changelog.VERSION) == r[0]), int(r[0]))

    schema = T.StructType([*[f for f in every.schema.fields if f.name != changelog.VERSION], every.schema[changelog.VERSION]])
    (spark.readStream.schema(schema).parquet(f"{root}/sets").writeStream.foreachBatch(apply)
     .option("checkpointLocation", f"{root}/_sets").trigger(availableNow=True).start().awaitTermination())
    for _ in range(2):
        (table.feed_stream(from_version=1).writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_feed").trigger(availableNow=True).start().awaitTermination())
    return _out(spark.read.schema(table.feed_schema).parquet(f"{root}/out").drop(changelog.TIMESTAMP))


# --- streaming ---------------------------------------------------------------

def _medallion(spark, sf_dir) -> Medallion:
    v = Views(spark, sf_dir)
    m = Medallion(spark, scratch_path(spark, "medallion"), assets=lambda: Views(spark, sf_dir).assets)
    return stream_in_slices(m, v.readings, config.BATCH_CUTOFFS)


def windowed_avg_stream(spark, sf_dir):
    """CSV landing -> bronze -> watermarked window means -> silver log, current state."""
    m = Medallion(spark, scratch_path(spark, "medallion"))
    stream_in_slices(m, Views(spark, sf_dir).readings, config.BATCH_CUTOFFS)
    return _out(m.silver_current().drop(changelog.TIMESTAMP))


def hourly_min_stream(spark, sf_dir):
    """The hourly minimum run live over the raw CSV stream (a temp view)."""
    m = Medallion(spark, scratch_path(spark, "live"), live={"hourly_min": (aggregate.hourly_min, ["event_hour"])})
    stream_in_slices(m, Views(spark, sf_dir).readings, config.BATCH_CUTOFFS, chain=False)
    return _out(m.live_current("hourly_min").drop(changelog.TIMESTAMP))


def enriched_upsert(spark, sf_dir):
    """The whole chain: silver log changes -> join metadata -> gold log, current state."""
    m = _medallion(spark, sf_dir)
    return _out(m.gold_current().drop(changelog.TIMESTAMP))


# --- idempotent side-table loads ---------------------------------------------

def _load_twice(spark, raw: DataFrame, schema: str, select: list[str], name: str) -> DataFrame:
    """Land ``raw`` as JSON files, load them twice; the second load must add nothing."""
    root = scratch_path(spark, name)
    raw.write.mode("append").json(f"{root}/src")
    for _ in range(2):
        files.idempotent_load(spark, f"{root}/src", schema, select, f"{root}/table", f"{root}/_ckpt")
    return spark.read.parquet(f"{root}/table")


def idempotent_load(spark, sf_dir):
    a = Views(spark, sf_dir).assets
    raw = a.select("country", "manufacturer", F.col("asset_id").cast("string").alias("asset_id"), "region")
    return _out(_load_twice(spark, raw, "country string, manufacturer string, asset_id string, region string",
                            ["country", "manufacturer", "cast(asset_id as int) as asset_id", "region"],
                            "asset_load"))


def maintenance_events(spark, sf_dir):
    m = Views(spark, sf_dir).maintenance
    raw = m.select(F.col("reading_date").cast("string").alias("reading_date"), "maintenance",
                   F.col("asset_id").cast("string").alias("asset_id"))
    return _out(_load_twice(spark, raw, "reading_date string, maintenance boolean, asset_id string",
                            ["cast(reading_date as date) as reading_date", "maintenance",
                             "cast(asset_id as int) as asset_id"], "maintenance_load"))


def asset_output(spark, sf_dir):
    o = Views(spark, sf_dir).output
    raw = o.select(F.col("reading_date").cast("string").alias("reading_date"),
                   F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                   F.col("asset_id").cast("string").alias("asset_id"), "oil_output")
    return _out(_load_twice(spark, raw,
                            "reading_date string, window_start string, asset_id string, oil_output double",
                            ["cast(reading_date as date) as reading_date",
                             "cast(window_start as timestamp) as window_start",
                             "cast(asset_id as int) as asset_id", "oil_output"], "output_load"))


# --- models --------------------------------------------------------------------

def split_counts(spark, sf_dir):
    return _out(models.split_counts(M.training_frame(Views(spark, sf_dir))))


def linear_model(spark, sf_dir):
    """Per-asset least squares of the look-ahead label on current output (no penalty)."""
    f = M.training_frame(Views(spark, sf_dir))
    c = models.fit(f, M.G, ["oil_output"], M.OUT_LABEL, 0.0, M.train())
    defined = F.col("sd_oil_output") > 0  # no variance in the feature: no slope (as regr_slope)
    return _out(c.select("asset_id", "n_train",
                         F.when(defined, F.col("b_oil_output")).alias("slope"),
                         F.when(defined, F.col("intercept")).alias("intercept")))


def output_predictions(spark, sf_dir):
    return _out(M.output_predictions(Views(spark, sf_dir)))


def life_predictions(spark, sf_dir):
    return _out(M.life_predictions(Views(spark, sf_dir)))


def actual_vs_predicted(spark, sf_dir, threshold: float | None = None):
    """Daily mean label and prediction over rows whose label is above ``threshold``.

    Without one it is the label's median, the scale-free equivalent of a fixed
    value in the data's units.
    """
    p = M.output_predictions(Views(spark, sf_dir))
    # a scalar subquery over a mergeable quantile sketch (bounded memory per task)
    thr = F.lit(threshold) if threshold is not None else p.agg(F.percentile_approx(M.OUT_LABEL, 0.5, 100000)).scalar()
    return _out(p.where(F.col(M.OUT_LABEL) > thr)
                .groupBy("reading_date")
                .agg(F.avg(M.OUT_LABEL).alias("actual"), F.avg(M.OUT_PRED).alias("predicted"))
                .orderBy("reading_date"))


def life_actual_vs_predicted(spark, sf_dir):
    p = M.life_predictions(Views(spark, sf_dir))
    return _out(p.groupBy("reading_date")
                .agg(F.avg(M.LIFE_LABEL).alias("actual_life"), F.avg(M.LIFE_PRED).alias("predicted_life"))
                .orderBy("reading_date"))


def model_rmse(spark, sf_dir):
    v = Views(spark, sf_dir)
    o = models.rmse(M.output_predictions(v), M.G, M.OUT_LABEL, M.OUT_PRED).withColumn("model", F.lit(M.OUTPUT_MODEL))
    life = models.rmse(M.life_predictions(v), M.G, M.LIFE_LABEL, M.LIFE_PRED).withColumn("model", F.lit(M.LIFE_MODEL))
    return _out(o.unionByName(life))


def best_model(spark, sf_dir):
    runs, _, _ = M.candidates(Views(spark, sf_dir))
    return _out(models.best_runs(runs, M.G))


def boosting_rounds(spark, sf_dir):
    """Train and held-out error of every asset's boosted trees for the output, by round."""
    return _out(M.tree_models(Views(spark, sf_dir), M.OUTPUT_MODEL, M.OUT_LABEL)[1])


def best_model_of_all(spark, sf_dir):
    """The best run per asset for the output among the ridge fits and the boosted trees."""
    v = Views(spark, sf_dir)
    runs = M.candidates(v)[0].where(F.col("model") == M.OUTPUT_MODEL)
    return _out(models.best_runs(runs.unionByName(M.tree_runs(M.tree_models(v, M.OUTPUT_MODEL, M.OUT_LABEL)[1], M.OUTPUT_MODEL)), M.G))


def promoted_models(spark, sf_dir):
    return _out(M.registry(spark, sf_dir).stages())


def _group_rmse(f: DataFrame, groups: DataFrame, name: str) -> DataFrame:
    """Train and held-out RMSE of one model per group; ``groups`` gives each asset's ``grp``."""
    g = f.join(groups, "asset_id")
    c = models.fit(g, ["grp"], config.FEATURES, M.OUT_LABEL, config.RIDGE, M.train())
    s = models.score(g, c, ["grp"], config.FEATURES, M.OUT_PRED)
    return models.rmse(s, ["grp"], M.OUT_LABEL, M.OUT_PRED).select(
        F.lit(name).alias("grouping"), F.col("grp").alias("group"), "train_rmse", "test_rmse")


def group_model(spark, sf_dir):
    """One model per region instead of per asset."""
    v = Views(spark, sf_dir)
    return _out(_group_rmse(M.training_frame(v), v.assets.select("asset_id", F.col("region").alias("grp")), "region"))


def usage_cluster_model(spark, sf_dir):
    """One model per group of similar assets (KMeans on each asset's mean profile)."""
    f = M.training_frame(Views(spark, sf_dir))
    clusters = models.usage_clusters(f, config.FEATURES)
    return _out(_group_rmse(f, clusters.select("asset_id", F.col("cluster").cast("string").alias("grp")),
                            "usage_cluster"))


def feature_importance(spark, sf_dir):
    """Per-asset shares of the features in the ridge output models."""
    return _out(models.importance(M.output_coefs(Views(spark, sf_dir)), M.G, config.FEATURES)
                .withColumn("model", F.lit(M.OUTPUT_MODEL)))


def tree_importance(spark, sf_dir):
    """The fleet trees' importances, the asset key being a feature."""
    feats = config.FEATURES + ["asset_id"]
    model, _ = models.fit_trees(M.training_frame(Views(spark, sf_dir)), feats, M.OUT_LABEL, M.train())
    return _out(spark.createDataFrame(models.tree_importance(model, feats), "feature string, importance double")
                .withColumn("model", F.lit("fleet_gbt")))


def tree_model(spark, sf_dir):
    """Fleet-wide boosted trees for the look-ahead output (asset key as a feature):
    train and held-out RMSE per asset."""
    f = M.training_frame(Views(spark, sf_dir))
    feats = config.FEATURES + ["asset_id"]
    model, dbl = models.fit_trees(f, feats, M.OUT_LABEL, M.train())
    s = models.score_trees(model, dbl, f, feats, M.OUT_PRED)
    return _out(models.rmse(s, M.G, M.OUT_LABEL, M.OUT_PRED).withColumn("model", F.lit("fleet_gbt")))


# --- scenario --------------------------------------------------------------------

def sweep_grid(spark, sf_dir):
    v = Views(spark, sf_dir)
    return _out(scenario.sweep_grid(scenario.latest_payload(M.training_frame(v))))


def sweep_predictions(spark, sf_dir):
    return _out(M.sweep(Views(spark, sf_dir)))


def _profit(v: Views) -> DataFrame:
    """Money follows from the predictions as they are reported (rounded): a life near 0 would
    otherwise multiply their last digits."""
    return scenario.profit(_out(M.sweep(v)))


def profit_curve(spark, sf_dir):
    return _out(_profit(Views(spark, sf_dir)))


def optimal_setting(spark, sf_dir):
    return _out(scenario.optimal_setting(_profit(Views(spark, sf_dir))))


def optimal_setting_own_range(spark, sf_dir):
    """The best setting of each asset within the range it has run at."""
    return _out(scenario.optimal_setting(scenario.profit(_out(M.sweep(Views(spark, sf_dir), own_range=True)))))


def fleet_kpis(spark, sf_dir):
    v = Views(spark, sf_dir)
    return _out(scenario.fleet_kpis(scenario.optimal_setting(_profit(v)), v.assets))


# --- layout ----------------------------------------------------------------------

def compacted_rows(spark, sf_dir):
    """Gold rows written as many small files per date, then compacted and clustered
    by (asset, window) for every closed date; the rows must be unchanged."""
    from ..operators import layout
    v = Views(spark, sf_dir)
    path = scratch_path(spark, "gold_table")
    v.gold.repartition(4 * spark.sparkContext.defaultParallelism) \
        .write.mode("overwrite").partitionBy("reading_date").parquet(path)
    last = spark.read.parquet(path).agg(F.max("reading_date")).first()[0]  # one value
    layout.compact(spark, path, "reading_date", last, ["asset_id", "window_start"])
    return _out(spark.read.parquet(path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_readings": bronze_readings,
    "hourly_min": hourly_min,
    "count_by_asset": count_by_asset,
    "windowed_avg": windowed_avg,
    "date_bounds": date_bounds,
    "reading_dates": reading_dates,
    "idempotent_load": idempotent_load,
    "windowed_avg_stream": windowed_avg_stream,
    "hourly_min_stream": hourly_min_stream,
    "dedup_keys": dedup_keys,
    "upsert_latest": upsert_latest,
    "change_feed": change_feed,
    "latest_change": latest_change,
    "typed_feed_stream": typed_feed_stream,
    "enriched_assets": enriched_assets,
    "enriched_upsert": enriched_upsert,
    "maintenance_events": maintenance_events,
    "asset_output": asset_output,
    "gold_readings": gold_readings,
    "asset_age": asset_age,
    "feature_table": feature_table,
    "feature_table_by_name": feature_table_by_name,
    "label_by_time": label_by_time,
    "feature_table_by_block": feature_table_by_block,
    "life_curve": life_curve,
    "split_counts": split_counts,
    "linear_model": linear_model,
    "output_predictions": output_predictions,
    "life_predictions": life_predictions,
    "actual_vs_predicted": actual_vs_predicted,
    "life_actual_vs_predicted": life_actual_vs_predicted,
    "model_rmse": model_rmse,
    "best_model": best_model,
    "promoted_models": promoted_models,
    "boosting_rounds": boosting_rounds,
    "best_model_of_all": best_model_of_all,
    "group_model": group_model,
    "usage_cluster_model": usage_cluster_model,
    "feature_importance": feature_importance,
    "tree_importance": tree_importance,
    "tree_model": tree_model,
    "sweep_grid": sweep_grid,
    "sweep_predictions": sweep_predictions,
    "profit_curve": profit_curve,
    "optimal_setting": optimal_setting,
    "optimal_setting_own_range": optimal_setting_own_range,
    "fleet_kpis": fleet_kpis,
    "compacted_rows": compacted_rows,
}
