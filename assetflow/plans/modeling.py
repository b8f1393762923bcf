"""The model chain: features -> output model -> life model -> runs -> registry -> sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import changelog, models, scenario, trees
from ..session import scratch_path
from .views import Views

OUT_LABEL = "output_6_hours_ahead"
OUT_PRED = OUT_LABEL + "_predicted"
LIFE_LABEL = "remaining_life"
LIFE_PRED = LIFE_LABEL + "_predicted"
OUTPUT_MODEL = "asset_output_prediction"
LIFE_MODEL = "asset_life_prediction"
G = ["asset_id"]


def train():
    return ~F.col("is_test")


def training_frame(v: Views) -> DataFrame:
    """Feature rows with the split flag, materialised once: every fit, score
    and metric below reads it."""
    cols = ["reading_date", "window_start", "asset_id", LIFE_LABEL] + \
        [c for c in config.FEATURES if c != LIFE_LABEL] + [OUT_LABEL]
    return v.materialized("training", lambda: models.with_split(v.features.select(*cols)))


def output_coefs(v: Views) -> DataFrame:
    return v.materialized("output_coefs", lambda: models.fit(training_frame(v), G, config.FEATURES,
                                                             OUT_LABEL, config.RIDGE, train()))


def output_predictions(v: Views) -> DataFrame:
    return models.score(training_frame(v), output_coefs(v), G, config.FEATURES, OUT_PRED)


def stored_output_predictions(v: Views) -> DataFrame:
    """Output predictions written as a date-partitioned table, then read back.

    The life model trains on this table; writing it cuts the lineage so the
    output model is not recomputed by later jobs (and survives executor loss).
    """
    path = scratch_path(v.spark, "output_predictions")
    output_predictions(v).write.mode("overwrite").partitionBy("reading_date").parquet(path)
    return v.spark.read.parquet(path)


def life_frame(outp: DataFrame) -> DataFrame:
    cols = ["reading_date", "window_start", "asset_id", OUT_PRED] + config.FEATURES + [LIFE_LABEL, "is_test"]
    return outp.select(*cols)


def life_predictions(v: Views, outp: DataFrame | None = None) -> DataFrame:
    f = life_frame(outp if outp is not None else stored_output_predictions(v))
    coefs = models.fit(f, G, config.FEATURES, LIFE_LABEL, config.RIDGE, train())
    return models.score(f, coefs, G, config.FEATURES, LIFE_PRED)


def candidate_coefs(v: Views) -> DataFrame:
    """Coefficient rows of every candidate (model, asset, penalty), materialised once."""
    def build():
        f = training_frame(v)
        oc = models.fit(f, G, config.FEATURES, OUT_LABEL, config.RIDGE_CANDIDATES, train())
        lc = models.fit(f, G, config.FEATURES, LIFE_LABEL, config.RIDGE_CANDIDATES, train())
        return oc.withColumn("model", F.lit(OUTPUT_MODEL)).unionByName(lc.withColumn("model", F.lit(LIFE_MODEL)))
    return v.materialized("candidate_coefs", build)


def candidates(v: Views, round_no: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate fits for both targets, their run log, and the coefficient rows."""
    f = training_frame(v)
    coefs = candidate_coefs(v)
    runs = None
    for model, label in ((OUTPUT_MODEL, OUT_LABEL), (LIFE_MODEL, LIFE_LABEL)):
        r = models.run_log(f, coefs.where(F.col("model") == model).drop("model"), G, config.FEATURES,
                           label, model, round_no)
        runs = r if runs is None else runs.unionByName(r)
    return runs, coefs, f


def tree_models(v: Views, model: str, label: str, p: trees.Params = trees.Params()) -> tuple[DataFrame, DataFrame]:
    """Boosted trees of every asset for a label: node rows, and train and held-out error by asset and round."""
    memo = v.__dict__.setdefault("_trees", {})
    if model not in memo:
        memo[model] = trees.fit(training_frame(v), G, ["window_start"], config.FEATURES, label, p=p)
    return memo[model]


def tree_runs(errors: DataFrame, model: str, round_no: int = 0) -> DataFrame:
    """The ensembles as runs like any other: error after the last round, no penalty."""
    last = errors.groupBy(*G).agg(F.max_by(F.struct("train_rmse", "test_rmse"), "round").alias("_e")).select(*G, "_e.*")
    run_id = F.concat_ws("-", F.lit(model), *[F.col(c).cast("string") for c in G], F.lit("trees"), F.lit(str(round_no)))
    return last.select(run_id.alias("run_id"), F.lit(model).alias("model"), *G, F.lit(None).cast("double").alias("ridge"), F.lit("FINISHED").alias("status"),
                       "train_rmse", "test_rmse", F.lit(int(round_no)).cast("long").alias("created_version"))


class ModelStore:
    """The run log and the model registry as tables that are kept: one version per training round.

    A round that is recorded again replaces itself. The newest registered version of a (model, asset)
    is Production, earlier ones are Archived; serving loads the Production coefficients.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self._runs, self._registry = spark, f"{root}/runs", f"{root}/registry"

    def record(self, v: Views, round_no: int = 0, boosted: trees.Params | None = None) -> None:
        """Append the round's runs and register the best one per (model, asset) with what it takes to score by it.

        With ``boosted``, the assets' boosted trees compete with the ridge fits; a registered model is then a row
        of coefficients or an ensemble of node rows.
        """
        runs, coefs, _ = candidates(v, round_no)
        coefs = coefs.withColumn("trees", F.lit(None).cast(trees.MODEL))
        ensembles = None
        if boosted:
            for model, label in ((OUTPUT_MODEL, OUT_LABEL), (LIFE_MODEL, LIFE_LABEL)):
                nodes, errors = tree_models(v, model, label, boosted)
                runs = runs.unionByName(tree_runs(errors, model, round_no))
                mine = trees.packed(nodes, G, config.FEATURES).withColumn("model", F.lit(model))
                ensembles = mine if ensembles is None else ensembles.unionByName(mine)
        changelog.append_version(runs, self._runs, round_no)
        mine = self.runs().where(F.col("created_version") == round_no)
        best = models.best_runs(mine, G).select("model", *G, "ridge", "run_id")
        chosen = coefs.join(best, ["model", *G, "ridge"], "inner")
        if ensembles is not None:
            chosen = chosen.unionByName(ensembles.join(best.where(F.col("ridge").isNull()), ["model", *G], "inner"), allowMissingColumns=True)
        changelog.append_version(chosen, self._registry, round_no)

    def runs(self) -> DataFrame:
        return changelog.read_log(self.spark, self._runs).drop(*changelog.META)

    def stages(self) -> DataFrame:
        registered = changelog.read_log(self.spark, self._registry)
        return models.registry_stages(registered.select(F.col("model").alias("model_name"), *G, "run_id",
                                                        F.col(changelog.VERSION).alias("registered_round")))

    def production(self, model: str) -> DataFrame:
        registered = changelog.read_log(self.spark, self._registry).where(F.col("model") == model)
        return changelog.current(registered, ["model", *G])


def registry(spark: SparkSession, sf_dir: str) -> ModelStore:
    """A store in which each retraining round registered its best run per (model, asset)."""
    store = ModelStore(spark, scratch_path(spark, "models"))
    for rnd, as_of in enumerate(config.RETRAIN_AS_OF):
        store.record(Views(spark, sf_dir, as_of), rnd)
    return store


def sweep(v: Views, store: ModelStore | None = None, own_range: bool = False) -> DataFrame:
    """The sweep scored by the store's Production models (default: a store with one round on ``v``).

    Over the fixed grid, or over the range that each asset has run at.
    """
    if store is None:
        store = ModelStore(v.spark, scratch_path(v.spark, "models"))
        store.record(v)
    payload = scenario.latest_payload(training_frame(v))
    grid = scenario.own_range_grid(payload, scenario.own_ranges(training_frame(v))) if own_range else scenario.sweep_grid(payload)
    return scenario.sweep_predictions(grid, store.production(OUTPUT_MODEL), store.production(LIFE_MODEL))
