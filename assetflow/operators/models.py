"""Per-asset (or per-group) regression models as Spark jobs.

A least-squares fit needs only moments: the count, the means and the covariances
of the features and the label. Those come from two
``groupBy(group).agg(...)`` over the training rows, one for the means and one
for the products about them; both are partial aggregates,
so an asset with a third of all rows is combined inside every input partition
and never lands whole in one task. The per-group solve then works on one small
row per group (``mapInPandas``, a batched ``numpy`` solve of a p x p system),
and scoring is a join of the coefficient row back to the data plus a linear
expression evaluated in the JVM.

Fits are ridge regressions in standardised form: columns are centred and
scaled by their standard deviation, ``(R + lambda I) beta = r``, then mapped
back. The penalty keeps collinear channels solvable; ``lambda = 0`` is
ordinary least squares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from . import trees


# --- split ---------------------------------------------------------------

def test_flag(ts: str = "window_start", key: str = "asset_id") -> Column:
    """Deterministic ~20 % hold-out: ``pmod(hour_index * prime + key, 10) >= 8``."""
    hour = F.floor(F.unix_seconds(F.col(ts)) / 3600)
    return F.pmod(hour * config.SPLIT_PRIME + F.col(key), F.lit(config.SPLIT_BUCKETS)) \
        >= config.SPLIT_TRAIN_BUCKETS


def with_split(df: DataFrame, ts: str = "window_start", key: str = "asset_id") -> DataFrame:
    return df.withColumn("is_test", test_flag(ts, key))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("asset_id", "is_test").agg(F.count(F.lit(1)).alias("n_rows"))


# --- sufficient statistics -------------------------------------------------

def _pairs(p: int) -> list[tuple[int, int]]:
    return [(j, k) for j in range(p) for k in range(j, p)]


def gram(df: DataFrame, group: list[str], features: list[str], label: str,
         where: Column | None = None) -> DataFrame:
    """Per-group means and centred second moments for a least-squares fit, over rows with no NULL input.

    The rows are read twice, once for the means and once for the sums of products about them, so a channel far
    from 0 loses no digits. Plain sums need one field each in the aggregate (the built-in moments need four and run
    without generated code from 24 pairs on). A constant channel is centred on its value: its variance is 0.
    """
    complete = F.lit(True)
    for c in features + [label]:
        complete = complete & F.col(c).isNotNull()
    if where is not None:
        complete = complete & where
    names = [f"m{j}" for j in range(len(features))] + ["my"]
    values = {m: F.col(c).cast("double") for m, c in zip(names, [*features, label], strict=True)}
    keys = [f"_k{i}" for i in range(len(group))]
    rows = df.where(complete).select(*[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)], *[v.alias(f"_{m}") for m, v in values.items()])
    means = rows.groupBy(*keys).agg(*[F.expr(f"IF(min(_{m}) = max(_{m}), min(_{m}), avg(_{m})) AS {m}") for m in names])
    means = means.withColumnsRenamed(dict(zip(keys, group, strict=True)))
    same = F.lit(True)
    for g, k in zip(group, keys, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(g))
    off = rows.join(means, same).select(*group, *names, *[F.expr(f"_{m} - {m} AS _{m}") for m in names])
    x = names[:-1]
    sums = {"vy": ("my", "my"), **{f"cy{j}": (m, "my") for j, m in enumerate(x)}, **{f"c{j}_{k}": (x[j], x[k]) for j, k in _pairs(len(x))}}
    # a group's rows all hold its means
    about = [f"sum(_{a} * _{b}) / count(1) AS {s}" for s, (a, b) in sums.items()]
    return off.groupBy(*group).agg(*[F.expr(e) for e in ["count(1) AS n", *[f"min({m}) AS {m}" for m in names], *about]])


def _coef_schema(group_fields: list[T.StructField], features: list[str]) -> T.StructType:
    f = list(group_fields) + [T.StructField("ridge", T.DoubleType()), T.StructField("n_train", T.LongType()),
                              T.StructField("intercept", T.DoubleType()), T.StructField("sd_label", T.DoubleType())]
    f += [T.StructField(f"b_{c}", T.DoubleType()) for c in features]
    f += [T.StructField(f"mean_{c}", T.DoubleType()) for c in features]
    f += [T.StructField(f"sd_{c}", T.DoubleType()) for c in features]
    return T.StructType(f)


def _solve_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(a) @ b


def _solver(group: list[str], features: list[str], ridges: list[float]):
    p = len(features)
    pairs = _pairs(p)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            m = np.stack([pdf[f"m{j}"].to_numpy(dtype=float) for j in range(p)], axis=1)
            my = pdf["my"].to_numpy(dtype=float)
            cov = np.empty((len(pdf), p, p))
            for j, k in pairs:
                v = pdf[f"c{j}_{k}"].to_numpy(dtype=float)
                cov[:, j, k] = v
                cov[:, k, j] = v
            cxy = np.stack([pdf[f"cy{j}"].to_numpy(dtype=float) for j in range(p)], axis=1)
            vy = np.maximum(pdf["vy"].to_numpy(dtype=float), 0.0)
            sd = np.sqrt(np.maximum(np.diagonal(cov, axis1=1, axis2=2), 0.0))
            sdy = np.sqrt(vy)
            ok = sd > 1e-12 * (1.0 + np.abs(m))
            safe = np.where(ok, sd, 1.0)
            corr = cov / (safe[:, :, None] * safe[:, None, :])
            corr = np.where(ok[:, :, None] & ok[:, None, :], corr, 0.0)
            rhs = np.where(ok, cxy / (safe * np.where(sdy > 0, sdy, 1.0)[:, None]), 0.0)
            for lam in ridges:
                # penalty on usable columns; a constant column gets a unit diagonal and beta 0
                penalised = corr + np.eye(p) * np.where(ok, lam, 1.0)[:, None, :]
                try:
                    beta_std = np.linalg.solve(penalised, rhs[:, :, None])[:, :, 0]
                except np.linalg.LinAlgError:  # a group is singular without a penalty: its minimum-norm solution
                    beta_std = np.stack([_solve_one(a, b) for a, b in zip(penalised, rhs, strict=True)])
                beta = np.where(ok & (sdy[:, None] > 0), beta_std * sdy[:, None] / safe, 0.0)
                yield pd.concat([pdf[group], pd.DataFrame({
                    "ridge": lam, "n_train": pdf["n"].astype("int64"), "intercept": my - (beta * m).sum(axis=1), "sd_label": sdy,
                    **{f"b_{c}": beta[:, j] for j, c in enumerate(features)},
                    **{f"mean_{c}": m[:, j] for j, c in enumerate(features)},
                    **{f"sd_{c}": sd[:, j] for j, c in enumerate(features)}}, index=pdf.index)], axis=1)

    return solve


def fit(df: DataFrame, group: list[str], features: list[str], label: str,
        ridges: list[float] | float = config.RIDGE, train: Column | None = None) -> DataFrame:
    """Coefficients per group (and per ridge penalty when several are given).

    Output: group columns, ``ridge``, ``n_train``, ``intercept``, ``sd_label``,
    ``b_<feature>``, ``mean_<feature>``, ``sd_<feature>``. Several penalties
    reuse the same statistics: a group's row is solved for each.
    """
    ridges = [float(r) for r in ([ridges] if isinstance(ridges, (int, float)) else ridges)]
    g = gram(df, group, features, label, train)
    gfields = [g.schema[c] for c in group]
    return g.mapInPandas(_solver(group, features, ridges), _coef_schema(gfields, features))


def prediction(features: list[str]) -> Column:
    """Linear score from joined coefficient columns; a NULL input takes the training mean."""
    s = F.col("intercept")
    for c in features:
        s = s + F.col(f"b_{c}") * F.coalesce(F.col(c).cast("double"), F.col(f"mean_{c}"))
    return s


def score(df: DataFrame, coefs: DataFrame, group: list[str], features: list[str], out: str) -> DataFrame:
    """Add ``out``: each row scored by its own group's model (NULL if it has none).

    A model row is a line of coefficients or, where its column ``trees`` is set, an ensemble.
    """
    keep = [c for c in df.columns if c != out]
    mixed = "trees" in coefs.columns
    cols = group + ["intercept"] + [f"b_{c}" for c in features] + [f"mean_{c}" for c in features] + (["trees"] if mixed else [])
    joined = df.select(*keep).join(coefs.select(*cols), group, "left")  # coefs: one row per group, sized at run time
    p = prediction(features)
    if mixed:
        p = F.when(F.col("trees").isNotNull(), trees.prediction(features)).otherwise(p)
    return joined.select(*keep, p.alias(out))


# --- metrics, runs, selection ------------------------------------------------

def rmse(scored: DataFrame, group: list[str], label: str, pred: str, split: str = "is_test") -> DataFrame:
    """Train and held-out RMSE per group, in one aggregate."""
    sq = F.pow(F.col(label) - F.col(pred), 2)
    return scored.groupBy(*group).agg(
        F.sqrt(F.avg(F.when(~F.col(split), sq))).alias("train_rmse"),
        F.sqrt(F.avg(F.when(F.col(split), sq))).alias("test_rmse"))


def run_log(df: DataFrame, coefs: DataFrame, group: list[str], features: list[str],
            label: str, model: str, created_version: int = 0) -> DataFrame:
    """One run per (group, penalty) with its metrics; the table a tracking service keeps.

    Every row is scored by every candidate of its group: a fan-out by the
    (fixed, small) number of candidate penalties.
    """
    cand = coefs.select(*group, "ridge", "intercept", *[f"b_{c}" for c in features],
                        *[f"mean_{c}" for c in features])
    rows = df.select(*group, *features, label, "is_test")
    scored = rows.join(cand, group, "inner").withColumn("_pred", prediction(features))
    m = rmse(scored, group + ["ridge"], label, "_pred")
    run_id = F.concat_ws("-", F.lit(model), *[F.col(c).cast("string") for c in group],
                         F.format_number("ridge", 4), F.lit(str(created_version)))
    return m.select(run_id.alias("run_id"), F.lit(model).alias("model"), *group, "ridge",
                    F.lit("FINISHED").alias("status"), "train_rmse", "test_rmse",
                    F.lit(int(created_version)).cast("long").alias("created_version"))


def best_runs(runs: DataFrame, group: list[str]) -> DataFrame:
    """Lowest held-out RMSE per (model, group) among finished runs with a positive metric.

    ``min_by`` over (test_rmse, run_id) is a total order, so ties resolve the same way every time.
    """
    ok = runs.where((F.col("status") == "FINISHED") & (F.col("test_rmse") > 0))
    rest = [c for c in runs.columns if c not in group + ["model"]]
    return (ok.groupBy("model", *group)
            .agg(F.min_by(F.struct(*rest), F.struct("test_rmse", "run_id")).alias("_r"))
            .select("model", *group, "_r.*"))


def registry_stages(registrations: DataFrame) -> DataFrame:
    """Versions per (model_name, asset): registered in order; the newest is
    Production and earlier ones Archived (promotion with archiving)."""
    w = Window.partitionBy("model_name", "asset_id").orderBy("registered_round", "run_id")
    wl = Window.partitionBy("model_name", "asset_id")
    v = registrations.withColumn("version", F.row_number().over(w).cast("long"))
    return v.withColumn("stage", F.when(F.col("version") == F.max("version").over(wl), F.lit("Production"))
                        .otherwise(F.lit("Archived")))


def importance(coefs: DataFrame, group: list[str], features: list[str]) -> DataFrame:
    """Share of each feature in a linear model: |beta| * sd(x), normalised per model."""
    contrib = F.array(*[F.struct(F.lit(c).alias("feature"),
                                 (F.abs(F.col(f"b_{c}")) * F.col(f"sd_{c}")).alias("w")) for c in features])
    long = coefs.select(*group, F.explode(contrib).alias("_f")).select(*group, "_f.feature", "_f.w")
    tot = Window.partitionBy(*group)
    return long.select(*group, "feature",
                       F.coalesce(F.col("w") / F.nullif(F.sum("w").over(tot), F.lit(0.0)), F.lit(0.0))
                       .alias("importance"))


# --- boosted trees (fleet-wide) ------------------------------------------------

def fit_trees(df: DataFrame, features: list[str], label: str, train: Column,
              params: dict = config.GBT_PARAMS, seed: int = 42):
    """One gradient-boosted tree ensemble for the whole fleet (MLlib, distributed).

    Depth 5, learning rate 0.5; half the features are drawn for each node (MLlib
    has no sample per tree; ``operators.trees`` has). MLlib trains one model per
    fit, so this is the fleet (or group) model. NULL inputs are imputed with
    training means.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    dbl = [f"_x_{c}" for c in features]
    prep = df.select("*", *[F.col(c).cast("double").alias(d) for c, d in zip(features, dbl)])
    pipe = Pipeline(stages=[
        Imputer(inputCols=dbl, outputCols=dbl, strategy="mean"),
        VectorAssembler(inputCols=dbl, outputCol="_features", handleInvalid="keep"),
        GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="_gbt", seed=seed, **params)])
    model = pipe.fit(prep.where(train & F.col(label).isNotNull()))
    return model, dbl


def score_trees(model, dbl: list[str], df: DataFrame, features: list[str], out: str) -> DataFrame:
    prep = df.select("*", *[F.col(c).cast("double").alias(d) for c, d in zip(features, dbl)])
    return model.transform(prep).withColumnRenamed("_gbt", out).drop("_features", *dbl)


def tree_importance(model, features: list[str]) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances.toArray()
    return [(c, float(w)) for c, w in zip(features, imp)]


def usage_clusters(df: DataFrame, features: list[str], k: int = 4, key: str = "asset_id",
                   seed: int = 42) -> DataFrame:
    """Group similar assets: KMeans over each asset's mean (standardised) profile.

    The profile is one partial aggregate per asset; KMeans then runs on one
    row per asset. Returns ``key, cluster``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler

    prof = df.groupBy(key).agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in features])
    cols = [f"_m_{c}" for c in features]
    pipe = Pipeline(stages=[
        Imputer(inputCols=cols, outputCols=cols, strategy="mean"),
        VectorAssembler(inputCols=cols, outputCol="_v"),
        StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True),
        KMeans(featuresCol="_z", predictionCol="cluster", k=k, seed=seed)])
    return pipe.fit(prof).transform(prof).select(key, F.col("cluster").cast("int"))
