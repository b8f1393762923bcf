import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from assetflow.operators import models, scenario


def _data(spark, seed=3, n=60):
    rng = np.random.default_rng(seed)
    frames = []
    for g in (1, 2):
        x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.1] + [0.0, 50.0, 3.0]
        y = 2.0 + x @ np.array([1.5, -0.2, 4.0]) * g + rng.normal(scale=0.1, size=n)
        frames.append(pd.DataFrame({"g": g, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    pdf = pd.concat(frames, ignore_index=True)
    return pdf, spark.createDataFrame(pdf)


def test_ols_equals_numpy_lstsq(spark):
    pdf, df = _data(spark)
    coefs = {r.g: r for r in models.fit(df, ["g"], ["a", "b", "c"], "y", 0.0).collect()}
    for g, part in pdf.groupby("g"):
        X = np.column_stack([np.ones(len(part)), part[["a", "b", "c"]].to_numpy()])
        beta = np.linalg.lstsq(X, part["y"].to_numpy(), rcond=None)[0]
        r = coefs[g]
        np.testing.assert_allclose([r.intercept, r.b_a, r.b_b, r.b_c], beta, rtol=1e-6, atol=1e-8)


def test_ridge_equals_standardised_closed_form(spark):
    pdf, df = _data(spark, seed=5)
    lam = 0.5
    r = {r.g: r for r in models.fit(df, ["g"], ["a", "b", "c"], "y", lam).collect()}
    for g, part in pdf.groupby("g"):
        X = part[["a", "b", "c"]].to_numpy()
        y = part["y"].to_numpy()
        Z = (X - X.mean(0)) / X.std(0)
        zy = (y - y.mean()) / y.std()
        n = len(y)
        bs = np.linalg.solve(Z.T @ Z / n + lam * np.eye(3), Z.T @ zy / n)
        beta = bs * y.std() / X.std(0)
        np.testing.assert_allclose([r[g].b_a, r[g].b_b, r[g].b_c], beta, rtol=1e-6)
        np.testing.assert_allclose(r[g].intercept, y.mean() - beta @ X.mean(0), rtol=1e-6)


def test_collinear_and_constant_columns_are_solvable(spark):
    pdf = pd.DataFrame({"g": 1, "a": np.arange(20.0), "b": np.arange(20.0) * 2, "k": 3.0,
                        "y": np.arange(20.0) + 1})
    c = models.fit(spark.createDataFrame(pdf), ["g"], ["a", "b", "k"], "y", 1e-6).first()
    assert c.b_k == 0.0
    pred = c.intercept + c.b_a * pdf.a + c.b_b * pdf.b
    np.testing.assert_allclose(pred, pdf.y, atol=1e-3)


def test_score_imputes_missing_with_training_mean(spark):
    pdf, df = _data(spark)
    coefs = models.fit(df, ["g"], ["a", "b", "c"], "y", 0.0)
    probe = spark.createDataFrame([(1, None, 50.0, 3.0)], "g long, a double, b double, c double")
    p = models.score(probe, coefs, ["g"], ["a", "b", "c"], "p").first().p
    c = coefs.where("g = 1").first()
    assert abs(p - (c.intercept + c.b_a * c.mean_a + c.b_b * 50.0 + c.b_c * 3.0)) < 1e-9


def test_split_is_deterministic_80_20(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).cast("int").alias("asset_id"),
                                     F.timestamp_seconds(F.col("id") * 3600).alias("window_start"))
    a = models.with_split(df).agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.18 < a < 0.22
    assert models.with_split(df).where("is_test").count() == models.with_split(df).where("is_test").count()


def test_best_run_and_registry(spark):
    runs = spark.createDataFrame(
        [("r1", "m", 1, 0.1, "FINISHED", 1.0, 2.0, 0), ("r2", "m", 1, 1.0, "FINISHED", 1.0, 1.5, 0),
         ("r3", "m", 1, 10.0, "FAILED", 1.0, 0.5, 0), ("r4", "m", 1, 1.0, "FINISHED", 1.0, 0.0, 0)],
        "run_id string, model string, asset_id int, ridge double, status string, train_rmse double, "
        "test_rmse double, created_version long")
    assert models.best_runs(runs, ["asset_id"]).first().run_id == "r2"
    regs = spark.createDataFrame([("m", 1, "r1", 0), ("m", 1, "r2", 1)],
                                 "model_name string, asset_id int, run_id string, registered_round long")
    st = sorted((r.version, r.stage) for r in models.registry_stages(regs).collect())
    assert st == [(1, "Archived"), (2, "Production")]


def test_sweep_grid_is_exact_and_life_zero_keeps_row(spark):
    payload = spark.createDataFrame([(1, 0.5, 2.0)], "asset_id int, sensor1 double, sensor2 double")
    g = scenario.sweep_grid(payload).orderBy("setting").collect()
    assert len(g) == 8 and g[0].sensor1 == -0.015 and g[-1].sensor1 == -0.008
    pred = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0, 4.0)],
                                 "asset_id int, expected_output double, expected_life double")
    p = {r.asset_id: r for r in scenario.profit(pred).collect()}
    assert p[1].cost is None and p[1].profit is None and p[1].revenue == 87600.0
    assert p[2].profit == 87600.0 - 21900.0


def test_fleet_trees_beat_the_mean_on_training_rows(spark):
    from assetflow.plans import modeling as M
    from assetflow.plans.views import Views
    from assetflow import config
    from paths import SF_CHECK
    f = M.training_frame(Views(spark, SF_CHECK))
    model, dbl = models.fit_trees(f, config.FEATURES, M.OUT_LABEL, M.train(), dict(config.GBT_PARAMS, maxIter=3))
    s = models.score_trees(model, dbl, f, config.FEATURES, "p").where(~F.col("is_test"))
    mean = s.agg(F.avg(M.OUT_LABEL)).first()[0]
    r = s.agg(F.sqrt(F.avg(F.pow(F.col(M.OUT_LABEL) - F.col("p"), 2))).alias("m"),
              F.sqrt(F.avg(F.pow(F.col(M.OUT_LABEL) - F.lit(mean), 2))).alias("b")).first()
    assert r.m <= r.b
    imp = models.tree_importance(model, config.FEATURES)
    assert len(imp) == 11 and abs(sum(w for _, w in imp) - 1.0) < 1e-6
