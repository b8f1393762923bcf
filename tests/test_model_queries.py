"""Registered model analytics against brute force in numpy/pandas."""

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from assetflow import config
from assetflow.plans import catalog
from assetflow.plans import modeling as M
from assetflow.plans.views import Views
from paths import SF_CHECK

Q = E.queries()


def ridge_numpy(part: pd.DataFrame, feats, label, lam):
    """Standardised ridge on complete training rows, as a reader would write it."""
    t = part[~part.is_test].dropna(subset=feats + [label])
    X, y = t[feats].to_numpy(float), t[label].to_numpy(float)
    mx, sx, my, sy = X.mean(0), X.std(0), y.mean(), y.std()
    ok = sx > 1e-12 * (1 + np.abs(mx))
    Z = np.where(ok, (X - mx) / np.where(ok, sx, 1), 0.0)
    n = len(y)
    A = Z.T @ Z / n + np.diag(np.where(ok, lam, 1.0))
    b = Z.T @ ((y - my) / sy) / n if sy > 0 else np.zeros(len(feats))
    beta = np.where(ok, np.linalg.solve(A, b) * sy / np.where(ok, sx, 1), 0.0)
    return my - beta @ mx, beta, mx


@pytest.fixture(scope="module")
def train_pdf(spark):
    return M.training_frame(Views(spark, SF_CHECK)).toPandas()


def test_output_predictions_equal_numpy(spark, train_pdf):
    got = Q["output_predictions"](spark, SF_CHECK).toPandas()
    assert len(got) == len(train_pdf)
    feats = config.FEATURES
    want = []
    for a, part in train_pdf.groupby("asset_id"):
        b0, beta, mx = ridge_numpy(part, feats, M.OUT_LABEL, config.RIDGE)
        X = part[feats].to_numpy(float)
        X = np.where(np.isnan(X), mx, X)
        want.append(pd.DataFrame({"asset_id": a, "window_start": part.window_start, "w": b0 + X @ beta}))
    m = got.merge(pd.concat(want), on=["asset_id", "window_start"])
    assert len(m) == len(got)
    np.testing.assert_allclose(m[M.OUT_PRED], m["w"], rtol=1e-6, atol=1e-4)


def test_model_rmse_equals_numpy(spark):
    got = Q["model_rmse"](spark, SF_CHECK).toPandas()
    pred = Q["output_predictions"](spark, SF_CHECK).toPandas()
    pred["sq"] = (pred[M.OUT_LABEL] - pred[M.OUT_PRED]) ** 2
    want = pred.groupby(["asset_id", "is_test"]).sq.mean().pow(0.5).unstack()
    g = got[got.model == M.OUTPUT_MODEL].set_index("asset_id")
    np.testing.assert_allclose(g.loc[want.index, "train_rmse"], want[False].round(6), atol=2e-6)
    np.testing.assert_allclose(g.loc[want.index, "test_rmse"], want[True].round(6), atol=2e-6)


def test_best_model_is_the_lowest_test_rmse(spark, train_pdf):
    best = Q["best_model"](spark, SF_CHECK).toPandas()
    feats = config.FEATURES
    for (model, a), row in best.set_index(["model", "asset_id"]).iterrows():
        label = M.OUT_LABEL if model == M.OUTPUT_MODEL else M.LIFE_LABEL
        part = train_pdf[train_pdf.asset_id == a].dropna(subset=[label])  # no label: neither trained on nor scored
        scores = {}
        for lam in config.RIDGE_CANDIDATES:
            b0, beta, mx = ridge_numpy(part, feats, label, lam)
            X = part[feats].to_numpy(float)
            X = np.where(np.isnan(X), mx, X)
            r = part[label].to_numpy(float) - (b0 + X @ beta)
            scores[lam] = np.sqrt(np.mean(r[part.is_test.to_numpy()] ** 2))
        assert row.ridge == min(scores, key=lambda k: (scores[k], k)) or \
            abs(scores[row.ridge] - min(scores.values())) < 1e-9
        assert abs(row.test_rmse - round(scores[row.ridge], 6)) < 2e-6


def test_sweep_profit_and_optimum_are_consistent(spark):
    curve = Q["profit_curve"](spark, SF_CHECK).toPandas()
    assert curve.groupby("asset_id").size().eq(config.SWEEP_POINTS).all()
    rev = curve.expected_output * config.HOURS_PER_YEAR * config.PRICE
    # the output is reported to 6 digits: revenue carries hours * 5e-7 of rounding
    np.testing.assert_allclose(curve.revenue, rev, rtol=1e-9, atol=config.HOURS_PER_YEAR * config.PRICE * 5.1e-7)
    life = curve.expected_life.replace(0, np.nan)
    # life is reported to 6 digits: rev / life carries rev * 5e-7 / life^2 of rounding
    # and the output's rounding goes into revenue and cost
    bound = (rev.abs() * 1e-6 / life ** 2 + 1e-3 + config.HOURS_PER_YEAR * config.PRICE * 5.1e-7 * (1 + 1 / life.abs())).to_numpy()
    diff = (curve.profit - (rev - rev / life)).abs().to_numpy()
    assert (diff[~np.isnan(diff)] <= bound[~np.isnan(diff)]).all()
    opt = Q["optimal_setting"](spark, SF_CHECK).toPandas().set_index("asset_id")
    ok = curve.dropna(subset=["profit"])
    for a, part in ok.groupby("asset_id"):
        top = part.sort_values(["profit", "sensor1"], ascending=[False, True]).iloc[0]
        assert opt.loc[a, "best_setting"] == top.sensor1
    k = Q["fleet_kpis"](spark, SF_CHECK).toPandas()
    assert k.assets.sum() == len(opt)
    np.testing.assert_allclose(k.total_profit.sum(), opt.profit.sum(), rtol=1e-9)


def test_registry_has_one_production_version_per_model_and_asset(spark):
    reg = Q["promoted_models"](spark, SF_CHECK).toPandas()
    prod = reg[reg.stage == "Production"]
    assert not prod.duplicated(["model_name", "asset_id"]).any()
    assert set(map(tuple, prod[["model_name", "asset_id"]].values)) == \
        set(map(tuple, reg[["model_name", "asset_id"]].values))
    assert (prod.version == reg.groupby(["model_name", "asset_id"]).version.transform("max")[prod.index]).all()


def test_actual_vs_predicted_takes_a_threshold(spark, train_pdf):
    got = catalog.actual_vs_predicted(spark, SF_CHECK, 300.0).toPandas().set_index("reading_date").actual
    want = train_pdf[train_pdf[M.OUT_LABEL] > 300.0].groupby("reading_date")[M.OUT_LABEL].mean()
    np.testing.assert_allclose(got.loc[want.index], want, atol=2e-6)
    assert len(got) == len(want)


def test_usage_clusters_beat_the_mean(spark, train_pdf):
    got = Q["usage_cluster_model"](spark, SF_CHECK).toPandas()
    y = train_pdf[~train_pdf.is_test][M.OUT_LABEL].dropna()
    assert (got.grouping == "usage_cluster").all() and got.group.is_unique
    assert got.train_rmse.min() <= y.std()


def test_tree_importances_are_shares(spark):
    got = Q["tree_importance"](spark, SF_CHECK).toPandas()
    assert sorted(got.feature) == sorted(config.FEATURES + ["asset_id"])
    assert (got.importance >= 0).all() and abs(got.importance.sum() - 1) < 1e-5
