"""Fits on channels far from zero, constant channels, and lives that are not positive."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetflow import config
from assetflow.operators import models, scenario


@pytest.mark.parametrize("mean", [0.0, 1e7, 1e8])
def test_slope_far_from_zero(spark, mean):
    r = np.random.default_rng(1)
    x = mean + r.normal(size=400)
    rows = [(1, float(a), 300.1, float(2 * (a - mean) + 5)) for a in x]
    df = spark.createDataFrame(rows, "g int, a double, c double, y double").repartition(5)
    c = models.fit(df, ["g"], ["a", "c"], "y", 0.0).first()
    assert c.b_a == pytest.approx(2, abs=1e-6) and c.b_c == 0 and c.sd_c < 1e-9


def test_moments_run_in_generated_code(spark):
    """With all features; groups with a NULL key and with one row are groups, a constant channel has variance 0."""
    r = np.random.default_rng(2)
    names = [*config.FEATURES, "y"]
    rows = [(None if i % 3 == 0 else i % 3, *[float(v) for v in r.normal(size=10)], 0.1, float(i)) for i in range(90)] + [(7, *[1.5] * 12)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    gram = models.gram(df, ["g"], config.FEATURES, "y")
    found = {x.g: x for x in gram.collect()}
    plan = gram._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "HashAggregate" in final and all("*(" in line for line in final.splitlines() if "HashAggregate" in line), final
    assert set(found) == {None, 1, 2, 7} and found[7].n == 1 and found[7].c0_3 == 0
    for g in (None, 1, 2):
        x = np.array([v[1:] for v in rows if v[0] == g])
        want = np.cov(x.T, bias=True)
        assert found[g].c10_10 == 0 and found[g].n == 30 and found[g].my == pytest.approx(x[:, 11].mean())
        assert [found[g][f"c{j}_{k}"] for j, k in models._pairs(11)] == pytest.approx([want[j, k] for j, k in models._pairs(11)], abs=1e-12)
        assert [found[g][f"cy{j}"] for j in range(11)] == pytest.approx(want[11, :11].tolist(), abs=1e-12)


def test_no_profit_without_a_life(spark):
    pred = spark.createDataFrame([(1, 0.1, 10.0, -2.0), (1, 0.2, 10.0, 0.0), (1, 0.3, 10.0, 4.0)],
                                 "asset_id int, sensor1 double, expected_output double, expected_life double")
    out = scenario.profit(pred)
    assert out.where(F.col("cost").isNull() & F.col("profit").isNull()).count() == 2
    assert scenario.optimal_setting(out).first().best_setting == 0.3
