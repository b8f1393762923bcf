"""Boosted trees by histograms against a plain numpy version; error by round; trees in the registry and the sweep."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetflow.operators import models, trees

FEATURES = ["a", "b", "c"]
P = trees.Params(rounds=3, depth=3, rate=0.5, alpha=0.5, l2=1.0, columns=0.7, least_rows=1)


def _data(n=240, seed=3):
    """Three assets; labels are steps of the features, one asset's are noise; NULLs in a feature."""
    rng = np.random.default_rng(seed)
    rows = []
    for asset in (1, 2, 3):
        for i in range(n):
            a, b, c = (round(float(v), 3) for v in rng.normal(size=3))
            y = (3.0 if a > 0.2 else -1.0) * (2.0 if b > 0 else 1.0) if asset < 3 else float(rng.normal())
            rows.append((asset, i, None if i % 17 == 0 else a, b, c, None if i == 5 else round(y, 3), i % 5 == 0))
    return rows


SCHEMA = "asset_id int, i int, a double, b double, c double, y double, is_test boolean"


def _plain(rows, sample):
    """One asset's ensemble in numpy: nodes of each tree and the predictions."""
    x = np.array([[np.nan if v is None else v for v in r[2:5]] for r in rows if r[5] is not None])
    y = np.array([r[5] for r in rows if r[5] is not None])
    test = np.array([r[6] for r in rows if r[5] is not None])
    cuts = []
    for j in range(3):
        v = np.sort(x[~test][~np.isnan(x[~test, j]), j])
        cuts.append(sorted({v[max(0, math.ceil(i / trees.BINS * len(v)) - 1)] for i in range(1, trees.BINS)}))
    bins = np.array([[0 if np.isnan(v) else sum(e < v for e in cuts[j]) + 1 for j, v in enumerate(r)] for r in x])
    f = np.full(len(y), y[~test].mean())
    shrunk = lambda g: np.sign(g) * max(abs(g) - P.alpha, 0)
    score = lambda g, n: shrunk(g) ** 2 / (n + P.l2)
    out = []
    for r in range(1, P.rounds + 1):
        g = f - y
        at, tree = np.ones(len(y), int), {}
        for _ in range(P.depth):
            for node in sorted(set(at) - set(tree)):
                m = (at == node) & ~test
                best = None
                for j in sorted(sample[r]):
                    for b in sorted(set(bins[m, j])):
                        left = m & (bins[:, j] <= b)
                        nl, nr = left.sum(), m.sum() - left.sum()
                        if not nl or not nr:
                            continue
                        gain = round(score(g[left].sum(), nl) + score(g[m].sum() - g[left].sum(), nr) - score(g[m].sum(), m.sum()), 9)
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = gain, j, b
                if best:
                    tree[node] = best
            split = np.array([n in tree for n in at])
            deep = at.copy()
            for i in np.flatnonzero(split & (at < 2 ** P.depth)):
                _, j, b = tree[at[i]]
                deep[i] = 2 * at[i] + (bins[i, j] > b)
            at = deep
        if tree:
            for leaf in set(at):
                m = (at == leaf) & ~test
                f = np.where(at == leaf, f - P.rate * shrunk(g[m].sum()) / (m.sum() + P.l2) if m.any() else f, f)
        out.append(tree)
    return out, f, y, test


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(_data(), SCHEMA).repartition(4)
    nodes, errors = trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=P)
    return df, nodes, errors


def test_equals_the_plain_version(spark, fitted):
    df, nodes, errors = fitted
    asked = spark.createDataFrame([(a,) for a in (1, 2, 3)], "asset_id int")
    sample = {r: {x.asset_id: x.s for x in asked.select("asset_id", trees.sampled(["asset_id"], r, 3, P).alias("s")).collect()} for r in (1, 2, 3)}
    assert all(len(v) == 2 for s in sample.values() for v in s.values())
    scored = trees.score(df, trees.packed(nodes, ["asset_id"], FEATURES), ["asset_id"], FEATURES, "p", P.depth).collect()
    for asset in (1, 2, 3):
        rows = [r for r in _data() if r[0] == asset]
        want, f, y, test = _plain(rows, {r: sample[r][asset] for r in sample})
        for r, tree in enumerate(want, 1):
            got = {n.node: (n.feature, n.gain) for n in nodes.where((F.col("asset_id") == asset) & (F.col("round") == r) & ~F.col("is_leaf")).collect()}
            assert {k: v[0] for k, v in got.items()} == {k: v[1] for k, v in tree.items()}
            assert all(got[k][1] == pytest.approx(tree[k][0], abs=1e-6) for k in got)
        mine = {r.i: r.p for r in scored if r.asset_id == asset}
        assert [mine[r[1]] for r in rows if r[5] is not None] == pytest.approx(f.tolist(), abs=1e-9)
        last = errors.where((F.col("asset_id") == asset) & (F.col("round") == P.rounds)).first()
        assert last.test_rmse == pytest.approx(math.sqrt(((f - y)[test] ** 2).mean())) and last.train_rmse == pytest.approx(math.sqrt(((f - y)[~test] ** 2).mean()))


def test_beats_ridge_where_the_label_is_not_linear(spark, fitted):
    df, nodes, errors = fitted
    by = {(r.asset_id, r.round): r for r in errors.collect()}
    coefs = models.fit(df, ["asset_id"], FEATURES, "y", 1e-3, ~F.col("is_test"))
    ridge = {r.asset_id: r.test_rmse for r in models.rmse(models.score(df, coefs, ["asset_id"], FEATURES, "p"), ["asset_id"], "y", "p").collect()}
    for asset in (1, 2):
        assert by[asset, 3].test_rmse < 0.8 * ridge[asset]
        assert by[asset, 0].train_rmse > by[asset, 1].train_rmse > by[asset, 2].train_rmse > by[asset, 3].train_rmse
    shares = {(r.asset_id, r.feature): r.importance for r in trees.importance(nodes, ["asset_id"], FEATURES).collect()}
    assert sum(v for (a, _), v in shares.items() if a == 1) == pytest.approx(1) and shares[1, "c"] == min(shares[1, c] for c in FEATURES)


def test_awkward_groups(spark):
    rows = [(1, 0, None, None, None, 2.0, False), (1, 1, None, None, None, 4.0, False), (2, 0, 1.0, 1.0, 1.0, None, False), (3, 0, 1.0, 2.0, 3.0, 5.0, True),
            (4, 0, 1.0, 1.0, 1.0, 7.0, False)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes, errors = trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=P)
    got = {(r.asset_id, r.i): r.p for r in trees.score(df, trees.packed(nodes, ["asset_id"], FEATURES), ["asset_id"], FEATURES, "p", P.depth).collect()}
    assert got == {(1, 0): 3.0, (1, 1): 3.0, (2, 0): None, (3, 0): None, (4, 0): 7.0}
    assert trees.fit(df.where("false"), ["asset_id"], ["i"], FEATURES, "y", p=P)[0].count() == 0


class _Rows:
    """Views over given training rows."""

    def __init__(self, spark, rows):
        self.spark, self._rows = spark, rows

    def materialized(self, name, build):
        memo = self.__dict__.setdefault("_memo", {"training": self._rows})
        if name not in memo:
            memo[name] = build()
        return memo[name]


def test_an_ensemble_in_production_serves_the_sweep(spark):
    """Where trees have the least held-out error they are registered, scored from their node rows, and the sweep changes."""
    import datetime as dt

    from assetflow import config
    from assetflow.operators import scenario
    from assetflow.plans import modeling as M
    from assetflow.session import scratch_path

    rng = np.random.default_rng(4)
    rows = []
    for asset in (1, 2):
        for i in range(160):
            x = [round(float(v), 3) for v in rng.normal(size=9) / 100]
            out = (5.0 if x[0] > -0.0115 else 1.0) if asset == 1 else 3 + 100 * x[0]  # asset 1 steps inside the grid, asset 2 is linear
            rows.append((dt.date(2024, 1, 1 + i // 24), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), asset, 10, 5, *x, out, out, i % 5 == 0))
    cols = ["remaining_life int", "age int", *[f"{c} double" for c in config.CHANNELS], "oil_output double", "output_6_hours_ahead double", "is_test boolean"]
    df = spark.createDataFrame(rows, "reading_date date, window_start timestamp, asset_id int, " + ", ".join(cols))
    df = df.withColumn("oil_output", F.lit(0.0)).withColumn("remaining_life", F.col("age") + F.col("asset_id"))
    v = _Rows(spark, df)
    store = M.ModelStore(spark, scratch_path(spark, "t_models"))
    store.record(v, 0)
    grid = scenario.sweep_grid(scenario.latest_payload(df))
    sweep = lambda: {(r.asset_id, r.setting): r.expected_output for r in scenario.sweep_predictions(
        grid, store.production(M.OUTPUT_MODEL), store.production(M.LIFE_MODEL)).collect()}
    before = sweep()
    store.record(v, 1, boosted=trees.Params(rounds=6, depth=3, alpha=0.0, columns=1.0))
    kind = {(r.asset_id): r.trees is not None for r in store.production(M.OUTPUT_MODEL).collect()}
    assert kind == {1: True, 2: False}
    after = sweep()
    low, high = after[1, 0], after[1, 7]  # -0.015 and -0.008, on the two sides of the step
    assert low < 2 and high > 4 and any(abs(after[k] - before[k]) > 0.5 for k in before if k[0] == 1)
    assert all(after[k] == pytest.approx(before[k]) for k in before if k[0] == 2)
    stages = {(r.asset_id, r.stage): r.run_id for r in store.stages().where(F.col("model_name") == M.OUTPUT_MODEL).collect()}
    assert "trees" in stages[1, "Production"] and "trees" not in stages[1, "Archived"]


def _fields(frame, *order):
    """Rows with doubles to 9 digits, in order."""
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.orderBy(*order).collect()]


def test_short_and_long_groups_grow_the_same_trees(spark):
    """By one task a block of groups, by one job a level, and both beside one another."""
    df = spark.createDataFrame([r for r in _data() if r[0] != 2 or r[1] < 90] + [(None, 0, 1.0, 1.0, 1.0, 1.0, False)], SCHEMA).repartition(3)
    p = P._replace(least_rows=3)
    found = [trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=p, local_rows=most) for most in (1000, 0, 100)]
    nodes = [_fields(n, "asset_id", "round", "node") for n, _ in found]
    errors = [_fields(e, "asset_id", "round") for _, e in found]
    assert nodes[0] == nodes[1] == nodes[2] and len(nodes[0]) > 60
    assert errors[0] == errors[1] == errors[2] and len(errors[0]) == 3 * (p.rounds + 1)
    assert found[0][0].columns == found[1][0].columns and [t for _, t in found[0][0].dtypes] == [t for _, t in found[1][0].dtypes]


def test_jobs_do_not_grow_with_the_trees_of_short_groups(spark):
    df = spark.createDataFrame(_data(60), SCHEMA)
    jobs = []
    for rounds in (1, 6):
        spark.sparkContext.setJobGroup(f"t_trees_{rounds}", "")
        trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=P._replace(rounds=rounds))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"t_trees_{rounds}")))
    spark.sparkContext.setJobGroup("t_rest", "")
    assert 0 < jobs[1] <= jobs[0] + 2 and jobs[1] < 25, jobs


def test_blocks_hold_groups_whole(spark, monkeypatch):
    """Many groups over several blocks: each is found once, and none depends on its neighbours."""
    monkeypatch.setattr(trees, "BLOCK_ROWS", 64)
    rows = [(10 * k + r[0], *r[1:]) for k in range(6) for r in _data(40, seed=k)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes, errors = trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=P)
    assert errors.count() == 18 * (P.rounds + 1) and errors.select("asset_id", "round").distinct().count() == 18 * (P.rounds + 1)
    alone = trees.fit(df.where("asset_id = 31"), ["asset_id"], ["i"], FEATURES, "y", p=P)
    assert _fields(nodes.where("asset_id = 31"), "round", "node") == _fields(alone[0], "round", "node")


def test_short_groups_are_cut_by_their_task(spark, monkeypatch):
    """No quantile aggregate over short groups' rows; cuts and bins are those of the aggregate, groups with given cuts keep them."""
    rows = [r for r in _data(130) if r[0] != 3] + [(3, 0, 2.0, -0.5, 0.5, 1.0, False), (3, 1, None, 0.0, 1.0, 2.0, False), (3, 2, None, 5.0, float("inf"), 3.0, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    edges = trees.cuts(df.where("NOT is_test"), ["asset_id"], FEATURES).localCheckpoint()
    want = {(r.asset_id, r.i): list(r.bins) for r in trees.binned(df, edges, ["asset_id"], FEATURES).collect()}
    by_group = {r.asset_id: r.cuts for r in edges.collect()}
    x = np.array([[np.nan if v is None else v for v in r[2:5]] for r in rows])
    null = np.array([[v is None for v in r[2:5]] for r in rows])
    at, train = np.array([r[0] - 1 for r in rows]), np.array([not r[6] for r in rows])
    for given in ([None] * 3, [by_group[1], None, by_group[3]]):
        found, bins = trees.local_cuts(x, null, at, train, given)
        assert {(r[0], r[1]): b.tolist() for r, b in zip(rows, bins, strict=True)} == want
        for g in (1, 2, 3):
            for i in range(3):
                np.testing.assert_array_equal(found[g - 1, i, :len(by_group[g][i])], by_group[g][i])
                assert np.isnan(found[g - 1, i, len(by_group[g][i]):]).all()
    nan = trees.local_cuts(np.array([[1.0], [np.nan], [2.0]]), np.zeros((3, 1), bool), np.zeros(3, int), np.ones(3, bool), [None])
    assert nan[1].ravel().tolist() == [1, 3, 2]  # above all else, not as a NULL

    def unused(*_):
        raise AssertionError("a quantile aggregate over short groups")

    monkeypatch.setattr(trees, "cuts", unused)
    _, errors = trees.fit(df, ["asset_id"], ["i"], FEATURES, "y", p=P)
    assert errors.count() == 3 * (P.rounds + 1)
