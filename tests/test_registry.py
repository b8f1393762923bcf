"""The stored run log and registry, and serving from the Production versions."""

from assetflow import config
from assetflow.plans import modeling as M
from assetflow.plans.views import Views
from assetflow.session import scratch_path
from paths import SF_SMALL


def _swept(v, store):
    rows = M.sweep(v, store).select("asset_id", "setting", "expected_output").collect()
    return {(r.asset_id, r.setting): r.expected_output for r in rows}


def test_promotion_changes_what_the_sweep_is_scored_by(spark):
    early, late = (Views(spark, SF_SMALL, d) for d in config.RETRAIN_AS_OF)
    store = M.ModelStore(spark, scratch_path(spark, "models"))
    store.record(early, 0)
    before, first_runs = _swept(late, store), store.runs().count()
    assert {r.stage for r in store.stages().collect()} == {"Production"}
    store.record(late, 1)
    after = _swept(late, store)
    assert before.keys() == after.keys() and any(before[k] != after[k] for k in after)
    assert store.runs().where("created_version = 0").count() == first_runs  # earlier runs are kept
    stages, runs = sorted(store.stages().collect()), store.runs().count()
    served = {(r.model_name, r.asset_id): r.run_id for r in stages if r.stage == "Production"}
    production = store.production(M.OUTPUT_MODEL).unionByName(store.production(M.LIFE_MODEL)).collect()
    assert {(r.model, r.asset_id): r.run_id for r in production} == served
    store.record(late, 1)  # a replayed round replaces itself
    assert sorted(store.stages().collect()) == stages and store.runs().count() == runs
