"""The keyed table by date: upserts, deletes, typed feed, folds, pruning, replays."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetflow.operators import changelog, keyed
from assetflow.session import scratch_path
from assetflow.sources import files, fixtures
from assetflow.streaming.medallion import Medallion, READING_SCHEMA
from paths import SF_SMALL

FIELDS = [T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())]
DAY = dt.date(2024, 1, 1)


def _table(spark, name, every=3):
    return keyed.KeyedTable(spark, scratch_path(spark, name), FIELDS, ["k"], "d", fold_every=every)


def _set(spark, rows):
    """(key, day, value or None for a delete)"""
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=d), x, x is None) for k, d, x in rows], "k string, d date, x double, _deleted boolean")


def _now(t, **kw):
    return sorted((r.k, (r.d - DAY).days, r.x) for r in t.current(**kw).collect())


def _feed(t, version=None):
    rows = t.feed() if version is None else t.feed().where(F.col(changelog.VERSION) == version)
    return sorted((r._commit_version, r.k, r._change_type, r.x) for r in rows.collect())


def test_typed_changes_with_deletes_over_folds(spark):
    t = _table(spark, "t_keyed", every=2)
    t.upsert(_set(spark, [("a", 0, 1.0), ("b", 0, 2.0), ("c", 5, 3.0)]), 0)
    t.upsert(_set(spark, [("a", 0, None), ("b", 0, 2.5), ("z", 0, None)]), 1)  # folds; z was never there
    assert t.folded() == 1
    t.upsert(_set(spark, [("a", 0, 9.0), ("c", 5, None)]), 2)
    t.upsert(_set(spark, [("c", 5, None), ("b", 0, 2.5)]), 3)  # c is gone already
    assert _feed(t) == [(0, "a", "insert", 1.0), (0, "b", "insert", 2.0), (0, "c", "insert", 3.0), (1, "a", "delete", 1.0),
                        (1, "b", "update_postimage", 2.5), (1, "b", "update_preimage", 2.0), (2, "a", "insert", 9.0), (2, "c", "delete", 3.0),
                        (3, "b", "update_postimage", 2.5), (3, "b", "update_preimage", 2.5)]
    assert t.folded() == 3 and _now(t) == [("a", 0, 9.0), ("b", 0, 2.5)]
    t.upsert(_set(spark, [("b", 0, 2.5), ("e", 1, 1.0)]), 4, minimal=True)
    assert _feed(t, 4) == [(4, "e", "insert", 1.0)]


def test_a_fold_rewrites_only_touched_dates_and_reads_are_pruned(spark):
    t = _table(spark, "t_prune", every=2)
    t.upsert(_set(spark, [(f"k{i}", i, float(i)) for i in range(10)]), 0)
    t.upsert(_set(spark, [("k3", 3, 33.0)]), 1)
    first = t._bases()
    t.upsert(_set(spark, [("k4", 4, 44.0)]), 2)
    t.upsert(_set(spark, [("k4", 4, 45.0), ("k5", 5, None)]), 3)
    now = t._bases()
    changed = {(d - DAY).days for d in first if now.get(d) != first[d]}
    assert changed == {4, 5} and DAY + dt.timedelta(days=5) not in now
    t.upsert(_set(spark, [("k9", 9, 99.0)]), 4)
    lo = DAY + dt.timedelta(days=3)
    assert _now(t, lo=lo, hi=lo + dt.timedelta(days=1)) == [("k3", 3, 33.0), ("k4", 4, 45.0)]
    assert len(t.base(lo, lo).inputFiles()) == 1
    plan = t.current(lo=lo, hi=lo)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(_commit_version#\d+L > 3\), \(d#\d+ >= 2024", plan), plan
    before = _now(t)
    t.vacuum()
    assert _now(t) == before and t._numbers("log") == [4] and t.newest_version() == 4


def test_replays_write_nothing_twice(spark, monkeypatch):
    t = _table(spark, "t_replay", every=2)
    sets = [[("a", 0, 1.0)], [("a", 0, 2.0), ("b", 1, 1.0)], [("b", 1, None)]]
    for v, rows in enumerate(sets):
        assert t.upsert(_set(spark, rows), v)
        feed = _feed(t)
        assert not t.upsert(_set(spark, rows), v) and _feed(t) == feed
    # the feed of a version is lost before it has its place: it is worked out again from the log
    t.store.delete(t._at("feed", 2))
    assert not t.upsert(_set(spark, sets[2]), 2)
    assert _feed(t, 2) == [(2, "b", "delete", 1.0)] and _now(t) == [("a", 0, 2.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=4), min_size=1, max_size=6))
def test_equals_a_dictionary(spark, batches):
    t = _table(spark, "t_prop", every=2)
    have, want = {}, []
    for v, batch in enumerate(batches):
        rows = dict(batch)
        t.upsert(_set(spark, [(k, ord(k) % 3, None if x is None else float(x)) for k, x in rows.items()]), v)
        for k, x in rows.items():
            if x is None:
                want += [(v, k, "delete", have.pop(k))] if k in have else []
            else:
                want += [(v, k, "update_preimage", have[k]), (v, k, "update_postimage", float(x))] if k in have else [(v, k, "insert", float(x))]
                have[k] = float(x)
    assert _now(t) == sorted((k, ord(k) % 3, x) for k, x in have.items()) and _feed(t) == sorted(want)


def test_newest_change_of_a_slice(spark):
    t = _table(spark, "t_newest", every=9)
    t.upsert(_set(spark, [("a", 0, 1.0), ("b", 0, 2.0)]), 0)
    t.upsert(_set(spark, [("a", 0, 5.0), ("b", 0, None)]), 1)
    got = {r.k: (r.x, r._deleted) for r in keyed.newest_changes(t.feed(), ["k"]).collect()}
    assert got == {"a": (5.0, False), "b": (2.0, True)}


def test_a_slice_of_one_version_and_the_current_rows_move_no_row_needlessly(spark):
    """One version's changes are taken without a shuffle; the current rows are sorted after theirs, not before as well."""
    t = _table(spark, "t_one", every=9)
    t.upsert(_set(spark, [("a", 0, 1.0), ("b", 0, 2.0), (None, 0, 3.0)]), 0)
    t.upsert(_set(spark, [("a", 0, 5.0), ("b", 0, None)]), 1)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    second = t.feed().where(F.col(changelog.VERSION) == 1)
    every, one = keyed.newest_changes(second, ["k"]), keyed.newest_changes(second, ["k"], one_version=True)
    assert set(map(tuple, every.collect())) == set(map(tuple, one.select(*every.columns).collect())) and one.count() == 2 and every.dtypes == one.dtypes
    assert "Exchange" not in plan(one) and "Sort" not in plan(one)
    assert {(r.k, r.x) for r in t.current().collect()} == {("a", 5.0), (None, 3.0)}
    after = plan(t.current()).split("Exchange")
    assert len(after) == 2 and "Aggregate" not in after[1] and after[0].count("Sort [") == 1


def test_gold_follows_deletes_and_fills_the_catalog_table(spark):
    """Deletes in silver reach gold; gold's current rows are in the declared table of the catalog."""
    spark.sql(f"CREATE DATABASE keyed_test LOCATION '{scratch_path(spark, 't_catalog')}'")
    m = Medallion(spark, scratch_path(spark, "t_gold"), assets=lambda: fixtures.assets(spark, SF_SMALL), gold_table="keyed_test.enriched_readings", gold_feed=True,
                  fold_every=2)
    ids = [r.asset_id for r in fixtures.assets(spark, SF_SMALL).orderBy("asset_id").limit(2).collect()]
    t0 = dt.datetime(2024, 1, 6, 1)
    rows = [(t0 + dt.timedelta(days=d), a) + (float(d),) * 9 for d in range(2) for a in ids]
    files.write_landing(spark.createDataFrame(rows, READING_SCHEMA), m.landing)
    m.run_available_now()
    stored = lambda: sorted((r.asset_id, r.reading_date.day, r.sensor1) for r in spark.table("keyed_test.enriched_readings").collect())
    now = lambda: sorted((r.asset_id, r.reading_date.day, r.sensor1) for r in m.gold_current().collect())
    assert stored() == now() == sorted((a, 6 + d, float(d)) for d in range(2) for a in ids)
    version = m.silver.newest_version() + 1
    gone = m.silver_current().where((F.col("asset_id") == ids[0]) | (F.col("reading_date") == dt.date(2024, 1, 7)))
    m.silver.upsert(gone.withColumn(keyed.DELETED, F.lit(True)), version)
    m.run_available_now()
    assert stored() == now() == [(ids[1], 6, 0.0)]
    assert m.gold.feed().where(F.col(changelog.CHANGE) == "delete").count() == 3
    spark.sql("DROP DATABASE keyed_test CASCADE")
