import datetime as dt

from hypothesis import given, settings, strategies as st

from assetflow.operators import changelog
from assetflow.session import scratch_path

K = ["k"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v double")


def rows(df, cols=("k", "v")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_current_and_feed(spark):
    path = scratch_path(spark, "t_upsert")
    changelog.append_version(batch(spark, [("a", 0.0), ("b", 0.0)]), path, 0)
    changelog.append_version(batch(spark, [("b", 1.0), ("c", 1.0)]), path, 1)
    log = spark.read.parquet(path)
    assert rows(changelog.current(log, K)) == [("a", 0.0), ("b", 1.0), ("c", 1.0)]
    feed = changelog.change_feed(log, K)
    got = rows(feed, ("k", "_change_type", "_commit_version", "v"))
    assert got == [("a", "insert", 0, 0.0), ("b", "insert", 0, 0.0), ("b", "update_postimage", 1, 1.0),
                   ("b", "update_preimage", 1, 0.0), ("c", "insert", 1, 1.0)]
    assert rows(changelog.latest_change(feed, K)) == rows(changelog.current(log, K))


def test_replayed_batch_leaves_state_unchanged(spark):
    path = scratch_path(spark, "t_replay")
    changelog.append_version(batch(spark, [("a", 0.0), ("b", 0.0)]), path, 0)
    changelog.append_version(batch(spark, [("b", 1.0), ("c", 1.0)]), path, 1)
    before = rows(changelog.current(spark.read.parquet(path), K))
    changelog.append_version(batch(spark, [("b", 1.0), ("c", 1.0)]), path, 1)
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert rows(changelog.current(log, K)) == before


def test_minimal_feed_drops_unchanged_reemissions(spark):
    path = scratch_path(spark, "t_minimal")
    changelog.append_version(batch(spark, [("a", 0.0)]), path, 0)
    changelog.append_version(batch(spark, [("a", 0.0)]), path, 2)  # versions may have gaps
    feed = changelog.change_feed(spark.read.parquet(path), K, minimal=True)
    assert rows(feed, ("k", "_change_type")) == [("a", "insert")]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9)), max_size=6), min_size=1, max_size=4))
def test_upserts_in_order_equal_last_write_per_key(spark, batches):
    path = scratch_path(spark, "t_prop")
    want = {}
    for i, b in enumerate(batches):
        dedup = {k: float(v) for k, v in b}  # one row per key within a batch
        if dedup:
            changelog.append_version(batch(spark, list(dedup.items())), path, i)
        want.update(dedup)
    if not want:
        return
    log = spark.read.parquet(path)
    assert rows(changelog.current(log, K)) == sorted(want.items())
    # replaying the feed (latest non-preimage per key) gives the current table
    assert rows(changelog.latest_change(changelog.change_feed(log, K), K)) == sorted(want.items())


def test_backfill_versions_mean_over_prefix(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    df = spark.createDataFrame([(t0 + dt.timedelta(minutes=m), 1, float(m)) for m in (5, 20, 40, 50)],
                               "event_time timestamp, asset_id int, sensor1 double")
    out = changelog.backfill_versions(df, ["2024-01-01 10:30:00"], "1 hour", ["sensor1"])
    got = sorted((r._commit_version, r.sensor1) for r in out.collect())
    assert got == [(0, 12.5), (1, 28.75)]


def test_fold_then_read_base_plus_newer_versions(spark):
    path = scratch_path(spark, "t_fold")
    changelog.append_version(batch(spark, [("a", 0.0), ("b", 0.0)]), path, 0)
    changelog.append_version(batch(spark, [("b", 1.0)]), path, 1)
    base_v = changelog.fold(spark.read.parquet(path), K, path + "_base")
    assert base_v == 1
    changelog.append_version(batch(spark, [("a", 2.0), ("c", 2.0)]), path, 2)
    log = spark.read.parquet(path)
    got = changelog.current_from(spark.read.parquet(path + "_base"), log, K, base_v)
    assert rows(got) == rows(changelog.current(log, K)) == [("a", 2.0), ("b", 1.0), ("c", 2.0)]


def test_a_deleted_key_is_not_a_latest_change(spark):
    feed = spark.createDataFrame([("a", 1.0, "insert", 0, None), ("a", None, "delete", 1, None), ("b", 2.0, "insert", 0, None)],
                                 "k string, v double, _change_type string, _commit_version long, _commit_timestamp timestamp")
    assert rows(changelog.latest_change(feed, K)) == [("b", 2.0)]
