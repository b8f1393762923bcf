import datetime as dt

from pyspark.sql import functions as F

from assetflow import config
from assetflow.operators import aggregate
from assetflow.session import scratch_path
from assetflow.sources import files, fixtures, landing
from assetflow.streaming.medallion import READING_SCHEMA, Medallion, stream_in_slices
from paths import SF_SMALL


def _round(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r)
                  for r in df.select("asset_id", "window_start", *config.CHANNELS).collect())


def test_stream_equals_batch_and_gold_is_enriched(spark):
    r = fixtures.readings(spark, SF_SMALL)
    m = Medallion(spark, scratch_path(spark, "t_med"), assets=lambda: fixtures.assets(spark, SF_SMALL))
    stream_in_slices(m, r, ["2024-01-10 12:30:00", "2024-01-20 12:30:00"])
    assert m.dropped_late_rows() == 0
    assert _round(m.silver_current()) == _round(aggregate.windowed_avg(r))
    gold = m.gold_current()
    want = aggregate.windowed_avg(r).join(fixtures.assets(spark, SF_SMALL), "asset_id")
    assert gold.count() == want.count()
    assert set(gold.columns) >= {"country", "manufacturer", "region"}
    assert "_commit_version" in m.gold_log().columns
    # a restart with nothing new adds no version and no row
    n_silver, n_gold = m.silver_log().count(), m.gold_log().count()
    m.run_available_now()
    assert (m.silver_log().count(), m.gold_log().count()) == (n_silver, n_gold)


def test_history_is_read_once_for_all_its_slices(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [_reading(dt.datetime(2024, 1, d, 12), asset=a) for d in range(1, 10) for a in (1, 2)] + [_reading(None)]
    r = spark.createDataFrame(rows, READING_SCHEMA)
    m = Medallion(spark, scratch_path(spark, "t_slices"))
    stream_in_slices(m, r.mapInArrow(count, READING_SCHEMA), ["2024-01-03 00:00:00", "2024-01-05 00:00:00", "2024-01-05 06:00:00", "2024-01-08 00:00:00"])
    assert read.value == len(rows)  # one slice holds no row
    assert _round(m.silver_current()) == _round(aggregate.windowed_avg(r.where("event_time IS NOT NULL")))
    assert len(m.silver._numbers("log")) >= 4 and m.dropped_late_rows() == 0


def test_headers_are_found_among_lines_that_hold_the_key(spark):
    path = scratch_path(spark, "t_heads")
    spark.createDataFrame([("event_time,asset_id\n2024-01-01T00:00:00.000000Z,1\n",)], "value string").coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([("1,2\n\n3,4",)], "value string").coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([(" \n",)], "value string").coalesce(1).write.mode("append").text(path)
    paths = sorted(r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path").collect())
    groups, without = landing.by_header(spark, paths)
    assert [(h, len(p)) for h, p in groups.items()] == [(("event_time", "asset_id"), 1)] and len(without) == 1


def _reading(t, asset=1, v=1.0):
    return (t, asset) + tuple(v for _ in config.CHANNELS)


def test_late_rows_are_dropped_and_counted(spark):
    m = Medallion(spark, scratch_path(spark, "t_late"))
    m.start()
    try:
        day2 = dt.datetime(2024, 1, 2, 12, 0)
        files.write_landing(spark.createDataFrame([_reading(day2)], READING_SCHEMA), m.landing)
        m.drain()
        late = dt.datetime(2024, 1, 1, 0, 10)  # older than max event time - 6 hours
        ok = dt.datetime(2024, 1, 2, 9, 0)      # inside the watermark
        files.write_landing(spark.createDataFrame([_reading(late), _reading(ok)], READING_SCHEMA), m.landing)
        m.drain()
    finally:
        m.stop()
    assert m.dropped_late_rows() == 1
    starts = {r.window_start for r in m.silver_current().collect()}
    assert starts == {dt.datetime(2024, 1, 2, 12, 0), dt.datetime(2024, 1, 2, 9, 0)}


def _land(spark, path, text):
    """One CSV file as given."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)


def test_files_of_any_width_and_order_in_one_landing_folder(spark):
    """Narrow, wide and reordered files, all unread: every one is read by its own header, absent columns are NULL."""
    root = scratch_path(spark, "t_width")
    names = [f.name for f in READING_SCHEMA.fields]
    one = lambda h, **more: {**{c: "1.5" for c in config.CHANNELS}, "event_time": f"2024-01-06T0{h}:00:00.000000Z", "asset_id": str(h), **more}
    files_ = [(names, one(1)), (names[:4], one(2)), (names[::-1], one(3)), ([*names, "sensor10"], one(4, sensor10="7")),
              (["sensor10", "note", *names[:3]], one(5, sensor10="8", note="ok"))]
    for cols, row in files_:
        _land(spark, f"{root}/landing", ",".join(cols) + "\n" + ",".join(row[c] for c in cols))
    _land(spark, f"{root}/landing", "")
    m = Medallion.evolving(spark, root)
    m.run_available_now(gold=False)
    got = {r.asset_id: r for r in m.bronze_table().collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert [got[i].sensor10 for i in range(1, 6)] == [None, None, None, 7, 8] and got[5].note == "ok"
    assert (got[2].sensor2, got[2].sensor3, got[3].sensor9, got[5].sensor1, got[5].sensor2) == (1.5, None, 1.5, 1.5, None)
    assert m.silver_current().count() == 5


def test_types_grow_with_later_files_and_no_file_is_read_twice(spark, monkeypatch):
    """Whole numbers in the first files, decimals later, then text; a restart looks at new files only."""
    root = scratch_path(spark, "t_types")
    seen = []
    plain = landing.by_header
    monkeypatch.setattr(landing, "by_header", lambda s, paths, key: seen.extend(paths) or plain(s, paths, key))
    row = lambda i, x: f"event_time,asset_id,sensor1,extra,blank\n2024-01-06T01:00:00.000000Z,{i},1.0,{x},"
    for i in range(105):
        _land(spark, f"{root}/landing", row(i, i))
    Medallion.evolving(spark, root).run_available_now(gold=False)
    kind = lambda m: dict(m.bronze_table().dtypes)
    m = Medallion.evolving(spark, root)
    assert kind(m)["extra"] == "int" and kind(m)["blank"] == "string" and len(seen) == 105
    for i, x, want in ((200, 2.5, "double"), (201, 3_000_000_000, "double"), (202, "high", "string")):
        before = len(seen)
        _land(spark, f"{root}/landing", row(i, x))
        m = Medallion.evolving(spark, root)  # a restart
        m.run_available_now(gold=False)
        assert kind(m)["extra"] == want and len(seen) == before + 1
    got = {r.asset_id: r.extra for r in m.bronze_table().collect()}
    assert len(got) == 108 and float(got[3]) == 3 and float(got[200]) == 2.5 and got[202] == "high"
    assert sorted(m.remembered.versions()) == [0, 1, 2]


def test_types_join_in_a_lattice():
    from pyspark.sql import types as T

    i, l, d, s, t, v = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType(), T.NullType()
    for a, b, want in ((i, l, l), (l, d, d), (i, d, d), (d, i, d), (i, s, s), (t, d, s), (t, t, t), (v, t, t), (i, v, i), (v, v, v)):
        assert landing.wider(a, b) == want == landing.wider(b, a)
    old = T.StructType([T.StructField("a", i), T.StructField("b", s)])
    assert landing.grown(old, T.StructType([T.StructField("c", t), T.StructField("A", d)])).simpleString() == "struct<a:double,b:string,c:timestamp>"


def test_consumed_files_leave_the_landing_folder(spark):
    root = scratch_path(spark, "t_archive")
    from assetflow.sources.storage import Storage

    names = lambda p: [n for n in Storage(spark).names(p) if n.endswith((".csv", ".txt"))]
    for h in range(1, 4):
        files.write_landing(spark.createDataFrame([_reading(dt.datetime(2024, 1, 6, h))], READING_SCHEMA).coalesce(1), f"{root}/landing")
        m = Medallion(spark, root, archive=f"{root}_archive")
        m.run_available_now(gold=False)
    assert m.bronze_table().count() == 3 and m.silver_current().count() == 3
    left = names(f"{root}/landing")
    archived = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}_archive").select("path").count()
    assert len(left) == 1 and archived == 2  # the last batch's file goes with the next one's commit


def test_bronze_is_compacted_between_two_triggers(spark):
    """Silver goes on over a compaction and a clean-up; no row is lost or comes twice; old versions stay readable."""
    root = scratch_path(spark, "t_compact")
    m = Medallion(spark, root, max_files=1)
    rows = []
    for h in range(6):
        rows.append(_reading(dt.datetime(2024, 1, 6, h), asset=h % 2, v=float(h)))
        files.write_landing(spark.createDataFrame([rows[-1]], READING_SCHEMA).coalesce(1), m.landing)
    m.run_available_now(gold=False)
    key = lambda df: sorted((r.event_time, r.asset_id, r.sensor1) for r in df.collect())
    want = [(r[0], r[1], r[2]) for r in rows]
    assert key(m.bronze_table()) == sorted(want) and m.table.files().count() == 6
    assert m.compact_bronze(dt.date(2024, 1, 7)) == 6
    assert key(m.bronze_table()) == sorted(want) and m.table.files().count() == 1
    assert key(m.table.read(m.schemas(), version=-1)) == sorted(want)
    late = _reading(dt.datetime(2024, 1, 6, 5, 30), asset=1, v=9.0)  # for a date that is compacted already
    files.write_landing(spark.createDataFrame([late], READING_SCHEMA).coalesce(1), m.landing)
    m.run_available_now(gold=False)
    want.append((late[0], late[1], late[2]))
    assert key(m.bronze_table()) == sorted(want) and m.table.files().count() == 2
    assert m.clean_bronze(keep=1) == 0 and m.compact_bronze(dt.date(2024, 1, 7)) == 7
    assert m.clean_bronze(keep=1) == 6 and key(m.bronze_table()) == sorted(want) and m.table.files().count() == 1
    again = Medallion(spark, root)
    again.run_available_now(gold=False)
    assert key(again.bronze_table()) == sorted(want)
    got = {(r.asset_id, r.window_start.hour): r.sensor1 for r in again.silver_current().collect()}
    assert got == {(h % 2, h): float(h) for h in range(5)} | {(1, 5): 7.0}
    assert m.compact_bronze(dt.date(2024, 1, 6)) == 0


def test_idempotent_load_second_run_adds_nothing(spark):
    root = scratch_path(spark, "t_load")
    spark.createDataFrame([("x", "1"), ("y", "2")], "name string, id string").write.json(f"{root}/src")
    args = (f"{root}/src", "name string, id string", ["name", "cast(id as int) as id"], f"{root}/t", f"{root}/c")
    assert files.idempotent_load(spark, *args) == 2
    assert files.idempotent_load(spark, *args) == 0
    assert spark.read.parquet(f"{root}/t").count() == 2


def test_midnight_window_in_half_hour_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        # 23:45 and 00:15 local fall in one epoch-aligned hour window (23:30-00:30 local)
        df = spark.sql("""SELECT * FROM VALUES
            (TIMESTAMP '2024-01-01 23:45:00', 1, 1.0), (TIMESTAMP '2024-01-02 00:15:00', 1, 3.0)
            AS t(event_time, asset_id, sensor1)""")
        out = aggregate.windowed_avg(df, "1 hour", ["sensor1"]).collect()
        assert len(out) == 1
        assert out[0].sensor1 == 2.0 and out[0].reading_date == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rate_limit_one_file_per_trigger(spark):
    m = Medallion(spark, scratch_path(spark, "t_rate"), max_files=1)
    base = dt.datetime(2024, 1, 3, 0, 0)
    for h in range(3):  # three files, in time order
        files.write_landing(spark.createDataFrame([_reading(base + dt.timedelta(hours=h))], READING_SCHEMA)
                            .coalesce(1), m.landing)
    m.run_available_now(gold=False)
    batches = [p for p in m.queries["bronze"].recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3 and all(p["numInputRows"] == 1 for p in batches)
    assert m.silver_current().count() == 3


def test_corrupt_cells_are_kept_aside(spark):
    root = scratch_path(spark, "t_corrupt")
    land = f"{root}/landing"
    spark.createDataFrame([("2024-01-01T01:00:00.000000Z", "1", "1.5"), ("2024-01-01T02:00:00.000000Z", "2", "oops")],
                          "event_time string, asset_id string, sensor1 string")\
        .coalesce(1).write.option("header", True).csv(land)
    from pyspark.sql import types as T
    schema = T.StructType(READING_SCHEMA.fields[:3])
    s = files.csv_stream(spark, land, schema, corrupt_column="_corrupt")
    q = s.writeStream.format("parquet").option("path", f"{root}/out")\
        .option("checkpointLocation", f"{root}/_c").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.asset_id: (r.sensor1, r._corrupt) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got[1] == (1.5, None)
    assert got[2][0] is None and "oops" in got[2][1]


class _CrashOnce(Medallion):
    """Once armed, fails after writing a version, before the micro-batch is committed."""
    armed = False
    crashed = False

    def _upsert_silver(self, batch, batch_id):
        super()._upsert_silver(batch, batch_id)
        if _CrashOnce.armed and not _CrashOnce.crashed:
            _CrashOnce.crashed = True
            raise RuntimeError("simulated failure after the write")


def test_replay_after_failure_keeps_the_log_exact(spark):
    r = fixtures.readings(spark, SF_SMALL)
    root = scratch_path(spark, "t_crash")
    m = _CrashOnce(spark, root)
    cols = [f.name for f in READING_SCHEMA.fields]
    first = r.where(F.col("event_time") < F.lit("2024-01-15 12:30:00").cast("timestamp")).select(*cols)
    rest = r.where(F.col("event_time") >= F.lit("2024-01-15 12:30:00").cast("timestamp")).select(*cols)
    files.write_landing(first, m.landing)
    m.run_available_now(gold=False)
    files.write_landing(rest, m.landing)
    _CrashOnce.armed = True
    try:
        m.run_available_now(gold=False)
    except Exception:
        pass
    assert _CrashOnce.crashed
    # restart from the checkpoints: the failed batch is replayed and replaces its own version
    m2 = Medallion(spark, root)
    m2.run_available_now(gold=False)
    log = m2.silver_log()
    assert log.groupBy("asset_id", "window_start", "_commit_version").count().where("count > 1").count() == 0
    assert _round(m2.silver_current()) == _round(aggregate.windowed_avg(r))


def test_chain_keeps_bad_lines_in_bronze(spark):
    m = Medallion(spark, scratch_path(spark, "t_bad"), corrupt_column="_corrupt")
    m.ensure_dirs()
    good = spark.createDataFrame([_reading(dt.datetime(2024, 1, 4, 1, 0))], READING_SCHEMA)
    files.write_landing(good, m.landing)
    spark.createDataFrame([("2024-01-04T02:00:00.000000Z", "1") + ("x",) * len(config.CHANNELS)],
                          ", ".join(f"{f.name} string" for f in READING_SCHEMA.fields))\
        .coalesce(1).write.mode("append").option("header", True).csv(m.landing)
    m.run_available_now(gold=False)
    bronze = m.bronze_table()
    assert bronze.count() == 2
    assert bronze.where(F.col("_corrupt").isNotNull()).count() == 1
    assert m.silver_current().count() == 2  # the bad line's typed cells are NULL; its window still counts


def test_stream_start_keeps_the_session_setting(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    m = Medallion(spark, scratch_path(spark, "t_parts"), state_partitions=3)
    files.write_landing(spark.createDataFrame([_reading(dt.datetime(2024, 1, 8, 1, 0))], READING_SCHEMA), m.landing)
    m.run_available_now(gold=False)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert m.silver_current().count() == 1


def test_old_files_are_loaded_too(spark):
    import os
    import time

    root = scratch_path(spark, "t_old")
    args = (f"{root}/src", "name string, id string", ["name", "cast(id as int) as id"], f"{root}/t", f"{root}/c")
    spark.createDataFrame([("x", "1")], "name string, id string").coalesce(1).write.mode("append").json(f"{root}/src")
    assert files.idempotent_load(spark, *args) == 1
    known = set(os.listdir(f"{root}/src"))
    spark.createDataFrame([("y", "2")], "name string, id string").coalesce(1).write.mode("append").json(f"{root}/src")
    for f in set(os.listdir(f"{root}/src")) - known:
        if f.endswith(".json") and not f.startswith("."):
            os.utime(f"{root}/src/{f}", (time.time() - 60 * 86400,) * 2)
    assert files.idempotent_load(spark, *args) == 1
    assert spark.read.parquet(f"{root}/t").count() == 2


def test_a_declared_schema_takes_no_other_columns(spark):
    import pytest
    from pyspark.errors import StreamingQueryException

    m = Medallion(spark, scratch_path(spark, "t_declared"))
    m.ensure_dirs()
    good = spark.createDataFrame([_reading(dt.datetime(2024, 1, 4, 1, 0))], READING_SCHEMA)
    files.write_landing(good.select(*reversed(good.columns)), m.landing)
    m.run_available_now(gold=False)
    assert m.bronze_table().count() == 1 and m.bronze_table().first().sensor1 == 1.0
    files.write_landing(good.withColumn("unknown", F.lit(1)), m.landing)
    with pytest.raises(StreamingQueryException):
        m.run_available_now(gold=False)
    assert m.bronze_table().count() == 1


class _Renewed(Medallion):
    def ckpt(self, name):
        return f"{super().ckpt(name)}_renewed" if name == "silver" else super().ckpt(name)


def test_a_fresh_checkpoint_writes_above_older_versions(spark):
    root = scratch_path(spark, "t_renew")
    m = Medallion(spark, root)
    base = dt.datetime(2024, 1, 9, 0, 0)
    files.write_landing(spark.createDataFrame([_reading(base, v=1.0)], READING_SCHEMA), m.landing)
    m.run_available_now(gold=False)
    files.write_landing(spark.createDataFrame([_reading(base + dt.timedelta(minutes=5), v=3.0)], READING_SCHEMA), m.landing)
    m.run_available_now(gold=False)
    before = {tuple(r) for r in m.silver_log().select("_commit_version", "sensor1").collect()}
    newest = max(v for v, _ in before)
    files.write_landing(spark.createDataFrame([_reading(base + dt.timedelta(minutes=9), v=98.0)], READING_SCHEMA), m.landing)
    m2 = _Renewed(spark, root, state_partitions=2)
    m2.run_available_now(gold=False)
    after = {tuple(r) for r in m2.silver_log().select("_commit_version", "sensor1").collect()}
    assert before < after and all(v > newest for v, _ in after - before)
    assert [r.sensor1 for r in m2.silver_current().collect()] == [34.0]
    # a restart goes on from where the checkpoint began
    m3 = _Renewed(spark, root)
    assert m3.first_version("silver", m3.silver.newest_version) == newest + 1
