import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetflow.operators import features


def D(s):
    return dt.date.fromisoformat(s)


def test_age_and_life_hand_case(spark):
    # events 01-05 and 01-09; dates 01-03, 01-05, 01-06, 01-10 -> (0,2) (0,0) (1,3) (1,0)
    dates = spark.createDataFrame([(D(d), 1) for d in ["2024-01-03", "2024-01-05", "2024-01-06", "2024-01-10"]],
                                  "reading_date date, asset_id int")
    ev = spark.createDataFrame([(D("2024-01-05"), True, 1), (D("2024-01-09"), False, 1)],
                               "reading_date date, maintenance boolean, asset_id int")
    got = {(r.reading_date.isoformat(), r.age, r.remaining_life)
           for r in features.asset_age(dates, ev).collect()}
    assert got == {("2024-01-03", 0, 2), ("2024-01-05", 0, 0), ("2024-01-06", 1, 3), ("2024-01-10", 1, 0)}


def test_age_censored_as_null(spark):
    dates = spark.createDataFrame([(D("2024-01-03"), 1)], "reading_date date, asset_id int")
    ev = spark.createDataFrame([(D("2024-01-05"), True, 1)], "reading_date date, maintenance boolean, asset_id int")
    r = features.asset_age(dates, ev, censored_as_null=True).first()
    assert r.age is None and r.remaining_life == 2


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=12, unique=True),
       st.lists(st.integers(0, 40), min_size=0, max_size=6))
def test_two_way_as_of_equals_range_join(spark, days, events):
    base = dt.date(2024, 1, 1)
    dates = spark.createDataFrame([(base + dt.timedelta(d), 1) for d in days], "reading_date date, asset_id int")
    ev = spark.createDataFrame([(base + dt.timedelta(d), True, 1) for d in events],
                               "reading_date date, maintenance boolean, asset_id int")
    got = sorted((r.reading_date, r.age, r.remaining_life) for r in features.asset_age(dates, ev).collect())
    want = []
    for d in days:
        last = [d - e for e in events if e <= d]
        nxt = [e - d for e in events if e >= d]
        want.append((base + dt.timedelta(d), min(last) if last else 0, min(nxt) if nxt else 0))
    assert got == sorted(want)


def test_lead_default_is_own_value_only_past_the_end(spark):
    # values 10, NULL, 30, 40; lead 1 -> NULL, 30, 40, 40
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([10.0, None, 30.0, 40.0])],
                               "asset_id int, t int, x double")
    got = [r.y for r in df.withColumn("y", features.lead_rows("x", 1, "t")).orderBy("t").collect()]
    assert got == [None, 30.0, 40.0, 40.0]


def test_lead_rows_equals_lead_time_on_gap_free_series(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start + dt.timedelta(hours=h), float(h * h % 17)) for h in range(30)]
    df = spark.createDataFrame(rows, "asset_id int, window_start timestamp, oil_output double")
    by_rows = df.withColumn("a", features.lead_rows("oil_output", 6, "window_start", default_own=False))
    by_time = features.label_by_time(df, "6 hours", label="b")
    j = by_rows.join(by_time, ["asset_id", "window_start"])
    assert j.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert j.where(F.col("a").isNotNull()).count() == 24


def test_join_small_broadcasts_only_within_bounds(spark):
    from assetflow.functions.joins import join_small, size_of
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.createDataFrame([(i, "x" * i) for i in range(10)], "k long, s string")
    n, b = size_of(small)
    assert n == 10 and b == 10 * 8 + sum(range(10))

    def plan(df):
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()
    assert "Broadcast" in plan(join_small(big, small, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(join_small(big, small, "k", max_bytes=50))
        assert "Broadcast" not in plan(join_small(big, small, "k", max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_same_day_double_maintenance_repeats_the_reading(spark):
    from assetflow.operators import enrich
    t = dt.datetime(2024, 1, 5, 10, 0)
    hourly = spark.createDataFrame([(1, dt.date(2024, 1, 5), t, 1.0)],
                                   "asset_id int, reading_date date, window_start timestamp, sensor1 double")
    out = spark.createDataFrame([(dt.date(2024, 1, 5), t, 1, 9.0)],
                                "reading_date date, window_start timestamp, asset_id int, oil_output double")
    raw = spark.createDataFrame([(dt.date(2024, 1, 5), True, 1), (dt.date(2024, 1, 5), False, 1)],
                                "reading_date date, maintenance boolean, asset_id int")
    g = enrich.gold_readings(hourly, out, raw).collect()
    assert sorted(r.maintenance for r in g) == [False, True]  # a plain LEFT JOIN keeps both
    # the fixture aggregates maintenance to one row per day first
    one = raw.groupBy("reading_date", "asset_id").agg(F.bool_or("maintenance").alias("maintenance"))
    assert [r.maintenance for r in enrich.gold_readings(hourly, out, one).collect()] == [True]


def test_blocked_leads_equal_plain_ones_on_a_hot_series(spark):
    """One asset with most rows, at one-minute windows, gaps and NULLs: the same labels, and no task near a whole series."""
    from pyspark.sql import functions as F

    rows = spark.range(6000).selectExpr("cast(case when id % 10 < 4 then 1 else 2 + id % 7 end as int) asset_id",
                                        "timestamp_seconds(1704067200 + id * 60 + case when id > 3000 then 9000000 else 0 end) window_start",
                                        "case when id % 11 = 0 then null else cast(id as double) end oil_output")
    for n in (1, 72):
        plain = rows.withColumns({"x": features.lead_rows("oil_output", n, "window_start"), "y": features.lead_rows("oil_output", n, "window_start", default_own=False)})
        mine = features.leads_by_block(rows, {"x": ("oil_output", n, True), "y": ("oil_output", n, False)}, block=100)
        key = lambda df: sorted(map(tuple, df.select("asset_id", "window_start", "oil_output", "x", "y").collect()), key=str)
        assert key(plain) == key(mine)
    past = features.leads_by_block(rows, {"x": ("oil_output", 10_000, True)}, block=100)
    assert past.where("NOT x <=> oil_output").count() == 0
    placed = features.numbered(rows)
    want = rows.groupBy("asset_id").count().collect()
    assert {(r.asset_id, r["count"]) for r in want} == {(r.asset_id, r.n) for r in placed.groupBy("asset_id").agg(F.max("_place").alias("n")).collect()}
    assert placed.select("asset_id", "_place").distinct().count() == 6000


def test_time_label_over_period_ends(spark):
    """The label reaches into the next period; only rows exactly the horizon later count."""
    import datetime as dt

    t = dt.datetime(2024, 1, 31, 20)
    rows = [(1, t + dt.timedelta(hours=h), float(h)) for h in range(12) if h != 9] + [(2, dt.datetime(2024, 2, 1, 2), 5.0)]
    df = spark.createDataFrame(rows, "asset_id int, window_start timestamp, oil_output double")
    got = {(r.asset_id, r.oil_output): r.output_6h_by_time for r in features.label_by_time(df).collect()}
    assert got == {(1, float(h)): (float(h + 6) if h + 6 < 12 and h + 6 != 9 else None) for h in range(12) if h != 9} | {(2, 5.0): None}
