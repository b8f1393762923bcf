"""DuckDB SQL twins of the registered analytics.

Each statement runs on the raw parquet views (``events``, ``customer``, ``nation``,
``region``) and restates the computation independently in plain SQL: the readings
mapping, the hourly means, as-of joins for the age, and so on.
"""

from __future__ import annotations

CH = [f"sensor{i}" for i in range(1, 10)]

# CTE name -> (body, dependencies)
_CTES: dict[str, tuple[str, list[str]]] = {
    "reading": ("""
      SELECT CAST(ts AS TIMESTAMP) AS event_time, CAST(ts AS DATE) AS reading_date,
             CAST(user_id AS INTEGER) AS asset_id,
             value AS sensor1, CAST(k AS DOUBLE) AS sensor2, value / 10 AS sensor3,
             value - k AS sensor4, CAST(k AS DOUBLE) / 10 AS sensor5, value * k / 100 AS sensor6,
             sqrt(abs(value)) AS sensor7, -value AS sensor8,
             CASE WHEN event_type = 'error' THEN NULL ELSE value + k END AS sensor9
      FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e""", []),
    "asset": ("""
      SELECT n_name AS country, 'M' || CAST(c_nationkey % 5 AS VARCHAR) AS manufacturer,
             CAST(c_custkey AS INTEGER) AS asset_id, r_name AS region
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""", []),
    "output_t": ("""
      SELECT CAST(date_trunc('hour', CAST(ts AS TIMESTAMP)) AS DATE) AS reading_date,
             date_trunc('hour', CAST(ts AS TIMESTAMP)) AS window_start,
             CAST(user_id AS INTEGER) AS asset_id, sum(value) AS oil_output
      FROM events GROUP BY ALL""", []),
    "maint": ("""
      SELECT CAST(ts AS DATE) AS reading_date, CAST(user_id AS INTEGER) AS asset_id,
             bool_or(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 <> 0) AS maintenance
      FROM events
      WHERE event_type = 'error' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95
      GROUP BY ALL""", []),
    "hourly": ("""
      SELECT asset_id, CAST(date_trunc('hour', event_time) AS DATE) AS reading_date,
             date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
             """ + ", ".join(f"avg({c}) AS {c}" for c in CH) + """
      FROM reading GROUP BY 1, 2, 3, 4""", ["reading"]),
    "enriched": ("""
      SELECT h.*, a.country, a.manufacturer, a.region FROM hourly h JOIN asset a USING (asset_id)""",
                 ["hourly", "asset"]),
    "gold": ("""
      SELECT enriched.*, output_t.oil_output, coalesce(maint.maintenance, false) AS maintenance
      FROM output_t NATURAL JOIN enriched LEFT JOIN maint USING (asset_id, reading_date)""",
             ["enriched", "output_t", "maint"]),
    "age": ("""
      SELECT day.reading_date, day.asset_id,
             CAST(coalesce(day.reading_date - before.reading_date, 0) AS INTEGER) AS age,
             CAST(coalesce(after.reading_date - day.reading_date, 0) AS INTEGER) AS remaining_life
      FROM (SELECT reading_date, asset_id FROM output_t GROUP BY ALL) day
      ASOF LEFT JOIN maint before ON day.asset_id = before.asset_id AND day.reading_date >= before.reading_date
      ASOF LEFT JOIN maint after ON day.asset_id = after.asset_id AND day.reading_date <= after.reading_date""",
            ["output_t", "maint"]),
    "fbase": ("""
      SELECT gold.*, age.age, age.remaining_life
      FROM gold JOIN age USING (reading_date, asset_id)
      WHERE gold.reading_date < DATE '2024-02-01'""", ["gold", "age"]),
    "feat": ("""
      SELECT now.* EXCLUDE (place), soon.oil_output AS output_6_hours_ahead,
             CASE WHEN later.place IS NULL THEN now.oil_output ELSE later.oil_output END AS output_72_rows_ahead
      FROM placed now
      LEFT JOIN placed soon ON soon.asset_id = now.asset_id AND soon.place = now.place + 6
      LEFT JOIN placed later ON later.asset_id = now.asset_id AND later.place = now.place + 72""", ["placed"]),
    "placed": ("""
      SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY window_start) AS place FROM fbase""", ["fbase"]),
    "by_hour": ("""
      SELECT date_trunc('hour', event_time) AS event_hour, min(sensor1) AS sensor1, min(sensor2) AS sensor2
      FROM reading GROUP BY event_hour""", ["reading"]),
    "per_slice": ("""
      SELECT asset_id, date_trunc('hour', event_time) AS window_start,
             CAST((event_time >= TIMESTAMP '2024-01-05 12:30:00') AS INTEGER)
           + CAST((event_time >= TIMESTAMP '2024-01-10 12:30:00') AS INTEGER)
           + CAST((event_time >= TIMESTAMP '2024-01-15 12:30:00') AS INTEGER)
           + CAST((event_time >= TIMESTAMP '2024-01-20 12:30:00') AS INTEGER)
           + CAST((event_time >= TIMESTAMP '2024-01-25 12:30:00') AS INTEGER) AS v,
             """ + ", ".join(f"sum({c}) AS s_{c}, count({c}) AS n_{c}" for c in CH) + """
      FROM reading GROUP BY 1, 2, 3""", ["reading"]),
    "versions": ("""
      SELECT asset_id, CAST(window_start AS DATE) AS reading_date, window_start,
             window_start + INTERVAL 1 HOUR AS window_end, CAST(v AS BIGINT) AS _commit_version,
             """ + ", ".join(f"sum(s_{c}) OVER w / nullif(sum(n_{c}) OVER w, 0) AS {c}" for c in CH) + """
      FROM per_slice
      WINDOW w AS (PARTITION BY asset_id, window_start ORDER BY v
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["per_slice"]),
    "feed": ("""
      SELECT * FROM (
        SELECT asset_id, window_start,
               lag(reading_date) OVER w AS p_reading_date, lag(window_end) OVER w AS p_window_end,
               """ + ", ".join(f"lag({c}) OVER w AS p_{c}" for c in CH) + """,
               reading_date, window_end, """ + ", ".join(CH) + """, _commit_version,
               row_number() OVER w AS rn
        FROM versions WINDOW w AS (PARTITION BY asset_id, window_start ORDER BY _commit_version))""",
             ["versions"]),
    "change_sets": ("""
      SELECT asset_id, reading_date, window_start, window_end, """ + ", ".join(CH) + """, _commit_version, false AS gone FROM versions
      UNION ALL
      SELECT asset_id, reading_date, window_start, window_end, """ + ", ".join(CH) + """, 6, true FROM hourly WHERE asset_id % 50 = 0
      UNION ALL
      SELECT asset_id, reading_date, window_start, window_end, """ + ", ".join(CH) + """, 7, false FROM hourly WHERE asset_id % 100 = 0""",
                    ["versions", "hourly"]),
    "steps": ("""
      SELECT *, coalesce(lag(gone) OVER w, true) AS absent, """ + ", ".join(f"lag({c}) OVER w AS p_{c}" for c in CH) + """
      FROM change_sets WINDOW w AS (PARTITION BY asset_id, window_start ORDER BY _commit_version)""", ["change_sets"]),
    "train": ("""
      SELECT reading_date, window_start, asset_id, remaining_life, age, """ + ", ".join(CH) + """,
             oil_output, output_6_hours_ahead,
             ((CAST(floor(epoch(window_start) / 3600) AS BIGINT) * 7919 + asset_id) % 10) >= 8 AS is_test
      FROM feat""", ["feat"]),
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order) + "\n"


def _r(cols: list[str]) -> str:
    """``* REPLACE`` list rounding the named double columns to 6 digits."""
    return "* REPLACE (" + ", ".join(f"round(round({c}, 10), 6) AS {c}" for c in cols) + ")"


GOLD_D = CH + ["oil_output"]
FEAT_D = GOLD_D + ["output_6_hours_ahead", "output_72_rows_ahead"]

SQL: dict[str, str] = {
    "bronze_readings": _with("reading") + f"SELECT {_r(CH)} FROM reading",
    "hourly_min": _with("by_hour") + f"SELECT {_r(CH[:2])} FROM by_hour",
    "hourly_min_stream": _with("by_hour") + f"SELECT {_r(CH[:2])} FROM by_hour",
    "count_by_asset": _with("reading") + """
      SELECT asset_id, count(sensor1) AS n_sensor1, count(sensor9) AS n_sensor9
      FROM reading GROUP BY asset_id ORDER BY asset_id""",
    "windowed_avg": _with("hourly") + f"SELECT {_r(CH)} FROM hourly",
    "date_bounds": _with("reading") + """
      SELECT min(reading_date) AS min_date, max(reading_date) AS max_date FROM reading""",
    "reading_dates": _with("output_t") + "SELECT DISTINCT reading_date, asset_id FROM output_t",
    "dedup_keys": _with("reading") + f"""
      SELECT asset_id, window_start, event_time, reading_date, {", ".join(f"round(round({c}, 10), 6) AS {c}" for c in CH)}
      FROM (SELECT *, date_trunc('hour', event_time) AS window_start FROM reading)
      QUALIFY row_number() OVER (PARTITION BY asset_id, window_start
                                 ORDER BY event_time DESC, {", ".join(f"{c} DESC NULLS LAST" for c in CH)}) = 1""",
    "idempotent_load": _with("asset") + "SELECT * FROM asset",
    "windowed_avg_stream": _with("hourly") + f"SELECT {_r(CH)} FROM hourly",
    "upsert_latest": _with("hourly") + f"SELECT {_r(CH)} FROM hourly",
    "latest_change": _with("hourly") + f"SELECT {_r(CH)} FROM hourly",
    "change_feed": _with("feed") + f"""
      SELECT asset_id, window_start, reading_date, window_end, {", ".join(f"round(round({c}, 10), 6) AS {c}" for c in CH)},
             CASE WHEN rn = 1 THEN 'insert' ELSE 'update_postimage' END AS _change_type, _commit_version
      FROM feed
      UNION ALL
      SELECT asset_id, window_start, p_reading_date, p_window_end, {", ".join(f"round(round(p_{c}, 10), 6)" for c in CH)},
             'update_preimage', _commit_version
      FROM feed WHERE rn > 1""",
    "typed_feed_stream": _with("steps") + f"""
      SELECT asset_id, reading_date, window_start, window_end, {", ".join(f"round(round({c}, 10), 6) AS {c}" for c in CH)},
             CASE WHEN absent THEN 'insert' ELSE 'update_postimage' END AS _change_type, CAST(_commit_version AS BIGINT) AS _commit_version
      FROM steps WHERE NOT gone AND _commit_version >= 1
      UNION ALL
      SELECT asset_id, reading_date, window_start, window_end, {", ".join(f"round(round(p_{c}, 10), 6)" for c in CH)},
             CASE WHEN gone THEN 'delete' ELSE 'update_preimage' END, CAST(_commit_version AS BIGINT)
      FROM steps WHERE NOT absent AND _commit_version >= 1""",
    "enriched_upsert": _with("enriched") + f"SELECT {_r(CH)} FROM enriched",
    "maintenance_events": _with("maint") + "SELECT * FROM maint",
    "enriched_assets": _with("enriched") + f"SELECT {_r(CH)} FROM enriched",
    "asset_output": _with("output_t") + "SELECT * REPLACE (round(round(oil_output, 10), 6) AS oil_output) FROM output_t",
    "gold_readings": _with("gold") + f"SELECT {_r(GOLD_D)} FROM gold ORDER BY asset_id, window_start",
    "asset_age": _with("age") + "SELECT * FROM age",
    "feature_table": _with("feat") + f"SELECT {_r(FEAT_D)} FROM feat",
    "feature_table_by_name": _with("feat") + f"SELECT {_r(FEAT_D)} FROM feat",
    "feature_table_by_block": _with("feat") + f"SELECT {_r(FEAT_D)} FROM feat",
    "label_by_time": _with("fbase") + f"""
      SELECT {_r(GOLD_D + ["output_6h_by_time"])} FROM (
        SELECT b.*, n.oil_output AS output_6h_by_time
        FROM fbase b LEFT JOIN fbase n
          ON (n.asset_id = b.asset_id AND n.window_start = b.window_start + INTERVAL 6 HOUR))""",
    "life_curve": _with("feat") + """
      SELECT asset_id, reading_date, round(round(avg(age), 10), 6) AS age, round(round(avg(remaining_life), 10), 6) AS life
      FROM feat GROUP BY asset_id, reading_date ORDER BY asset_id, reading_date""",
    "split_counts": _with("train") + """
      SELECT asset_id, is_test, count(*) AS n_rows FROM train GROUP BY asset_id, is_test""",
    "linear_model": _with("train") + """
      SELECT asset_id, CAST(regr_count(output_6_hours_ahead, oil_output) AS BIGINT) AS n_train,
             round(round(regr_slope(output_6_hours_ahead, oil_output), 10), 6) AS slope,
             round(round(regr_intercept(output_6_hours_ahead, oil_output), 10), 6) AS intercept
      FROM train WHERE NOT is_test AND oil_output IS NOT NULL AND output_6_hours_ahead IS NOT NULL
      GROUP BY asset_id""",
    "sweep_grid": _with("train") + f"""
      SELECT {_r(["sensor1"] + [c for c in CH if c != "sensor1"] + ["oil_output", "output_6_hours_ahead"])} FROM (
        SELECT l.* EXCLUDE (sensor1), CAST(g.setting AS INTEGER) AS setting,
               round(CAST(-0.015 AS DOUBLE) + g.setting * CAST(0.001 AS DOUBLE), 3) AS sensor1
        FROM (SELECT * FROM train QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY window_start DESC) = 1) l,
             range(0, 8) g(setting))""",
    "compacted_rows": _with("gold") + f"SELECT {_r(GOLD_D)} FROM gold",
}
