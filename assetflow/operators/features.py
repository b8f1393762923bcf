"""Feature engineering: age / remaining life, look-ahead labels.

Raw readings are reduced by partial aggregates before they get here. The plain
row-based lead runs over one asset's hourly series; the blocked one, the time
label and the age run over blocks and periods, so a task does not grow with a
series.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def event_days(events: DataFrame, date_col: str = "reading_date", key: str = "asset_id") -> DataFrame:
    """Per asset and day from its first event to its last: ``_last``, the newest event day up to it, and ``_next``, the next from it on.

    The window holds one asset's event days only; the days between two of them come from a sequence.
    """
    days = events.select(F.col(key).alias("_key"), F.col(date_col).alias("_last")).where(F.col("_last").isNotNull()).distinct()
    after = F.lead("_last").over(Window.partitionBy("_key").orderBy("_last"))
    span = days.withColumn("_after", after)
    day = F.explode(F.when(F.col("_after").isNull(), F.array("_last")).otherwise(F.sequence("_last", F.date_sub("_after", 1))))
    return span.select("_key", day.alias("_day"), "_last", "_after").select(
        "_key", "_day", "_last", F.when(F.col("_day") == F.col("_last"), F.col("_last")).otherwise(F.col("_after")).alias("_next"))


def with_age(rows: DataFrame, events: DataFrame, only_true: bool = False,
             censored_as_null: bool = False, date_col: str = "reading_date",
             key: str = "asset_id") -> DataFrame:
    """Add days since the last and until the next event to every row.

    A two-way as-of join as two equi-joins, whatever the rows' grain: with the
    days between an asset's events, and, for days before its first event or
    after its last, with those two. No window runs over the rows and they are
    read once. The same day counts both ways. No earlier event gives age 0, no
    later event remaining life 0, unless ``censored_as_null``.
    """
    if only_true:
        events = events.where(F.col("maintenance"))
    ends = events.groupBy(F.col(key).alias("_asset")).agg(F.min(date_col).alias("_first"), F.max(date_col).alias("_final"))
    day = F.col(date_col)
    joined = (rows.join(event_days(events, date_col, key), rows[date_col].eqNullSafe(F.col("_day")) & rows[key].eqNullSafe(F.col("_key")), "left")
              .join(ends, rows[key].eqNullSafe(F.col("_asset")), "left"))
    last = F.coalesce("_last", F.when(F.col("_final") <= day, F.col("_final")))
    following = F.coalesce("_next", F.when(F.col("_first") >= day, F.col("_first")))
    age, life = F.datediff(day, last), F.datediff(following, day)
    if not censored_as_null:
        age, life = F.coalesce(age, F.lit(0)), F.coalesce(life, F.lit(0))
    return joined.select(*[rows[c] for c in rows.columns], age.alias("age"), life.alias("remaining_life"))


def asset_age(dates: DataFrame, events: DataFrame, only_true: bool = False,
              censored_as_null: bool = False) -> DataFrame:
    """Age and remaining life in days for distinct (date, asset) pairs."""
    return with_age(dates.select("reading_date", "asset_id"), events, only_true, censored_as_null)\
        .select("reading_date", "asset_id", "age", "remaining_life")


def lead_rows(value: str, n: int, order: str, partition: str = "asset_id",
              default_own: bool = True):
    """Value ``n`` rows ahead within the partition; past the end, the row's own value.

    A NULL inside the series stays NULL: the default applies only past the end.
    """
    expr = f"lead({value}, {n}, {value})" if default_own else f"lead({value}, {n})"
    return F.expr(expr).over(Window.partitionBy(partition).orderBy(order))


def feature_base(gold: DataFrame, maintenance: DataFrame, as_of: _dt.date = config.AS_OF) -> DataFrame:
    """Gold readings before ``as_of`` with age and remaining life.

    The date filter sits below the look-ahead window, so rows of ``as_of`` and
    later never serve as labels.
    """
    return with_age(gold.where(F.col("reading_date") < F.lit(as_of)), maintenance)


def feature_table(gold: DataFrame, maintenance: DataFrame, as_of: _dt.date = config.AS_OF,
                  horizon_rows: int = config.HORIZON_ROWS, label: str = "output_6_hours_ahead",
                  lead: int = config.LEAD_ROWS, lead_label: str = "output_72_rows_ahead") -> DataFrame:
    """Feature rows with two look-ahead columns in one window pass: the horizon's label, NULL where the
    series ends before it (so nothing is trained on a row's own output), and the plain lead by
    ``lead`` rows, which falls back on the row's own output."""
    base = feature_base(gold, maintenance, as_of)
    return base.withColumns({label: lead_rows("oil_output", horizon_rows, "window_start", default_own=False),
                             lead_label: lead_rows("oil_output", lead, "window_start")})


def numbered(rows: DataFrame, order: str = "window_start", partition: str = "asset_id", period: str = "month") -> DataFrame:
    """``rows`` with ``_place``, their number (from 1) in their asset's series, without a task that holds a series.

    Rows are counted per asset and period, the counts summed over an asset's periods, and rows numbered within
    a period. ``rows`` are read twice, so they should be stored.
    """
    at = rows.withColumn("_period", F.date_trunc(period, F.col(order)))
    before = Window.partitionBy(partition).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    counts = at.groupBy(partition, "_period").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(F.col(partition).alias("_p"), F.col("_period").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(partition, "_period").orderBy(order))
    return (at.withColumn("_inside", inside).join(offsets, F.col(partition).eqNullSafe(F.col("_p")) & F.col("_period").eqNullSafe(F.col("_q")))
            .withColumn("_place", F.col("_before") + F.col("_inside")).drop("_p", "_q", "_before", "_inside", "_period"))


def leads_by_block(rows: DataFrame, labels: dict[str, tuple[str, int, bool]], order: str = "window_start", partition: str = "asset_id",
                   period: str = "month", block: int = 4096) -> DataFrame:
    """``rows`` with values so many rows ahead: label -> (value, rows, own value past the end), as ``lead_rows`` gives.

    Series are cut into blocks of ``block`` rows by their numbers; the first rows of a block also go to the
    block before it, as many as the longest lead needs. A task's window holds a block, not an asset.
    """
    most = max(n for _, n, _ in labels.values())
    size = max(block, most)
    placed = numbered(rows, order, partition, period)
    number = F.floor((F.col("_place") - 1) / size)
    halo = ((F.col("_place") - 1) % size < most) & (number > 0)
    dealt = placed.withColumn("_own", number).withColumn("_block", F.explode(F.when(halo, F.array(number, number - 1)).otherwise(F.array(number))))
    w = Window.partitionBy(partition, "_block").orderBy("_place")
    ahead = {label: F.expr(f"lead({value}, {n}, {value})" if own else f"lead({value}, {n})").over(w) for label, (value, n, own) in labels.items()}
    return dealt.withColumns(ahead).where(F.col("_block") == F.col("_own")).drop("_block", "_own", "_place")


def feature_table_by_block(stored_base: DataFrame, horizon_rows: int = config.HORIZON_ROWS, label: str = "output_6_hours_ahead",
                           lead: int = config.LEAD_ROWS, lead_label: str = "output_72_rows_ahead") -> DataFrame:
    """``feature_table`` for series of any length, from a stored ``feature_base``."""
    return leads_by_block(stored_base, {label: ("oil_output", horizon_rows, False), lead_label: ("oil_output", lead, True)})


def label_by_time(base: DataFrame, horizon: str = config.HORIZON, value: str = "oil_output",
                  label: str = "output_6h_by_time", default_own: bool = False,
                  order: str = "window_start", partition: str = "asset_id", period: str = "month") -> DataFrame:
    """Value exactly ``horizon`` later on the same asset.

    A RANGE frame offset by an interval on both ends selects the row whose time is exactly ``horizon`` ahead.
    The window runs over an asset's rows of one period and those of the next one that the horizon reaches,
    which are copied to it: one pass, no self-join, and a task holds a period, not a series. The horizon must
    not be longer than a period. Unlike the row-based lead it does not stretch over gaps in the series;
    with no observation at that time the label is NULL (or the own value).
    """
    own = F.date_trunc(period, F.col(order))
    back = F.date_trunc(period, F.col(order) - F.expr(f"INTERVAL {horizon}"))
    dealt = base.withColumn("_own", own).withColumn("_period", F.explode(F.array_distinct(F.array(own, back))))
    ahead = F.expr(f"first({value}) OVER (PARTITION BY {partition}, _period ORDER BY {order} "
                   f"RANGE BETWEEN INTERVAL {horizon} FOLLOWING AND INTERVAL {horizon} FOLLOWING)")
    lab = F.coalesce(ahead, F.col(value)) if default_own else ahead
    return dealt.withColumn(label, lab).where(F.col("_period").eqNullSafe(F.col("_own"))).drop("_period", "_own")


def life_curve(features: DataFrame, asset_id: int | None = None) -> DataFrame:
    """Mean age and remaining life per (asset, day); one asset's curve with ``asset_id``.

    A filter on the asset key sits on the window's partition column, so
    Catalyst pushes it through the look-ahead window down to the scan.
    """
    f = features if asset_id is None else features.where(F.col("asset_id") == F.lit(asset_id))
    return (f.groupBy("asset_id", "reading_date")
            .agg(F.avg("age").alias("age"), F.avg("remaining_life").alias("life"))
            .orderBy("asset_id", "reading_date"))
