"""Operating-point sweep: score every asset at a grid of settings, then profit.

The grid is generated per asset with ``explode(sequence(..))`` (no join), and
settings are ``round(start + i * step)`` from an integer index, so the grid has
no floating drift. Predictions come from the coefficient rows of promoted
models, joined per asset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators import aggregate
from ..operators.models import score


def latest_payload(features: DataFrame, keys: list[str] = ["asset_id"],
                   order: str = "window_start") -> DataFrame:
    """The newest feature row of every asset (its current operating state)."""
    return aggregate.last_per_key(features, keys, [order])


def sweep_grid(payload: DataFrame, column: str = "sensor1", start: float = config.SWEEP_START,
               step: float = config.SWEEP_STEP, points: int = config.SWEEP_POINTS,
               decimals: int = config.SWEEP_DECIMALS) -> DataFrame:
    """One row per (asset, setting): ``column`` replaced by each grid value."""
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("setting")
    rest = [c for c in payload.columns if c != column]
    g = payload.select(*rest, i)
    return g.withColumn(column, F.round(F.lit(start) + F.col("setting") * F.lit(step), decimals))


def own_ranges(rows: DataFrame, column: str = "sensor1", group: list[str] = ["asset_id"]) -> DataFrame:
    """Per asset the least and greatest value it has run at: ``low``, ``high``."""
    return rows.groupBy(*group).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def own_range_grid(payload: DataFrame, ranges: DataFrame, column: str = "sensor1", points: int = config.SWEEP_POINTS,
                   decimals: int = config.SWEEP_DECIMALS, group: list[str] = ["asset_id"]) -> DataFrame:
    """One row per (asset, setting) with settings evenly spaced over the asset's own range, ends included.

    A fixed grid may lie where an asset never runs, and a model is then asked about what it has not seen.
    """
    step = (F.col("high") - F.col("low")) / F.lit(points - 1)
    rest = [c for c in payload.columns if c != column]
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("setting")
    g = payload.select(*rest).join(ranges, group).select(*rest, "low", step.alias("_step"), i)
    return g.withColumn(column, F.round(F.col("low") + F.col("setting") * F.col("_step"), decimals)).drop("low", "_step")


def sweep_predictions(grid: DataFrame, output_coefs: DataFrame, life_coefs: DataFrame,
                      features: list[str] = config.FEATURES, group: list[str] = ["asset_id"]) -> DataFrame:
    """Expected output from the output model and expected life from the life model."""
    s = score(grid, output_coefs, group, features, "expected_output")
    return score(s, life_coefs, group, features, "expected_life")


def profit(pred: DataFrame, price: float = config.PRICE, hours: int = config.HOURS_PER_YEAR) -> DataFrame:
    """Revenue = output * hours * price; Cost = Revenue / life; Profit = Revenue - Cost.

    A predicted life of 0 or less is no life to spread the cost over: cost and
    profit are NULL, and the row is kept.
    """
    rev = F.col("expected_output") * F.lit(float(hours)) * F.lit(float(price))
    cost = F.when(F.col("expected_life") > 0, rev / F.col("expected_life"))
    return (pred.withColumn("revenue", rev).withColumn("cost", cost)
            .withColumn("profit", F.col("revenue") - F.col("cost")))


def optimal_setting(curve: DataFrame, column: str = "sensor1", group: list[str] = ["asset_id"]) -> DataFrame:
    """Setting with the highest profit per asset (ties: the lower setting)."""
    ok = curve.where(F.col("profit").isNotNull())
    best = F.max_by(F.struct(F.col(column).alias("best_setting"), "expected_output", "expected_life",
                             "revenue", "cost", "profit"),
                    F.struct(F.col("profit"), -F.col(column)))
    return ok.groupBy(*group).agg(best.alias("_b")).select(*group, "_b.*")


def fleet_kpis(optimal: DataFrame, assets: DataFrame) -> DataFrame:
    """Dashboard figures per region: assets, total and mean optimal profit, mean life."""
    a = assets.select("asset_id", "region")
    return (optimal.join(a, "asset_id", "inner").groupBy("region")
            .agg(F.count(F.lit(1)).alias("assets"), F.sum("profit").alias("total_profit"),
                 F.avg("profit").alias("mean_profit"), F.avg("expected_life").alias("mean_life"))
            .orderBy("region"))
