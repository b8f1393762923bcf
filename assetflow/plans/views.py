"""The view stack over one data directory: each view a lazy DataFrame.

This mirrors the chain readings -> hourly -> enriched -> gold -> age -> features.
Only the maintenance history is stored when it is first used (three views read it);
for the rest Catalyst inlines the whole stack into each query.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import aggregate, enrich, features
from ..session import ensure_utc, scratch_path
from ..sources import fixtures


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = config.AS_OF):
        ensure_utc(spark)
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def materialized(self, name: str, build) -> DataFrame:
        """``build()`` computed once, written as Parquet to the shared checkpoint folder and read back.

        Used for artifacts read by several later jobs (training rows, model
        coefficients): the lineage is cut, so consumers read the columns they
        need from files, and a lost executor does not trigger a rebuild.
        """
        memo = self.__dict__.setdefault("_materialized", {})
        if name not in memo:
            path, df = scratch_path(self.spark, name), build()
            df.write.parquet(path)
            memo[name] = self.spark.read.schema(df.schema).parquet(path)
        return memo[name]

    @cached_property
    def readings(self) -> DataFrame:
        return fixtures.readings(self.spark, self.sf_dir)

    @cached_property
    def assets(self) -> DataFrame:
        return fixtures.assets(self.spark, self.sf_dir)

    @cached_property
    def output(self) -> DataFrame:
        return fixtures.output(self.spark, self.sf_dir)

    @cached_property
    def maintenance(self) -> DataFrame:
        """The maintenance history, stored once: the events it is found in are not scanned again by each of its uses."""
        return self.materialized("maintenance", lambda: fixtures.maintenance(self.spark, self.sf_dir))

    @cached_property
    def hourly(self) -> DataFrame:
        return aggregate.windowed_avg(self.readings)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_assets(self.hourly, self.assets)

    @cached_property
    def gold(self) -> DataFrame:
        return enrich.gold_readings(self.enriched, self.output, self.maintenance)

    @cached_property
    def age(self) -> DataFrame:
        return features.asset_age(aggregate.reading_dates(self.output), self.maintenance)

    @cached_property
    def features(self) -> DataFrame:
        """Feature rows: gold readings before ``as_of`` with age and the label.

        The readings and output are bounded by ``as_of`` at the scan (a pushed
        Parquet filter on the event time); the same bound also applies to the
        gold rows inside ``feature_table``. Maintenance is not bounded: events
        after ``as_of`` still define the remaining life of earlier days.
        """
        r = fixtures.readings(self.spark, self.sf_dir, before=self.as_of)
        o = fixtures.output(self.spark, self.sf_dir, before=self.as_of)
        hourly = aggregate.windowed_avg(r)
        gold = enrich.gold_readings(enrich.enrich_assets(hourly, self.assets), o, self.maintenance)
        return features.feature_table(gold, self.maintenance, self.as_of)
