"""A keyed table by date: a base folded per date, a log of newer versions, and a typed feed of its changes.

    <root>/log/_commit_version=v/<date>=d/     the rows of upsert v, ``_deleted`` true for keys it removes
    <root>/feed/_commit_version=v/<date>=d/    its changes: insert, update_preimage, update_postimage, delete
    <root>/base/_fold=f/<date>=d/              all rows of a date as of version f
    <root>/pointer/_fold=f/                    (date, fold): the base of each date; written last

An upsert reads the table only for the dates between its own least and greatest (bounds of the batch, pruned as
partitions of base and log), which gives the previous image of every key it touches. Every few upserts the dates
touched since the last fold are rewritten, and only those; the pointer names the new folders after they are
complete, so readers see one state or the other and never read versions that are folded already. What a read
costs is the rows of its dates plus at most ``fold_every`` versions, however long the history is.

Versions are written aside and take their place by one move; a replayed version that has its place stays, so a
stream over the feed sees each change once. A key's date must not change.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import Storage
from .changelog import CHANGE, TIMESTAMP, VERSION

DELETED = "_deleted"
FOLD = "_fold"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, fields: list[T.StructField], keys: list[str], date: str = "reading_date",
                 fold_every: int = 4, with_feed: bool = True):
        self.with_feed = with_feed  # a table that nobody follows needs no feed
        self.spark, self.root, self.store = spark, root.rstrip("/"), Storage(spark)
        self.keys, self.date, self.fold_every = keys, date, fold_every
        self.fields = list(fields)
        self.columns = [f.name for f in fields]
        self._values = [c for c in self.columns if c not in keys and c != date]
        # columns of the folders last, in their order: a file stream wants them so
        rows, by_date = [f for f in fields if f.name != date], next(f for f in fields if f.name == date)
        meta = [T.StructField(TIMESTAMP, T.TimestampType()), T.StructField(VERSION, T.LongType()), by_date]
        self.log_schema = T.StructType([*rows, T.StructField(DELETED, T.BooleanType()), *meta])
        self.feed_schema = T.StructType([*rows, T.StructField(CHANGE, T.StringType()), *meta])

    # -- versions and dates -----------------------------------------------------
    def _at(self, part: str, version: int | None = None) -> str:
        return f"{self.root}/{part}" + ("" if version is None else f"/{FOLD if part in ('base', 'pointer') else VERSION}={version}")

    def _numbers(self, part: str) -> list[int]:
        """Versions (or folds) in a folder, by the names of its folders."""
        return sorted(int(n.split("=")[1]) for n in self.store.names(self._at(part)) if "=" in n)

    def newest_version(self) -> int | None:
        """Of the log and the folds: an old version may have been vacuumed."""
        return max([*self._numbers("log"), *self._numbers("pointer")], default=None)

    def folded(self) -> int:
        """The version the base is as of; -1 without one."""
        return max(self._numbers("pointer"), default=-1)

    def _dates(self, version: int) -> list[_dt.date]:
        """Dates that a version touches, by the names of its folders."""
        return sorted(_dt.date.fromisoformat(n.split("=")[1]) for n in self.store.names(self._at("log", version))
                      if n.startswith(f"{self.date}=") and n[len(self.date) + 1:][:1].isdigit())

    def _bases(self) -> dict[_dt.date, int]:
        """The fold that holds each date; one row per date."""
        fold = self.folded()
        if fold < 0:
            return {}
        return {r[self.date]: r["fold"] for r in self.spark.read.schema(f"{self.date} date, fold long").parquet(self._at("pointer", fold)).collect()}

    # -- reading ------------------------------------------------------------------
    def log(self) -> DataFrame:
        if not self.store.exists(self._at("log")):
            return self.spark.createDataFrame([], self.log_schema)
        return self.spark.read.schema(self.log_schema).parquet(self._at("log"))

    def feed(self) -> DataFrame:
        """All typed changes kept so far."""
        if not self.store.exists(self._at("feed")):
            return self.spark.createDataFrame([], self.feed_schema)
        return self.spark.read.schema(self.feed_schema).parquet(self._at("feed"))

    def feed_stream(self, from_version: int = 0) -> DataFrame:
        """The typed changes as a stream, from a version on."""
        self.store.make(self._at("feed"))
        s = self.spark.readStream.schema(self.feed_schema).parquet(self._at("feed"))
        return s.where(F.col(VERSION) >= from_version) if from_version else s

    def base(self, lo: _dt.date | None = None, hi: _dt.date | None = None) -> DataFrame:
        """The folded rows, of the dates from ``lo`` to ``hi``."""
        schema = T.StructType([*self.fields, T.StructField(VERSION, T.LongType())])
        paths = [f"{self._at('base', f)}/{self.date}={d}" for d, f in sorted(self._bases().items()) if (lo is None or lo <= d) and (hi is None or d <= hi)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self._at("base")).parquet(*paths).select(*self.columns, VERSION)

    def current(self, lo: _dt.date | None = None, hi: _dt.date | None = None, below: int | None = None) -> DataFrame:
        """The newest row of each key that was not deleted, of the dates from ``lo`` to ``hi``, as of the versions under ``below``."""
        folded = self.folded()
        if below is not None and folded >= below:
            raise ValueError(f"the table is folded through version {folded}: no state below {below} is kept")
        newer = self.log().where(F.col(VERSION) > folded)
        if below is not None:
            newer = newer.where(F.col(VERSION) < below)
        if lo is not None:
            newer = newer.where(F.col(self.date) >= F.lit(lo))
        if hi is not None:
            newer = newer.where(F.col(self.date) <= F.lit(hi))
        rows = newer.select(*self.columns, DELETED, VERSION).unionByName(self.base(lo, hi).withColumn(DELETED, F.lit(False)))
        row = F.max_by(F.struct(*self._values, DELETED), F.col(VERSION))
        # few rows share a key (a version each, at most fold_every and one): sorted once, where they meet, and not before
        rows = rows.repartition(*self.keys, self.date)
        return (rows.groupBy(*self.keys, self.date).agg(row.alias("_row")).where(~F.col(f"_row.{DELETED}"))
                .select(*[F.col(f"_row.{c}").alias(c) if c in self._values else F.col(c) for c in self.columns]))

    # -- writing ------------------------------------------------------------------
    def _put(self, rows: DataFrame, part: str, version: int) -> bool:
        """Writes a version aside and moves it to its place; false if it has no rows."""
        aside, place = f"{self.root}/_aside/{part}-{version}", self._at(part, version)
        rows.hint("rebalance", F.col(self.date)).write.mode("overwrite").partitionBy(self.date).parquet(aside)
        if not any(n.startswith(f"{self.date}=") for n in self.store.names(aside)):
            self.store.delete(aside)
            return False
        self.store.move(aside, place)
        return True

    def upsert(self, rows: DataFrame, version: int, minimal: bool = False) -> bool:
        """Rows (one per key) as a version: keys that are there are replaced, others added, those ``_deleted`` removed.

        With ``minimal``, rows that change nothing are no changes in the feed. Returns whether ``rows`` were read:
        a version that has its place already is not written again.
        """
        if version <= self.folded():
            return False
        fresh = not self.store.exists(self._at("log", version))
        if fresh:
            given = rows if DELETED in rows.columns else rows.withColumn(DELETED, F.lit(False))
            if not self._put(given.select(*self.columns, DELETED, F.current_timestamp().alias(TIMESTAMP)), "log", version):
                return True
        if self.with_feed and not self.store.exists(self._at("feed", version)):
            self._put(self._changes(version, minimal).drop(VERSION), "feed", version)
        if len([v for v in self._numbers("log") if v > self.folded()]) >= self.fold_every:
            self.fold()
        return fresh

    def _changes(self, version: int, minimal: bool) -> DataFrame:
        """Typed changes of a version against the state before it, which is read for its dates only."""
        dates = self._dates(version)
        lo, hi = (dates[0], dates[-1]) if dates else (None, None)
        image = lambda p: F.struct(*[F.col(f"{p}.{c}").alias(c) for c in self._values])
        mine = (self.spark.read.schema(T.StructType([f for f in self.log_schema.fields if f.name != VERSION])).parquet(self._at("log", version))
                .select(*self.keys, self.date, TIMESTAMP, DELETED, F.struct(*self._values).alias("n")))
        before = self.current(lo, hi, below=version).select(*self.keys, self.date, F.struct(*self._values).alias("o"))
        both = mine.join(before, [*self.keys, self.date], "left")
        change = lambda kind, p: F.struct(F.lit(kind).alias(CHANGE), image(p).alias("v"))
        both = both.where(~F.col(DELETED) | F.col("o").isNotNull())
        if minimal:
            both = both.where(F.col(DELETED) | F.col("o").isNull() | ~F.col("o").eqNullSafe(F.col("n")))
        images = (F.when(F.col(DELETED), F.array(change("delete", "o"))).when(F.col("o").isNull(), F.array(change("insert", "n")))
                  .otherwise(F.array(change("update_preimage", "o"), change("update_postimage", "n"))))
        out = both.select(*self.keys, self.date, TIMESTAMP, F.explode(images).alias("c"))
        return out.select(*[F.col(f"c.v.{c}").alias(c) if c in self._values else F.col(c) for c in self.columns],
                          F.col(f"c.{CHANGE}").alias(CHANGE), TIMESTAMP, F.lit(version).cast("long").alias(VERSION))

    def fold(self) -> int:
        """Rewrites the dates touched since the last fold, as of the newest version, and returns that version."""
        done = self.folded()
        versions = [v for v in self._numbers("log") if v > done]
        if not versions:
            return done
        through = versions[-1]
        dates = sorted({d for v in versions for d in self._dates(v)})
        if dates:
            rows = self.current(dates[0], dates[-1]).where(F.col(self.date).isin(dates)).withColumn(VERSION, F.lit(through).cast("long"))
            (rows.hint("rebalance", F.col(self.date)).sortWithinPartitions(self.date, *self.keys)
             .write.mode("overwrite").partitionBy(self.date).parquet(self._at("base", through)))
        there = {_dt.date.fromisoformat(n.split("=")[1]) for n in self.store.names(self._at("base", through)) if n.startswith(f"{self.date}=")}
        bases = {d: f for d, f in self._bases().items() if d not in set(dates)} | dict.fromkeys(there, through)
        (self.spark.createDataFrame(sorted(bases.items()), f"{self.date} date, fold long").coalesce(1)
         .write.mode("overwrite").parquet(self._at("pointer", through)))
        return through

    def publish(self, name: str, version: int) -> None:
        """Brings the dates that a version touched up to date in the catalog's table ``name``, made if it is not there.

        Whole dates are overwritten with their current rows, so publishing a version again changes nothing.
        """
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [*[f for f in self.fields if f.name != self.date], self.log_schema[self.date]])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({self.date})")
        dates = self._dates(version)
        if not dates:
            return
        order = self.spark.table(name).columns
        rows = self.current(dates[0], dates[-1]).where(F.col(self.date).isin(dates)).select(*order)
        rows.hint("rebalance", F.col(self.date)).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
        left = {r[0] for r in rows.select(self.date).distinct().collect()}
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in self.spark.table(name).schema.fields if f.name != self.date)
        for d in set(dates) - left:  # all its rows were deleted
            self.spark.sql(f"INSERT OVERWRITE {name} PARTITION ({self.date} = DATE'{d}') SELECT {nothing} WHERE false")

    def vacuum(self) -> None:
        """Deletes log versions and base folders that the newest pointer does not need; the feed is kept."""
        fold = self.folded()
        for v in self._numbers("log"):
            if v <= fold:
                self.store.delete(self._at("log", v))
        used = {(f, d) for d, f in self._bases().items()}
        for f in self._numbers("base"):
            for n in self.store.names(self._at("base", f)):
                if n.startswith(f"{self.date}=") and (f, _dt.date.fromisoformat(n.split("=")[1])) not in used and f <= fold:
                    self.store.delete(f"{self._at('base', f)}/{n}")
        for f in self._numbers("pointer"):
            if f < fold:
                self.store.delete(self._at("pointer", f))


def newest_changes(feed: DataFrame, keys: list[str], one_version: bool = False) -> DataFrame:
    """The newest change of each key in a slice of a feed, with ``_deleted``; pre-images do not count.

    A key has one change per version that is not a pre-image, so ``max_by`` picks one row before the shuffle, and
    a slice of ``one_version`` has nothing to choose from: no row is moved.
    """
    rest = [c for c in feed.columns if c not in (*keys, CHANGE, VERSION, TIMESTAMP)]
    changes = feed.where(F.col(CHANGE) != "update_preimage")
    deleted = (F.col(CHANGE) == "delete").alias(DELETED)
    if one_version:
        return changes.select(*keys, *rest, deleted)
    row = F.max_by(F.struct(*rest, deleted), F.col(VERSION))
    return changes.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")
