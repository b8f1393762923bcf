"""The three chained streams.

* bronze: new CSV files, each by its own header -> Parquet table partitioned by
  date (append; see ``streaming.bronze``).
* silver: bronze as a stream -> watermark -> tumbling-window means in update
  mode -> ``foreachBatch`` upsert into the silver table.
* gold:   the silver table's typed changes as a stream -> newest per key within
  the micro-batch, deletes included -> join asset metadata (re-read each batch)
  -> upsert into the gold table.

Stages hand over through storage, never memory, and every stage keeps its
progress in a checkpoint under the shared checkpoint root, so any stage can be
stopped, restarted or lose executors and resume where it committed. Silver and
gold are keyed tables by date with a folded base and a feed; upserts are
replay-safe (see ``operators.keyed``).

The silver stage keeps Spark's no-data micro-batches: rows are judged late
against the watermark of the previous batch, and a no-data batch is what
advances it after the last rows arrived. Without it a late row would be
accepted for one more trigger.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..functions.joins import join_small
from ..operators import aggregate, changelog
from ..operators.keyed import KeyedTable, newest_changes
from ..operators.layout import TARGET_FILE_BYTES
from ..sources import files, landing
from ..sources.storage import Storage
from .bronze import Bronze, read_by_stream

_STARTING = threading.Lock()
KEYS = ["asset_id", "window_start"]

READING_SCHEMA = T.StructType(
    [T.StructField("event_time", T.TimestampType()), T.StructField("asset_id", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in config.CHANNELS])

# what silver reads of bronze: the columns of the folders last, in their order
BRONZE_SCHEMA = T.StructType(READING_SCHEMA.fields + [
    T.StructField("layout", T.IntegerType()), T.StructField("batch", T.IntegerType()), T.StructField("reading_date", T.DateType())])


SILVER_FIELDS = ([T.StructField("asset_id", T.IntegerType()), T.StructField("reading_date", T.DateType()),
                  T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())]
                 + [T.StructField(c, T.DoubleType()) for c in config.CHANNELS])
ASSET_FIELDS = [T.StructField(c, T.StringType()) for c in ("country", "manufacturer", "region")]


class Medallion:
    """Paths, stream definitions and lifecycle of the bronze/silver/gold chain."""

    def __init__(self, spark: SparkSession, root: str, assets: Callable[[], DataFrame] | None = None,
                 length: str = config.WINDOW, watermark: str = config.WATERMARK,
                 schema: T.StructType = READING_SCHEMA, max_files: int | None = None,
                 live: dict[str, tuple[str | Callable[[DataFrame], DataFrame], list[str]]] | None = None, gold_from_version: int = 0,
                 corrupt_column: str | None = None, state_partitions: int | None = None,
                 evolve: bool = False, archive: str | None = None, fold_every: int = 4,
                 gold_table: str | None = None, gold_feed: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.store = Storage(spark)
        self.assets, self.length, self.watermark = assets, length, watermark
        self.schema, self.max_files = schema, max_files
        self.landing = f"{self.root}/landing"
        self.bronze = f"{self.root}/bronze"
        self.silver = KeyedTable(spark, f"{self.root}/silver", SILVER_FIELDS, KEYS, fold_every=fold_every)
        self.gold = KeyedTable(spark, f"{self.root}/gold", SILVER_FIELDS + ASSET_FIELDS, KEYS, fold_every=fold_every, with_feed=gold_feed)
        self.queries: dict[str, StreamingQuery] = {}
        self._first: dict[str, int] = {}
        # name -> (SQL over the view "sensor_stream" or a function of its frame, group keys): live aggregates
        self.live = dict(live or {})
        # first silver version the gold stream consumes (a change feed's starting version)
        self.gold_from_version = gold_from_version
        # keep unparseable CSV lines in bronze under this column instead of failing
        self.corrupt_column = corrupt_column
        # a table of the catalog that gold's current rows are kept in, such as the declared enriched_readings
        self.gold_table = gold_table
        # take columns that ``schema`` does not declare, with inferred and remembered types
        self.evolve = evolve
        # move consumed landing files there; a live aggregate reads the same files, so not with both
        self.archive = archive
        # look into folders of the landing folder: their files land together, by one move
        self.nested = False
        if archive and self.live:
            raise ValueError("live aggregates read the landing folder as well: its files cannot be archived")
        self.remembered = landing.Remembered(spark, f"{self.root}/_schema")
        self.table = Bronze(spark, self.bronze)
        # shuffle partitions of the streams, fixed by the first start of a checkpoint:
        # sized for the state (assets x open windows), not for a batch job's input
        self.state_partitions = int(state_partitions or spark.sparkContext.defaultParallelism)

    @classmethod
    def evolving(cls, spark: SparkSession, root: str, **kw) -> "Medallion":
        """A chain whose files may hold more columns than the reading schema declares.

        Their types are inferred from the files of the micro-batch they come in and remembered under
        ``<root>/_schema``; the table grows while the stream runs, and older rows read NULL in new columns.
        """
        return cls(spark, root, evolve=True, **kw)

    def ckpt(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def first_version(self, name: str, newest: Callable[[], int | None]) -> int:
        """The version of a stage's batch 0: above every one (``newest``) that was there when its checkpoint was begun.

        Kept beside the checkpoint's own files, so a restart goes on with it and a fresh checkpoint, whose
        batches count from 0 again, neither overwrites nor falls behind older versions.
        """
        if name not in self._first:
            place = f"{self.ckpt(name)}/first_version"
            if self.store.exists(place):
                first = int(self.spark.read.text(place).first()[0])
            else:
                last = newest()
                first = 0 if last is None else int(last) + 1
                self.spark.createDataFrame([(str(first),)], "value string").coalesce(1).write.text(place)
            self._first[name] = first
        return self._first[name]

    def _newest_in(self, log_path: str) -> Callable[[], int | None]:
        def newest() -> int | None:
            return max((int(n.split("=")[1]) for n in self.store.names(log_path) if n.startswith(f"{changelog.VERSION}=")), default=None)
        return newest

    # -- stream definitions ----------------------------------------------
    def _first_bronze(self) -> int:
        return self.first_version("bronze", lambda: max(self.table.batches(), default=None))

    def _append_bronze(self, new: DataFrame, batch_id: int) -> None:
        batch = self._first_bronze() + batch_id
        if batch in self.table.batches():  # replayed: it has its place already
            return
        groups, without = landing.by_header(self.spark, [r["path"] for r in new.collect()], self.schema.fields[0].name)
        schema, version = self.schema, 0
        if self.evolve:
            known = self.remembered.newest()
            schema = landing.grown(known[1] if known else self.schema, landing.infer(self.spark, groups, self.schema))
            version = self.remembered.keep(schema)
        rows = landing.read(self.spark, groups, schema, without, self.corrupt_column)
        self.table.append(aggregate.with_reading_date(rows), batch, version)

    def bronze_writer(self):
        self._first_bronze()
        src = landing.new_files(self.spark, self.landing, self.max_files, self.archive, self.nested)
        return src.writeStream.foreachBatch(self._append_bronze).option("checkpointLocation", self.ckpt("bronze"))

    def silver_frame(self) -> DataFrame:
        b = self.spark.readStream.schema(BRONZE_SCHEMA).parquet(self.bronze)
        return aggregate.windowed_avg(b.withWatermark("event_time", self.watermark), self.length)

    def _upsert_silver(self, batch: DataFrame, batch_id: int) -> None:
        if not self.silver.upsert(batch.dropDuplicates(KEYS), self.first_version("silver", self.silver.newest_version) + batch_id):
            batch.write.format("noop").mode("overwrite").save()  # replayed: its state is still to be committed

    def silver_writer(self):
        self.first_version("silver", self.silver.newest_version)
        return (self.silver_frame().writeStream.foreachBatch(self._upsert_silver)
                .outputMode("update").option("checkpointLocation", self.ckpt("silver")))

    def _upsert_gold(self, batch: DataFrame, batch_id: int) -> None:
        # versions are folders of the feed: none of its rows is read for this
        span = batch.agg(F.min(changelog.VERSION), F.max(changelog.VERSION)).first()
        changes = newest_changes(batch, KEYS, one_version=span[0] == span[1])
        enriched = join_small(changes, self.assets(), "asset_id", "inner")
        version = self.first_version("gold", self.gold.newest_version) + batch_id
        self.gold.upsert(enriched, version)
        if self.gold_table:
            self.gold.publish(self.gold_table, version)

    def gold_writer(self):
        self.first_version("gold", self.gold.newest_version)
        return (self.silver.feed_stream(self.gold_from_version).writeStream.foreachBatch(self._upsert_gold)
                .option("checkpointLocation", self.ckpt("gold")))

    def live_log(self, name: str) -> str:
        return f"{self.root}/live_{name}_log"

    def live_writer(self, name: str):
        """An aggregate over the raw stream, kept current in a change log.

        The CSV stream is registered as the temp view ``sensor_stream``; the
        result is emitted in update mode (only groups that changed) and
        appended as a version, so ``current`` is the live table.
        """
        build, _ = self.live[name]
        files.csv_stream(self.spark, self.landing, self.schema, self.max_files, nested=self.nested)\
            .createOrReplaceTempView("sensor_stream")
        agg = self.spark.sql(build) if isinstance(build, str) else build(self.spark.table("sensor_stream"))
        path = self.live_log(name)
        self.first_version(f"live_{name}", self._newest_in(path))

        def upsert(batch: DataFrame, batch_id: int) -> None:
            changelog.append_version(batch, path, self.first_version(f"live_{name}", self._newest_in(path)) + batch_id)

        return (agg.writeStream.foreachBatch(upsert).outputMode("update")
                .option("checkpointLocation", self.ckpt(f"live_{name}")))

    def live_current(self, name: str) -> DataFrame:
        return changelog.current(changelog.read_log(self.spark, self.live_log(name)), self.live[name][1])

    # -- lifecycle ----------------------------------------------------------
    def ensure_dirs(self) -> None:
        # file stream sources need their folder to exist before the first file lands
        for path in (self.landing, self.bronze):
            self.store.make(path)

    def stages(self, gold: bool = True, chain: bool = True, upto: str = "gold") -> list:
        out = [("bronze", self.bronze_writer), ("silver", self.silver_writer)] if chain else []
        if chain and gold and self.assets is not None:
            out.append(("gold", self.gold_writer))
        order = ["bronze", "silver", "gold"]
        out = [st for st in out if order.index(st[0]) <= order.index(upto)]
        for name in self.live:
            out.append((f"live_{name}", lambda n=name: self.live_writer(n)))
        return out

    def _start(self, w) -> StreamingQuery:
        """Start a stream with ``state_partitions`` shuffle partitions.

        A query copies the session's SQL settings when it starts, so the value
        is set for the start only and the session's own value is restored.
        """
        key = "spark.sql.shuffle.partitions"
        with _STARTING:  # one at a time, or one start would restore another's value
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, str(self.state_partitions))
            try:
                return w.start()
            finally:
                self.spark.conf.set(key, before)

    def start(self, gold: bool = True, trigger: dict | None = None, chain: bool = True) -> "Medallion":
        """Start the chain (bronze, silver, gold when metadata is given) and any
        live aggregates as continuous queries; ``chain=False`` starts only the
        live aggregates."""
        self.ensure_dirs()
        for name, writer in self.stages(gold, chain):
            w = writer()
            if trigger:
                w = w.trigger(**trigger)
            self.queries[name] = self._start(w)
        return self

    def drain(self) -> None:
        """Block until every stage has processed everything available, in order."""
        for name in ["bronze", "silver", "gold"] + [f"live_{n}" for n in self.live]:
            if name in self.queries:
                self.queries[name].processAllAvailable()

    def run_available_now(self, gold: bool = True, chain: bool = True, upto: str = "gold") -> None:
        """One bounded run per stage, each after the previous one finished
        (batch-style scheduling, e.g. a daily job); ``upto`` stops after a stage."""
        self.ensure_dirs()
        for name, writer in self.stages(gold, chain, upto):
            q = self._start(writer().trigger(availableNow=True))
            self.queries[name] = q
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()

    def dropped_late_rows(self) -> int:
        q = self.queries.get("silver")
        if q is None:
            return 0
        return sum(op.get("numRowsDroppedByWatermark", 0)
                   for p in q.recentProgress for op in p.get("stateOperators", []))

    # -- readers ------------------------------------------------------------
    def bronze_table(self) -> DataFrame:
        """Bronze with every column known so far, and the bad lines kept beside."""
        extra = [T.StructField(self.corrupt_column, T.StringType())] if self.corrupt_column else []
        return self.table.read({k: T.StructType([*s.fields, *extra]) for k, s in self.schemas().items()})

    def schemas(self) -> dict[int, T.StructType]:
        """The reading schema by version; one version, the declared one, if it does not evolve."""
        return (self.remembered.versions() if self.evolve else {}) or {0: self.schema}

    def compact_bronze(self, before: _dt.date, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
        """Replaces the landed files of closed dates by few clustered ones; the streams may go on."""
        extra = [T.StructField(self.corrupt_column, T.StringType())] if self.corrupt_column else []
        return self.table.compact({k: T.StructType([*s.fields, *extra]) for k, s in self.schemas().items()}, before,
                                  ["asset_id", "event_time"], target_file_bytes)

    def clean_bronze(self, keep: int = 1) -> int:
        """Deletes replaced files that the silver stream has read and that no kept version needs."""
        return self.table.clean(keep, read_by_stream(self.spark, self.ckpt("silver")))

    def silver_log(self) -> DataFrame:
        return self.silver.log()

    def gold_log(self) -> DataFrame:
        return self.gold.log()

    def silver_current(self) -> DataFrame:
        return self.silver.current()

    def gold_current(self) -> DataFrame:
        return self.gold.current()


def slice_index(ts: str, cutoffs: list):
    return sum((F.col(ts) >= F.lit(c).cast("timestamp")).cast("int") for c in cutoffs) if cutoffs else F.lit(0)


def stream_in_slices(m: Medallion, readings: DataFrame, cutoffs: list, **start) -> Medallion:
    """Feed history to a running chain one time slice at a time, draining in between.

    Slices arrive in event-time order, as a live feed would, so no row falls
    behind the watermark; one distributed job writes all of them aside, and a
    slice's folder is moved to the landing folder when its turn comes, so the
    chain sees all of its files or none.
    """
    cols, aside = [f.name for f in m.schema.fields], f"{m.root}/_slices"
    sliced = readings.select(*cols, slice_index("event_time", cutoffs).alias("_slice")).where("_slice IS NOT NULL")
    files.write_slices(sliced, "_slice", aside)
    m.nested = True
    m.start(**start)
    try:
        for b in range(len(cutoffs) + 1):
            if m.store.exists(f"{aside}/_slice={b}"):
                m.store.move(f"{aside}/_slice={b}", f"{m.landing}/slice-{b}-{uuid.uuid4().hex[:12]}")
            m.drain()
    finally:
        m.stop()
    return m
