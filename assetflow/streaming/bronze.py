"""The bronze table: what each micro-batch landed, and compacted copies that replace it for readers.

    <root>/layout=k/batch=n/reading_date=d/...              as landed, in the schema of version k
    <root>_compacted/version=v/reading_date=d/...           rewritten files
    <root>_manifest/version=v/                              (file, layout, live): files replaced and files that replace them

A micro-batch's rows are written aside and take their place by one move, so a stream over ``<root>`` sees all
of a batch or nothing, and a replayed batch that has its place already is left as it is. Compaction writes
copies elsewhere and then its manifest version; it never touches ``<root>``, so streams go on and readers of an
older version keep their files. ``clean`` deletes replaced files once the stream after bronze has read them.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import layout
from ..sources.landing import typed
from ..sources.storage import Storage

DATE = "reading_date"
_DATE_FIELD = T.StructField(DATE, T.DateType())


class Bronze:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Storage(spark)
        self.compacted, self.manifest = f"{self.root}_compacted", f"{self.root}_manifest"

    # -- appending ------------------------------------------------------------
    def batches(self) -> set[int]:
        return {int(b[6:]) for k in self.store.names(self.root) if k.startswith("layout=")
                for b in self.store.names(f"{self.root}/{k}") if b.startswith("batch=")}

    def append(self, rows: DataFrame, batch: int, version: int) -> None:
        """``rows`` (with a reading_date) as batch number ``batch``, in schema version ``version``."""
        aside, place = f"{self.root}_aside/batch={batch}", f"{self.root}/layout={version}/batch={batch}"
        rows.write.mode("overwrite").partitionBy(DATE).parquet(aside)
        self.store.move(aside, place)

    # -- reading --------------------------------------------------------------
    def versions(self) -> list[int]:
        """Manifest versions, each the state after one compaction; -1 is the table as landed."""
        return [-1, *sorted(int(n[8:]) for n in self.store.names(self.manifest) if n.startswith("version="))]

    def _changes(self, version: int) -> DataFrame:
        schema = "file string, layout int, live boolean, version int"
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.manifest).where(F.col("version") <= version)

    def files(self, version: int | None = None) -> DataFrame:
        """Live files of a version (default: the newest): place, layout, reading_date, bytes. Contents are not read."""
        version = self.versions()[-1] if version is None else version
        listed = lambda root: (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
                               .load(root).select("path", F.col("length").alias("bytes")))
        landed = listed(self.root).select("path", "bytes", F.regexp_extract("path", r"/layout=(\d+)/", 1).cast("int").alias("layout"), F.lit(False).alias("copy"))
        changes = self._changes(version)
        if version >= 0:
            copies = listed(self.compacted).withColumn("file", _short("path")).join(
                changes.where("live").select("file", "layout"), "file").select("path", "bytes", "layout", F.lit(True).alias("copy"))
            landed = landed.unionByName(copies)
        gone = changes.where("NOT live").select("file")
        return (landed.withColumn("file", _short("path")).join(gone, "file", "left_anti")
                .withColumn(DATE, F.to_date(F.regexp_extract("path", f"/{DATE}=([0-9-]+)/", 1).try_cast("date"))))

    def read(self, schemas: dict[int, T.StructType], version: int | None = None) -> DataFrame:
        """All rows in the newest schema; each file is read in the schema it was written with.

        ``schemas``: the schema of each layout, without the date. A column that had no type yet is text.
        """
        newest = schemas[max(schemas)]
        out = T.StructType([*[T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in newest.fields], _DATE_FIELD])
        version = self.versions()[-1] if version is None else version
        rows = self.spark.createDataFrame([], out)
        if version < 0:  # nothing was ever replaced: the folders are the table
            parts = [(k, f"{self.root}/layout={k}", [f"{self.root}/layout={k}"]) for k in schemas if self.store.exists(f"{self.root}/layout={k}")]
        else:
            found: dict[tuple[int, str], list[str]] = {}
            for r in self.files(version).select("path", "layout", "copy").collect():  # names, as any reader's driver lists them
                found.setdefault((r["layout"], self.compacted if r["copy"] else f"{self.root}/layout={r['layout']}"), []).append(r["path"])
            parts = [(k, base, paths) for (k, base), paths in sorted(found.items())]
        for k, base, paths in parts:
            have = self.spark.read.schema(T.StructType([*typed(schemas[k]).fields, _DATE_FIELD])).option("basePath", base).parquet(*paths)
            rows = rows.unionByName(have.select(*[F.col(f.name).cast(f.dataType) for f in out.fields if f.name in have.columns]), allowMissingColumns=True)
        return rows

    # -- compaction -----------------------------------------------------------
    def compact(self, schemas: dict[int, T.StructType], before: _dt.date, cluster_by: list[str],
                target_file_bytes: int = layout.TARGET_FILE_BYTES) -> int:
        """Copies the dates before ``before`` that have more files than their bytes need into few clustered files.

        Returns the rows copied. May run while the chain does; rows that land meanwhile stay as landed.
        """
        live = self.files().where(F.col(DATE) < F.lit(before))
        per = live.groupBy(DATE).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        todo = per.where(F.col("n") > F.ceil(F.col("bytes") / F.lit(target_file_bytes)))
        # the list is fixed before it is read: what the manifest says is replaced is what was copied
        chosen = live.join(todo.select(DATE), DATE).select("path", "file", "layout", "copy", "bytes").collect()
        if not chosen:
            return 0
        version, newest = self.versions()[-1] + 1, max(schemas)
        groups: dict[tuple[int, str], list[str]] = {}
        for r in chosen:
            groups.setdefault((r["layout"], self.compacted if r["copy"] else f"{self.root}/layout={r['layout']}"), []).append(r["path"])
        out = T.StructType([*typed(schemas[newest]).fields, _DATE_FIELD])
        rows = self.spark.createDataFrame([], out)
        for (k, base), paths in sorted(groups.items()):
            have = self.spark.read.schema(T.StructType([*typed(schemas[k]).fields, _DATE_FIELD])).option("basePath", base).parquet(*paths)
            rows = rows.unionByName(have.select(*[F.col(f.name).cast(f.dataType) for f in out.fields if f.name in have.columns]), allowMissingColumns=True)
        n = max(1, math.ceil(sum(r["bytes"] for r in chosen) / target_file_bytes))
        place = f"{self.compacted}/version={version}"
        layout.clustered(rows, DATE, cluster_by, n).write.mode("overwrite").partitionBy(DATE).parquet(place)
        new = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(place)
               .select(_short("path").alias("file"), F.lit(newest).alias("layout"), F.lit(True).alias("live")))
        old = self.spark.createDataFrame([(r["file"], r["layout"], False) for r in chosen], "file string, layout int, live boolean")
        count = self.spark.read.schema(out).parquet(place).count()
        # the copies count from here on
        new.unionByName(old).coalesce(1).write.mode("overwrite").parquet(f"{self.manifest}/version={version}")
        return count

    def clean(self, keep: int = 1, consumed: DataFrame | None = None) -> int:
        """Deletes files that were replaced before the last ``keep`` versions; returns how many.

        ``consumed``: the ``file`` names that the stream after bronze has read; landed files beyond it stay.
        """
        versions = self.versions()[1:]
        if len(versions) <= keep:
            return 0
        gone = self._changes(versions[-1 - keep]).where("NOT live").select("file").distinct()
        if consumed is not None:
            gone = gone.join(consumed.select("file").withColumn("__read", F.lit(True)), "file", "left").where(
                F.col("__read") | F.col("file").startswith("version=")).select("file")
        n = 0
        for r in gone.toLocalIterator():
            root = self.compacted if r["file"].startswith("version=") else self.root
            if self.store.exists(f"{root}/{r['file']}"):
                self.store.delete(f"{root}/{r['file']}")
                n += 1
        return n


def _short(path: str):
    """A file's place below the table's root."""
    return F.regexp_extract(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), r"/((?:layout|version)=[0-9]+/.*)$", 1)


def read_by_stream(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file``: what a file stream with this checkpoint has taken, from the source's own log."""
    entries = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    return entries.select(F.get_json_object("value", "$.path").alias("path")).select(_short("path").alias("file")).distinct()
