"""CSV files of any width in one landing folder, each read by its own header.

A stream of file names (not of lines) says which files are new; the source's checkpoint remembers them, so no
file is looked at twice. Per micro-batch the headers of its files are found, the types of columns that no
schema declares are inferred from these files alone and joined with the remembered ones, and files with one
header are read together by Spark's CSV reader: by name, absent columns NULL.
"""

from __future__ import annotations

import csv
import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import MAX_FILE_AGE, TS_FORMAT
from .storage import Storage

#: Types that inference can give, each with the wider ones it may grow to; all else becomes text.
_NUMBERS = (T.IntegerType(), T.LongType(), T.DoubleType())
#: Files of a micro-batch, at most, unless told otherwise: their names pass through the driver.
FILES_A_BATCH = 10_000

Groups = dict[tuple[str, ...], list[str]]


def new_files(spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None, nested: bool = False) -> DataFrame:
    """The landing folder as a stream of ``path``; contents are not read.

    Oldest files first, whatever their age. With ``archive``, files of committed micro-batches are moved there,
    so the folder and its listing hold only what is still to be read. With ``nested``, folders in it are looked
    into, so files can land together by the move of their folder.
    """
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
         .option("maxFileAge", MAX_FILE_AGE).option("latestFirst", False)
         .option("maxFilesPerTrigger", int(max_files or FILES_A_BATCH)))
    if nested:
        r = r.option("recursiveFileLookup", True)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.load(landing).select("path")


def _plain(path: str) -> str:
    """A path as Spark's readers take it: what they would read as a pattern is escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def by_header(spark: SparkSession, paths: list[str], key: str = "event_time") -> tuple[Groups, list[str]]:
    """Files by the names in their header, and those that have lines but no header.

    A header is a line with a cell that is just ``key``. Empty and blank files are in neither.
    """
    if not paths:
        return {}, []
    lines = spark.read.text([_plain(p) for p in paths]).select("value", F.col("_metadata.file_path").alias("path"))
    # few distinct lines hold the key: with them as a group's key all lines go through a hash aggregate, unsorted
    told = lines.groupBy("path", F.when(F.col("value").contains(key), F.col("value")).alias("header")).agg(F.max(F.trim("value") != "").alias("filled"))
    found = told.groupBy("path").agg(F.max("header").alias("header"), F.max("filled").alias("filled")).where("filled").collect()
    groups: Groups = {}
    without = []
    for r in found:  # one row per file of the micro-batch
        names = tuple(n.strip() for n in next(csv.reader([r["header"].lstrip("﻿")]))) if r["header"] else ()
        if key not in names:
            without.append(unquote(r["path"]))
            continue
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a column stands twice in the header of {r['path']}")
        groups.setdefault(names, []).append(unquote(r["path"]))
    return {h: sorted(p) for h, p in sorted(groups.items())}, sorted(without)


def _reader(spark: SparkSession, schema: T.StructType, corrupt: str | None = None):
    r = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("timestampFormat", TS_FORMAT)
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))
    return r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt) if corrupt else r.option("mode", "FAILFAST")


def infer(spark: SparkSession, groups: Groups, declared: T.StructType) -> T.StructType:
    """Types of the columns that ``declared`` does not have, from all values in these files.

    int, bigint, double or timestamp where every value is one, else string; a column without any value has no
    type yet (``void``). One aggregate per distinct header that has such columns.
    """
    known = {f.name.lower() for f in declared.fields}
    out = T.StructType([])
    for header, paths in groups.items():
        wanted = [n for n in header if n.lower() not in known]
        if not wanted:
            continue
        text = _reader(spark, T.StructType([T.StructField(n, T.StringType()) for n in header])).csv([_plain(p) for p in paths])

        def every(ok: Column, c: str) -> Column:
            return F.min(F.when(F.col(f"`{c}`").isNotNull(), F.coalesce(ok, F.lit(False))))

        aggs = []
        for i, c in enumerate(wanted):
            v = F.col(f"`{c}`")
            whole = v.rlike(r"^[+-]?[0-9]{1,19}$")
            aggs += [every(whole & v.try_cast("int").isNotNull(), c).alias(f"i{i}"), every(whole & v.try_cast("bigint").isNotNull(), c).alias(f"l{i}"),
                     every(v.try_cast("double").isNotNull(), c).alias(f"d{i}"),
                     every(v.rlike("^[0-9]{4}-") & v.try_cast("timestamp").isNotNull(), c).alias(f"t{i}")]
        r = text.agg(*aggs).first()

        def kind(i: int) -> T.DataType:
            if r[f"d{i}"] is None:
                return T.NullType()
            for flag, t in (("i", T.IntegerType()), ("l", T.LongType()), ("d", T.DoubleType()), ("t", T.TimestampType())):
                if r[f"{flag}{i}"]:
                    return t
            return T.StringType()

        out = grown(out, T.StructType([T.StructField(c, kind(i)) for i, c in enumerate(wanted)]))
    return out


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds values of both: void < int < bigint < double < string, timestamp < string."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    return T.StringType()


def grown(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with its columns as wide as ``new`` needs them and the new ones at its end."""
    by = {f.name.lower(): f for f in new.fields}
    kind = lambda f: by.pop(f.name.lower()).dataType if f.name.lower() in by else T.NullType()
    fields = [T.StructField(f.name, wider(f.dataType, kind(f))) for f in old.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in by.values()])


def typed(schema: T.StructType) -> T.StructType:
    """Without the columns that have no type yet."""
    return T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.NullType)])


def read(spark: SparkSession, groups: Groups, schema: T.StructType, without: list[str] = (), corrupt: str | None = None) -> DataFrame:
    """The files' rows with the columns of ``schema``, matched by name; absent ones are NULL.

    A cell that is not of its column's type stops the read, unless ``corrupt`` names a column for such lines. So
    do files without a header and columns that ``schema`` lacks: nothing is left out silently.
    """
    out = T.StructType([*typed(schema).fields, *([T.StructField(corrupt, T.StringType())] if corrupt else [])])
    kinds = {f.name.lower(): f for f in schema.fields}  # as in Spark, case does not tell names apart
    rows = spark.createDataFrame([], out)
    for header, paths in groups.items():
        if unknown := [n for n in header if n.lower() not in kinds]:
            raise ValueError(f"columns {unknown} of {paths[0]} are not in the schema")
        columns = [kinds[n.lower()] for n in header]
        fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in columns]
        if corrupt:
            fields.append(T.StructField(corrupt, T.StringType()))
        have = _reader(spark, T.StructType(fields), corrupt).csv([_plain(p) for p in paths])
        rows = rows.unionByName(have.select(*[f.name for f in out.fields if f.name in have.columns]), allowMissingColumns=True)
    if without:
        if not corrupt:
            raise ValueError(f"no header in {without[:3]}")
        rows = rows.unionByName(spark.read.text([_plain(p) for p in without]).select(F.col("value").alias(corrupt)), allowMissingColumns=True)
    return rows


class Remembered:
    """Schemas kept as versions in a folder; a new version is written beside the old ones, never over them."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def versions(self) -> dict[int, T.StructType]:
        if not any(n.startswith("version=") for n in Storage(self.spark).names(self.location)):
            return {}
        rows = self.spark.read.text(self.location).select("version", "value").collect()  # one line a version
        return {int(r["version"]): T.StructType.fromJson(json.loads(r["value"])) for r in rows}

    def newest(self) -> tuple[int, T.StructType] | None:
        return max(self.versions().items(), key=lambda x: x[0], default=None)

    def keep(self, schema: T.StructType) -> int:
        """The version of ``schema``: the newest, if that is it, else a new one."""
        now = self.newest()
        if now and now[1] == schema:
            return now[0]
        version = now[0] + 1 if now else 0
        self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.location}/version={version}")
        return version
