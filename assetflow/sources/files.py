"""File sources: CSV files written to and streamed from a folder, idempotent loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# microsecond timestamps survive a CSV round trip
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# a file counts as new however old its time stamp is (the source's default drops files a week
# older than the newest one)
MAX_FILE_AGE = "36500d"


def write_landing(df: DataFrame, landing_dir: str) -> None:
    """Append ``df`` as new CSV files (with header) to a landing folder."""
    (df.write.mode("append").option("header", True).option("timestampFormat", TS_FORMAT)
     .csv(landing_dir))


def write_slices(df: DataFrame, by: str, place: str) -> None:
    """``df`` as CSV files (with header) in one folder per value of ``by``, in one pass over its rows."""
    (df.write.mode("overwrite").option("header", True).option("timestampFormat", TS_FORMAT)
     .partitionBy(by).csv(place))


def csv_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
               max_files: int | None = None, corrupt_column: str | None = None, nested: bool = False) -> DataFrame:
    """Incremental CSV source; ``max_files`` caps files per micro-batch.

    Every new file is taken, whatever its age. A file's header must have the
    schema's names in their order, else the batch fails. With
    ``corrupt_column``, a line whose cells do not parse keeps NULLs in the typed
    columns and its raw text in that column; without it such a line fails the
    batch, so no value is lost silently.
    """
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
    r = (spark.readStream.schema(schema).option("header", True)
         .option("timestampFormat", TS_FORMAT).option("enforceSchema", False)
         .option("maxFileAge", MAX_FILE_AGE))
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    else:
        r = r.option("mode", "FAILFAST")
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    if nested:  # files of folders in the landing folder too
        r = r.option("recursiveFileLookup", True)
    return r.csv(landing_dir)


def idempotent_load(spark: SparkSession, src_dir: str, schema: T.StructType | str,
                    select: list[str], target: str, checkpoint: str, fmt: str = "json") -> int:
    """Load new files of ``src_dir`` into ``target`` exactly once.

    A file source with a checkpoint remembers which files it has committed, so
    a second run with ``availableNow`` adds nothing; a file is new however old its
    time stamp is. Returns rows loaded.
    """
    q = (spark.readStream.schema(schema).format(fmt).option("maxFileAge", MAX_FILE_AGE).load(src_dir)
         .selectExpr(*select)
         .writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p.get("numInputRows", 0) for p in q.recentProgress)
