"""Shared helpers: tables, intermediate tables in the shared folder, Arrow text, packed rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage at a table all executors share, so a lost executor costs a
    re-read and not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null ids: the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def groups_for(total: float, each: float, least: int = 1) -> int:
    """How many groups keep each at about ``each`` units of ``total``."""
    return max(least, math.ceil((total or 0) / each))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut by row into slices of about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        off = text_buffers(batch.column(batch.schema.get_field_index(column)))[1]
        a = 0
        while a < batch.num_rows:
            b = int(np.searchsorted(off, off[a] + most, side="right")) - 1
            b = min(max(b, a + 1), batch.num_rows)
            yield batch.slice(a, b - a)
            a = b


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (int64, from 0) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def ragged(ptr: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Flat positions of the runs ``[ptr, ptr + size)``, one after the other."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.repeat(ptr - (ends - size), size) + np.arange(total, dtype=np.int64)


def pack(*columns: np.ndarray) -> bytes:
    """Equally long columns as one compressed blob."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    """The columns of a blob written by ``pack`` with these types."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    kinds = [np.dtype(t) for t in types]
    n = len(raw) // sum(k.itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * k.itemsize
    return out


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket number with the positions of its rows, in their order."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut):
        if len(part):
            yield int(bucket[part[0]]), part


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)


def with_columns(batch: pa.RecordBatch, names: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with ``new`` columns as ``withColumn`` puts them: in the place of one of that name, whatever its case, or last."""
    by = {n.lower(): c for n, c in new.items()}
    return pa.RecordBatch.from_arrays([by[n.lower()] if n.lower() in by else batch.column(batch.schema.get_field_index(n)) for n in names], names)


def is_finite_vector(col: str) -> Column:
    """True for a non-empty array of finite, non-null components."""
    v = F.col(col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False))
