"""Joins against dimension-sized tables, broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config

# fixed widths in bytes per value (strings and binaries are measured)
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def _fixed_width(dt: T.DataType) -> int | None:
    if isinstance(dt, T.StructType):
        parts = [_fixed_width(f.dataType) for f in dt.fields]
        return None if any(p is None for p in parts) else sum(parts)
    for t, w in _WIDTH.items():
        if isinstance(dt, t):
            return w
    return None


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df`` in one aggregate: fixed-width columns by type,
    strings and binaries by their measured length, anything nested as its JSON."""
    fixed = 0
    measured = []
    for f in df.schema.fields:
        w = _fixed_width(f.dataType)
        if w is not None:
            fixed += w
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            measured.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    var = F.sum(sum(measured)) if measured else F.lit(0)
    r = df.agg(F.count(F.lit(1)).alias("n"), var.alias("b")).first()
    n = int(r["n"])
    return n, n * fixed + int(r["b"] or 0)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = config.BROADCAST_MAX_ROWS,
               max_bytes: int = config.BROADCAST_MAX_BYTES) -> DataFrame:
    """Join ``big`` to a dimension-sized ``small``.

    ``small`` is broadcast only when one aggregate over it shows both its row
    count and its size in bytes within bounds. Otherwise the join is left to
    the planner (sort-merge, with AQE able to switch on measured sizes).
    """
    n, size = size_of(small)
    if n <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
