"""Expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_start(ts: str | Column, length: str) -> Column:
    """Start of the tumbling window of ``length`` containing ``ts``.

    Grouping on this flat timestamp (rather than the ``window`` struct) keeps the
    aggregate hash-partitioned on the same column later joins use.
    """
    return F.window(ts, length).start


def avg_channels(channels: list[str]) -> list[Column]:
    """Null-ignoring mean of every channel, named after the channel."""
    return [F.avg(c).alias(c) for c in channels]


def ntz(c: str | Column) -> Column:
    return F.col(c).cast(T.TimestampNTZType()) if isinstance(c, str) else c.cast(T.TimestampNTZType())


def ntz_all(df: DataFrame) -> DataFrame:
    """Cast every session-zone timestamp to a wall-clock timestamp (for output)."""
    cols = [F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def round_half_away(c: Column, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` in floating point, half away from zero.

    This is how SQL engines such as DuckDB round doubles. Spark's ``round`` on
    a double rounds its shortest decimal string instead, which differs when
    ``x * 10^d`` lands exactly on .5 (common for means of short decimals), so
    the product is rounded here and both engines print the same value.
    """
    m = float(10 ** digits)
    return F.round(c * F.lit(m), 0) / F.lit(m)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating results so engines agree on the last bits of a sum.

    Two stages: 10 digits first, which absorbs the last-bit differences that a
    different summation order leaves, then ``digits``. Without the first stage
    a mean lying exactly on a tie at digit 7 could round either way.
    """
    cols = [round_half_away(round_half_away(F.col(f.name), 10), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
