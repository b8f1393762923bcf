"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side)."""

from .columns import avg_channels, ntz, ntz_all, round_doubles, window_start
from .joins import join_small

__all__ = ["avg_channels", "ntz", "ntz_all", "round_doubles", "window_start", "join_small"]
