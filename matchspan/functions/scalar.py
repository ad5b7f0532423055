"""Row-local scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_columns(df: DataFrame, left: str, right: str, out: str = "sum") -> DataFrame:
    """``left + right`` as a new column -- a native expression instead
    of a per-row Python function over an RDD."""
    return df.select("*", (F.col(left) + F.col(right)).alias(out))


def modulo_projection(df: DataFrame, value: str, modulus: int, time: str) -> DataFrame:
    """``value % modulus AS value`` and the time column renamed ``time``."""
    return df.selectExpr(f"{value} % {int(modulus)} AS value", f"{time} AS time")


def timestamp_diff_micros(later: Column, earlier: Column) -> Column:
    """signed difference ``later - earlier`` in microseconds (works for
    TIMESTAMP and TIMESTAMP_NTZ alike)."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def timestamp_diff_interval(later: Column, earlier: Column) -> Column:
    """signed difference as a day-time interval."""
    return later - earlier
