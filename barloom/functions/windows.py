"""Window helpers over one row per (ticker, date).

A ticker's window is bounded by the calendar (at most one row per day, some
36,500 in a century) because the contract key is unique; duplicates are
merged before any window by an aggregation that combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col


def by_time(key: str = "date", ticker: str = "ticker"):
    return Window.partitionBy(ticker).orderBy(key)


def lag_value(c: ColumnOrName, n: int, window, missing: str = "null") -> Column:
    """Value n rows back. ``missing='zero'`` yields 0 before the first row."""
    if missing not in ("null", "zero"):
        raise ValueError("missing must be 'null' or 'zero'")
    default = 0 if missing == "zero" else None
    return F.lag(_col(c), n, default).over(window)


def _guard(value: Column, c: Column, frame, min_periods: int | None) -> Column:
    if not min_periods:
        return value
    return F.when(F.count(c).over(frame) >= min_periods, value)


def trailing_mean(c: ColumnOrName, n: int, window, include_current=True, min_periods=None):
    """Mean over the last n rows; without ``min_periods`` a short frame still counts."""
    frame = window.rowsBetween(-(n - 1), 0) if include_current else window.rowsBetween(-n, -1)
    return _guard(F.avg(_col(c)).over(frame), _col(c), frame, min_periods)


def trailing_std(c: ColumnOrName, n: int, window, include_current=True, min_periods=None):
    """Population standard deviation over the last n rows."""
    frame = window.rowsBetween(-(n - 1), 0) if include_current else window.rowsBetween(-n, -1)
    return _guard(F.stddev_pop(_col(c)).over(frame), _col(c), frame, min_periods)


def recent(df: DataFrame, n: int, key: str = "date", ticker: str = "ticker") -> DataFrame:
    """The last n rows per ticker, numbered 1 = newest in column ``rn``.

    Spark turns ``rn <= n`` into a group limit below the exchange, so a map
    task ships at most n rows per ticker instead of the whole history.
    """
    newest_first = Window.partitionBy(ticker).orderBy(F.col(key).desc())
    return df.withColumn("rn", F.row_number().over(newest_first)).filter(F.col("rn") <= n)
