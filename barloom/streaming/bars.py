"""Weekly bars as an event-time aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATE_DAYS = 21


def weekly_bars_stream(
    bars: DataFrame, delay: str = f"{LATE_DAYS} days", key: list[str] | None = None
) -> DataFrame:
    """One row per ticker and Monday-based week, emitted once the week is closed.

    ``bars`` is a stream of (ticker, ts, open, high, low, close, volume). Rows
    up to ``delay`` late still count, later ones are dropped. Equal ``key`` rows
    (default: ticker and ts) count once. State holds a handful of numbers per
    open (ticker, week), and one key per row of the last ``delay`` to tell
    copies: size the state store for as many keys as arrive in that time.

    Windows are counted from 1970-01-01, a Thursday; the 4-day offset moves
    their start to Monday.
    """
    rows = bars.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key or ["ticker", "ts"])
    week = F.window("ts", "7 days", startTime="4 days")
    return (
        rows.groupBy("ticker", week.alias("w"))
        .agg(
            F.max("ts").alias("last_ts"),
            F.min_by("open", "ts").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "ts").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select(
            "ticker",
            F.to_date("w.start").alias("week_start"),
            F.to_date("last_ts").alias("week_ending"),
            "open",
            "high",
            "low",
            "close",
            "volume",
        )
    )
