"""Weekly, monthly and quarterly bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import period_start
from ..schema import PERIODS


def period_bars(
    daily: DataFrame, period: str, stamp: bool = True, keep_start: bool = False
) -> DataFrame:
    """One bar per ticker and period, named by its last trading day.

    ``keep_start`` adds the first calendar day of the period, ``period_start``.

    The first and last rows travel as structs through one aggregation, so the
    shuffle carries one partial bar per (task, ticker, period) and a ticker
    with very many rows costs its task no more than any other.
    """
    unit, key = PERIODS[period]
    last = F.max_by(F.struct("short_name", "close", "adj_close"), "date")
    out = (
        daily.groupBy("ticker", period_start("date", unit).alias("period_start"))
        .agg(
            last.alias("_last"),
            F.max("date").alias(key),
            F.min_by("open", "date").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
        )
        .select(
            "ticker",
            F.col("_last.short_name").alias("short_name"),
            key,
            "open",
            "high",
            "low",
            F.col("_last.close").alias("close"),
            F.col("_last.adj_close").alias("adj_close"),
            "volume",
            F.col(key).alias("source_max_date"),
            *(["period_start"] if keep_start else []),
        )
    )
    return out.withColumn("built_at", F.current_timestamp()) if stamp else out


def weekly_bars(daily: DataFrame, stamp: bool = True) -> DataFrame:
    """ISO weeks (Monday based, so a week may span two calendar years)."""
    return period_bars(daily, "week", stamp)


def monthly_bars(daily: DataFrame, stamp: bool = True) -> DataFrame:
    return period_bars(daily, "month", stamp)


def quarterly_bars(daily: DataFrame, stamp: bool = True) -> DataFrame:
    return period_bars(daily, "quarter", stamp)


def latest_load(daily: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per (ticker, date): the one with the newest ``ingested_at``.

    Copies are merged map-side first, so a key with any number of copies
    reaches the shuffle as one row per task. Equal load times fall back to the
    larger values, which keeps the result the same on every run.
    """
    rest = columns or [c for c in daily.columns if c not in ("ticker", "date")]
    if len(rest) == 1:
        picked = F.max_by(rest[0], "ingested_at").alias(rest[0])
        return daily.groupBy("ticker", "date").agg(picked)
    ordered = ["ingested_at"] + [c for c in rest if c != "ingested_at"]
    return (
        daily.groupBy("ticker", "date")
        .agg(F.max(F.struct(*ordered)).alias("_row"))
        .select("ticker", "date", *[F.col(f"_row.{c}").alias(c) for c in rest])
    )
