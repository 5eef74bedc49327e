"""Return z-scores against the preceding rows, with a named regime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    as_date_col,
    lag_value,
    ratio,
    recent,
    round_half_even,
    trailing_mean,
    trailing_std,
)
from .bars import latest_load

# The regime labels (the dash is U+2013).
NOT_AVAILABLE = "N/A"
TYPICAL = "Neutral – Typical"
VOLATILE = "– Volatile"
OUTLIER = "– Outlier"


def regime_label(ret: Column, std: Column, z: Column) -> Column:
    """Label by |z| (below 1, 1 to 2, from 2) and the sign of the return.

    A zero spread or a zero return with a large |z| counts as typical.
    """
    size = F.when((F.abs(z) >= 1) & (F.abs(z) < 2), VOLATILE).when(F.abs(z) >= 2, OUTLIER)
    side = F.when(ret > 0, "Bull").when(ret < 0, "Bear")
    return F.when(ret.isNull() | std.isNull(), NOT_AVAILABLE).otherwise(
        F.coalesce(F.concat(side, F.lit(" "), size), F.lit(TYPICAL))
    )


def regime(
    prices: DataFrame,
    key: str = "date",
    n: int = 20,
    keep: int = 120,
    suffix: str = "20d",
    out_key: str | None = None,
    after=None,
    dedupe: bool = False,
    digits: int | None = 2,
    missing: str = "null",
) -> DataFrame:
    """Last ``keep`` rows per ticker with return, z-score over the prior n, label.

    Only the newest keep + n + 1 valid rows of a ticker can matter, so older
    history is dropped before the shuffle. ``missing='zero'`` shows 0 as the
    close before a ticker's first row.
    """
    rows = latest_load(prices, ["adj_close"]) if dedupe else prices
    rows = rows.filter(F.col("adj_close") > 0)
    if after is not None:
        rows = rows.filter(F.col(key) > as_date_col(after))
    rows = rows.select("ticker", key, F.col("adj_close").alias("close_price"))
    rows = recent(rows, keep + n + 1, key)

    w = Window.partitionBy("ticker").orderBy(key)
    mean, std, z = f"mean_{suffix}", f"std_{suffix}", f"zscore_{suffix}"
    rows = (
        rows.withColumn("prev_close", lag_value("close_price", 1, w, missing))
        .withColumn("pct_change", ratio("close_price", "prev_close") - 1)
        .withColumn(mean, trailing_mean("pct_change", n, w, include_current=False))
        .withColumn(std, trailing_std("pct_change", n, w, include_current=False))
        .filter(F.col("rn") <= keep)
        .withColumn(
            z, F.when(F.col(std) > 0, ratio(F.col("pct_change") - F.col(mean), std))
        )
    )
    return rows.select(
        "ticker",
        F.col(key).alias(out_key or key),
        "close_price",
        "prev_close",
        (F.col("close_price") - F.col("prev_close")).alias("net_change"),
        "pct_change",
        round_half_even(F.col("pct_change") * 100, digits).alias("pct_change_pct"),
        mean,
        std,
        z,
        regime_label(F.col("pct_change"), F.col(std), F.col(z)).alias("regime"),
    )


def regime_daily(daily: DataFrame, digits: int | None = 2) -> DataFrame:
    return regime(daily, "date", 20, 120, "20d", "trade_date", dedupe=True, digits=digits)


def regime_weekly(weekly: DataFrame, digits: int | None = 2) -> DataFrame:
    return regime(
        weekly, "week_ending", 12, 100, "12w", "week_end", after="1971-01-01", digits=digits
    )


def regime_monthly(monthly: DataFrame, digits: int | None = 2) -> DataFrame:
    return regime(monthly, "month_ending", 12, 60, "12m", after="1971-01-01", digits=digits)


def regime_quarterly(quarterly: DataFrame, digits: int | None = 2) -> DataFrame:
    return regime(quarterly, "quarter_ending", 12, 20, "12q", after="1971-01-01", digits=digits)
