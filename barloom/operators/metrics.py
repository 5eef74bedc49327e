"""Return distribution, payoff and expectancy per ticker over the newest bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite, ln_positive, ratio, recent

# Edges of the |return| buckets and the column names between them.
OUTLIER_EDGE = 0.05
BUCKETS = {
    "0_5": (None, 0.05),
    "5_10": (0.05, 0.10),
    "10_15": (0.10, 0.15),
    "15_20": (0.15, 0.20),
    "ge_20": (0.20, None),
}


def return_metrics(
    bars: DataFrame,
    key: str = "week_ending",
    keep: int = 260,
    unit: str = "weeks",
    short: str = "wk",
) -> DataFrame:
    """One row per ticker: counts, log-return moments, buckets, payoff, expectancy.

    Reads only the newest keep + 1 bars per ticker (the extra one gives the
    oldest return its base); every column comes from a single aggregation.
    """
    w = Window.partitionBy("ticker").orderBy(key)
    ret = F.col("ret")
    rows = (
        recent(bars.select("ticker", key, "adj_close"), keep + 1, key)
        .withColumn("_prev", F.lag("adj_close").over(w))
        .withColumn("_raw", ratio("adj_close", "_prev") - 1)
        .withColumn("ret", F.when(finite("_raw") & (F.col("_prev") > 0), F.col("_raw")))
        .withColumn("rlog", ln_positive(F.lit(1) + ret))
        .filter(F.col("rn") <= keep)
    )

    size = F.abs(ret)
    aggs = [
        F.count("*").alias(f"n_{unit}"),
        F.count("ret").alias(f"n_{unit}_ret_valid"),
        F.count("rlog").alias(f"n_{unit}_log_valid"),
        F.avg("rlog").alias("mu_log"),
        F.stddev_pop("rlog").alias("sigma_log"),
        F.skewness("rlog").alias("skew"),
        (F.kurtosis("rlog") + 3.0).alias("kurt"),
        F.avg((ret > 0).cast("double")).alias("hit_rate"),
        F.avg((size > OUTLIER_EDGE).cast("double")).alias("pct_outlier"),
    ]
    for name, (low, high) in BUCKETS.items():
        inside = F.lit(True)
        if low is not None:
            inside = inside & (size > low)
        if high is not None:
            inside = inside & (size <= high)
        aggs.append(F.count_if(inside & ret.isNotNull()).alias(f"n_{name}"))
        aggs.append(F.avg(F.when(ret.isNotNull(), inside.cast("double"))).alias(f"b_{name}"))
    aggs += [
        F.max(F.when(F.col("rn") == 1, F.col("adj_close"))).alias("last_close"),
        F.stddev_pop("ret").alias("_ret_std"),
        F.avg(F.when(ret > 0, ret)).alias("_up"),
        F.abs(F.avg(F.when(ret < 0, ret))).alias("_down"),
    ]
    stats = rows.groupBy("ticker").agg(*aggs)

    last = F.col("last_close")
    up, down = F.col("_up") * last, F.col("_down") * last
    payoff = ratio("_up", "_down")
    expectancy = F.col("hit_rate") * up - (F.lit(1) - F.col("hit_rate")) * down
    n_cols = [f"n_{name}" for name in BUCKETS]
    b_cols = [f"b_{name}" for name in BUCKETS]
    return stats.select(
        "ticker",
        f"n_{unit}",
        f"n_{unit}_ret_valid",
        f"n_{unit}_log_valid",
        "mu_log",
        "sigma_log",
        "skew",
        "kurt",
        "hit_rate",
        "pct_outlier",
        *[c for pair in zip(n_cols, b_cols) for c in pair],
        sum(F.col(c) for c in n_cols).alias("bucket_count_sum"),
        sum(F.col(c) for c in b_cols).alias("bucket_sum"),
        "last_close",
        (F.col("_ret_std") * last).alias("hist_em_abs"),
        up.alias("avg_up_dollar"),
        down.alias("avg_down_dollar"),
        F.when(finite(payoff), payoff).alias("payoff"),
        F.when(finite(expectancy), expectancy).alias(f"expectancy_per_{short}"),
    )


def return_metrics_weekly(weekly: DataFrame) -> DataFrame:
    return return_metrics(weekly, "week_ending", 260, "weeks", "wk")


def return_metrics_monthly(monthly: DataFrame) -> DataFrame:
    return return_metrics(monthly, "month_ending", 60, "months", "mo")


def return_metrics_quarterly(quarterly: DataFrame) -> DataFrame:
    return return_metrics(quarterly, "quarter_ending", 20, "quarters", "qtr")
