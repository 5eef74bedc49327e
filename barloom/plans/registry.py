"""Names of the derived datasets, what each is computed from, and its checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import bars, correlation, fundamentals, metrics, regimes, signals
from ..operators import quality as dq
from ..schema import DAILY_KEY
from ..sources import listings

REGIMES = [
    regimes.NOT_AVAILABLE,
    regimes.TYPICAL,
    f"Bull {regimes.VOLATILE}",
    f"Bear {regimes.VOLATILE}",
    f"Bull {regimes.OUTLIER}",
    f"Bear {regimes.OUTLIER}",
]


@dataclass(frozen=True)
class Dataset:
    """How a dataset is built, from which others, and which columns must not be NULL."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    required: tuple[str, ...] = ()


def _matrix(daily: DataFrame) -> DataFrame:
    return correlation.correlation_matrix(
        daily,
        listings.CORRELATION_FOCAL,
        listings.CORRELATION_UNIVERSE,
        listings.CORRELATION_COLUMNS,
    )


DAILY = ("daily_prices",)
LEDGERS = ("income_statement", "balance_sheet", "cashflow_statement")
ON_TICKER = ("ticker",)

# Order matters only in that inputs come before what reads them.
DATASETS: dict[str, Dataset] = {
    "weekly_prices": Dataset(bars.weekly_bars, DAILY, ("ticker", "week_ending")),
    "monthly_prices": Dataset(bars.monthly_bars, DAILY, ("ticker", "month_ending")),
    "quarterly_prices": Dataset(bars.quarterly_bars, DAILY, ("ticker", "quarter_ending")),
    "perf_52w": Dataset(signals.perf_52w, DAILY, ("ticker", "last_date", "last_close")),
    "top_movers_1d": Dataset(signals.top_movers_1d, DAILY, ("ticker", "last_date", "close_last")),
    "volume_surge": Dataset(signals.volume_surge, DAILY, ("ticker", "last_date", "volume_today")),
    "gap_scan": Dataset(signals.gap_scan, DAILY, ("ticker", "date", "open_today")),
    "momentum": Dataset(signals.momentum, DAILY, ("ticker", "last_close")),
    "distance_from_sma": Dataset(signals.distance_from_sma, DAILY, ("ticker", "last_close")),
    "breadth": Dataset(signals.breadth, DAILY, ("pct_above_50d", "pct_above_200d")),
    "scanner_52w": Dataset(signals.scanner_52w, DAILY, ("ticker", "last_close")),
    "atr_pct": Dataset(signals.atr_pct, DAILY, ("ticker", "date", "last_close")),
    "inside_outside_day": Dataset(
        signals.inside_outside_day, DAILY, ("ticker", "date", "day_type")
    ),
    "realised_vol_rank": Dataset(signals.realised_vol_rank, DAILY, ON_TICKER),
    "vix_weekly": Dataset(signals.vix_weekly, DAILY, ("week_start", "last_trading_date")),
    "regime_daily": Dataset(regimes.regime_daily, DAILY, ("ticker", "trade_date")),
    "regime_weekly": Dataset(regimes.regime_weekly, ("weekly_prices",), ("ticker", "week_end")),
    "regime_monthly": Dataset(
        regimes.regime_monthly, ("monthly_prices",), ("ticker", "month_ending")
    ),
    "regime_quarterly": Dataset(
        regimes.regime_quarterly, ("quarterly_prices",), ("ticker", "quarter_ending")
    ),
    "return_metrics_weekly": Dataset(metrics.return_metrics_weekly, ("weekly_prices",), ON_TICKER),
    "return_metrics_monthly": Dataset(
        metrics.return_metrics_monthly, ("monthly_prices",), ON_TICKER
    ),
    "return_metrics_quarterly": Dataset(
        metrics.return_metrics_quarterly, ("quarterly_prices",), ON_TICKER
    ),
    "correlation_matrix": Dataset(_matrix, DAILY, ("ticker_a",)),
    "fundamentals_long": Dataset(
        fundamentals.fundamentals_long, LEDGERS, ("ticker", "fiscal_date", "statement", "metric")
    ),
    "fundamentals_wide": Dataset(
        fundamentals.fundamentals_wide, ("fundamentals_long",), ("ticker", "fiscal_date")
    ),
    "key_ratios_wide": Dataset(
        fundamentals.key_ratios_wide, ("fundamentals_wide",), ("ticker", "fiscal_date")
    ),
    "key_ratios_long": Dataset(
        fundamentals.key_ratios_long, ("fundamentals_wide",), ("ticker", "fiscal_date")
    ),
}

BAR_KEYS = {
    "daily_prices": DAILY_KEY,
    "weekly_prices": ["ticker", "week_ending"],
    "monthly_prices": ["ticker", "month_ending"],
    "quarterly_prices": ["ticker", "quarter_ending"],
}


def build(tables: dict[str, DataFrame], names: list[str] | None = None) -> dict[str, DataFrame]:
    """All datasets whose inputs are available, as lazy frames, next to the given tables."""
    frames = dict(tables)
    for name, dataset in DATASETS.items():
        if name in frames or not all(i in frames for i in dataset.inputs):
            continue
        frames[name] = dataset.build(*[frames[i] for i in dataset.inputs])
    return frames if names is None else {n: frames[n] for n in names}


ACCEPTED = {
    **{n: ("known regime", "regime", REGIMES) for n in
       ("regime_daily", "regime_weekly", "regime_monthly", "regime_quarterly")},
    "vix_weekly": ("known level", "vix_regime", ["Calm", "Normal", "Fear"]),
}
REQUIRED = {
    "daily_prices": ("ticker", "short_name", "date", "ingested_at"),
    **{n: d.required for n, d in DATASETS.items() if d.required},
}


def checks(frames: dict[str, DataFrame], as_of=None) -> Iterator[DataFrame]:
    """(check_name, failures, status) of a dataset: required columns, labels, volume sign, keys, age.

    One pass over each dataset gives them all. Where keys count, its rows are first counted by
    key together with what each lacks, and the keys are summed; a row counts once per
    missing column. The age of the newest load of daily prices is taken on the way.
    """
    for name, df in frames.items():
        found: dict[str, Column] = {}
        if columns := REQUIRED.get(name):
            missing = sum(F.col(c).isNull().cast("bigint") for c in columns)
            found[f"{name}: not null ({', '.join(columns)})"] = missing
        if name in ACCEPTED:
            what, column, values = ACCEPTED[name]
            found[f"{name}: {what}"] = (~F.col(column).isin(values)).cast("bigint")
        if name == "daily_prices":
            found["daily_prices: volume >= 0"] = (F.col("volume") < 0).cast("bigint")
        key = BAR_KEYS.get(name)
        if not found and not key:
            continue
        parts = [F.sum(c).alias(f"c{i}") for i, c in enumerate(found.values())]
        totals = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(parts))] if key else parts
        if name == "daily_prices":
            loaded = F.max(F.col("ingested_at").cast("timestamp")).alias("max_loaded_at")
            parts, totals = [*parts, loaded], [*totals, F.max("max_loaded_at").alias("max_loaded_at")]
        if key:
            df = df.groupBy(*key).agg(F.count("*").alias("n"), *parts)
            totals.append(F.count_if(F.col("n") > 1).alias(f"c{len(found)}"))
        names = [*found, *([f"{name}: unique ({', '.join(key)})"] if key else [])]
        counted = [(n, F.coalesce(F.col(f"c{i}"), F.lit(0).cast("bigint"))) for i, n in enumerate(names)]
        sums = df.agg(*totals)
        if name == "daily_prices":
            sums = dq.aged(sums, as_of)
            # a load that is late enough to warn fails too; its status tells how badly
            counted.append(("daily_prices: fresh", F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint")))
        rows = []
        for n, failures in counted:
            status = F.col("status") if n.endswith(": fresh") else F.when(failures > 0, "error").otherwise("pass")
            rows.append(F.struct(F.lit(n).alias("check_name"), failures.alias("failures"), status.alias("status")))
        yield sums.select(F.inline(F.array(*rows)))
