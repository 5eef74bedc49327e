"""Screens over daily bars.

Most screens look only at each ticker's newest rows, so they start from
``recent(n)``: a group limit that runs before the shuffle. What the shuffle
carries is then bounded by n rows per ticker and task, not by the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    add_years,
    as_date_col,
    finite,
    lag_value,
    ln_positive,
    newest_date,
    newest_dates,
    or_zero,
    pct_change,
    period_start,
    ratio,
    recent,
    round_half_even,
    since,
    trailing_std,
)

# Trading days in a year, volatility-index bands and their names.
TRADING_DAYS = 252
CALM_BELOW = 15
NORMAL_BELOW = 20


def top_k(df: DataFrame, metric: str, k: int | None) -> DataFrame:
    """Largest k by metric, NaN and NULL last, ties by ticker."""
    rank = F.when(~F.isnan(metric), F.col(metric))
    return df if k is None else df.orderBy(rank.desc_nulls_last(), "ticker").limit(k)


def _on_latest(snapshot: DataFrame, order: list[Column], k: int | None) -> DataFrame:
    """First k rows (None: all), in the given order, among tickers trading on the newest date.

    Ordering by last date first puts exactly those rows on top, so the top-k
    itself finds the newest date. The window that then drops older tickers sees
    at most k rows, and the base table is not read a second time for its max.
    """
    if k is None:
        return snapshot.filter(F.col("last_date") == snapshot.agg(F.max("last_date")).scalar())
    top = snapshot.orderBy(F.col("last_date").desc(), *order).limit(k)
    newest = F.max("last_date").over(Window.partitionBy())
    return top.withColumn("_newest", newest).filter("last_date = _newest").drop("_newest")


def _by_metric(metric: str) -> list[Column]:
    return [F.when(~F.isnan(metric), F.col(metric)).desc_nulls_last(), F.col("ticker")]


def _at(n: int, c) -> Column:
    """Value in the row numbered n (1 = newest)."""
    return F.max(F.when(F.col("rn") == n, F.col(c) if isinstance(c, str) else c))


def _range_52w(daily: DataFrame, cutoff: Column, digits: int | None) -> DataFrame:
    bars = (
        since(daily, cutoff)
        .groupBy("ticker")
        .agg(
            F.max_by("short_name", "date").alias("name"),
            F.max("date").alias("last_date"),
            F.max_by("close", "date").alias("last_close"),
            F.max("close").alias("high_52w"),
            F.min("close").alias("low_52w"),
        )
    )
    low = round_half_even(pct_change("last_close", "low_52w"), digits)
    high = round_half_even(pct_change("last_close", "high_52w"), digits)
    return bars.withColumn("pct_from_low", low).withColumn("pct_from_high", high)


def perf_52w(daily: DataFrame, as_of=None, k: int | None = 20, digits: int | None = 2):
    """Place in the range of the year up to ``as_of`` (default today)."""
    cutoff = add_years(as_date_col(as_of), -1)
    return top_k(_range_52w(daily, cutoff, digits), "pct_from_low", k)


def scanner_52w(daily: DataFrame, k: int | None = 100, digits: int | None = 2):
    """As ``perf_52w``, with the year counted back from the newest date in the data."""
    cutoff = add_years(newest_date(daily), -1)
    columns = ["ticker", "name", "high_52w", "low_52w", "last_close"]
    out = _range_52w(daily, cutoff, digits).select(*columns, "pct_from_low", "pct_from_high")
    return top_k(out, "pct_from_low", k)


def top_movers_1d(daily: DataFrame, k: int | None = 50, digits: int | None = 2):
    """Change between the two newest dates of the whole market."""
    days = newest_dates(daily, 2).agg(
        F.struct(
            F.max("date").alias("last"),
            F.when(F.count("*") == 2, F.min("date")).alias("prev"),
        ).alias("d")
    ).scalar()
    last, prev = days.getField("last"), days.getField("prev")
    moves = (
        since(daily, F.coalesce(prev, last))
        .filter((F.col("date") == last) | (F.col("date") == prev))
        .groupBy("ticker")
        .agg(
            F.max_by("short_name", "date").alias("name"),
            F.max(F.when(F.col("date") == last, F.col("close"))).alias("close_last"),
            F.max(F.when(F.col("date") == prev, F.col("close"))).alias("close_prev"),
            F.max("date").alias("last_date"),
        )
        .filter("close_last IS NOT NULL AND close_prev IS NOT NULL")
    )
    change = round_half_even(pct_change("close_last", "close_prev"), digits)
    out = moves.select(
        "ticker", "name", "last_date", "close_last", "close_prev", change.alias("pct_change")
    )
    return top_k(out, "pct_change", k)


def volume_surge(daily: DataFrame, days: int = 20, k: int | None = 50, digits: int | None = 2):
    """Volume on the newest date over the mean of the calendar days up to it."""
    last = newest_date(daily)
    on_last = F.col("date") == last
    out = (
        since(daily, F.date_sub(last, days))
        .groupBy("ticker")
        .agg(
            F.max_by("short_name", "date").alias("name"),
            F.max("date").alias("last_date"),
            F.max(F.when(on_last, F.col("volume"))).alias("volume_today"),
            F.avg("volume").alias("vol_20d_avg"),
        )
        .filter("volume_today IS NOT NULL AND vol_20d_avg > 0")
        .withColumn("vol_surge", round_half_even(ratio("volume_today", "vol_20d_avg"), digits))
    )
    return top_k(out, "vol_surge", k)


def gap_scan(daily: DataFrame, k: int = 50, missing: str = "null"):
    """Newest open against the close before it.

    ``missing='zero'`` shows 0 as the close before a ticker's only bar.
    """
    snap = (
        recent(daily, 2)
        .groupBy("ticker")
        .agg(
            _at(1, "short_name").alias("name"),
            _at(1, "date").alias("last_date"),
            _at(1, "open").alias("open_today"),
            or_zero(_at(2, "close"), missing).alias("prev_close"),
        )
        .withColumn("gap_pct", pct_change("open_today", "prev_close"))
    )
    out = _on_latest(snap, _by_metric("gap_pct"), k)
    return out.withColumnRenamed("last_date", "date")


def momentum(daily: DataFrame, spans: tuple[int, ...] = (20, 60), k: int = 100):
    """Close against the close n rows earlier, for each span."""
    past = [_at(n + 1, "close").alias(f"_c{n}") for n in spans]
    snap = (
        recent(daily, max(spans) + 1)
        .groupBy("ticker")
        .agg(
            _at(1, "short_name").alias("name"),
            _at(1, "date").alias("last_date"),
            _at(1, "close").alias("last_close"),
            *past,
        )
    )
    rets = [pct_change("last_close", f"_c{n}").alias(f"ret_{n}d_pct") for n in spans]
    snap = snap.select("ticker", "name", "last_close", "last_date", *rets)
    return _on_latest(snap, _by_metric(f"ret_{spans[0]}d_pct"), k).drop("last_date")


def _last_vs_sma(daily: DataFrame, spans: tuple[int, ...]) -> DataFrame:
    """Newest close with the mean of the newest n closes: a plain conditional mean.

    No rolling frame is needed, because only the last value of each would be kept.
    """
    means = [F.avg(F.when(F.col("rn") <= n, F.col("close"))).alias(f"sma{n}") for n in spans]
    return (
        recent(daily, max(spans))
        .groupBy("ticker")
        .agg(
            _at(1, "short_name").alias("name"),
            _at(1, "date").alias("last_date"),
            _at(1, "close").alias("last_close"),
            *means,
        )
    )


def distance_from_sma(daily: DataFrame, spans: tuple[int, ...] = (50, 200), k: int = 100):
    """Newest close as a distance from its moving means, in percent of the mean."""
    snap = _last_vs_sma(daily, spans)
    dists = [pct_change("last_close", f"sma{n}").alias(f"dist_sma{n}_pct") for n in spans]
    snap = snap.select("*", *dists)
    return _on_latest(snap, _by_metric(f"dist_sma{spans[0]}_pct"), k).drop("last_date")


def breadth(daily: DataFrame, spans: tuple[int, ...] = (50, 200)):
    """Share of tickers whose own last close is above its moving mean (one row)."""
    snap = _last_vs_sma(daily, spans)
    shares = [
        ratio(F.lit(100) * F.count_if(F.col("last_close") > F.col(f"sma{n}")), F.count("*")).alias(
            f"pct_above_{n}d"
        )
        for n in spans
    ]
    return snap.agg(*shares)


def true_range(prev_close: Column) -> Column:
    """Largest of high-low and the two distances from the previous close; NULLs are skipped."""
    high, low = F.col("high"), F.col("low")
    return F.greatest(F.abs(high - low), F.abs(high - prev_close), F.abs(low - prev_close))


def atr_pct(
    daily: DataFrame, n: int = 14, k: int = 100, digits: int | None = 2, missing: str = "null"
):
    """Mean true range of the newest n rows, in percent of the newest close.

    ``missing='zero'`` takes 0 as the close before a ticker's first row.
    """
    bars = recent(daily, n + 1)
    w = Window.partitionBy("ticker").orderBy(F.col("date"))
    tr = true_range(lag_value("close", 1, w, missing))
    snap = (
        bars.withColumn("_tr", tr)
        .groupBy("ticker")
        .agg(
            _at(1, "short_name").alias("name"),
            _at(1, "date").alias("last_date"),
            _at(1, "close").alias("last_close"),
            F.avg(F.when(F.col("rn") <= n, F.col("_tr"))).alias(f"last_atr{n}"),
        )
    )
    pct = round_half_even(F.lit(100) * ratio(f"last_atr{n}", "last_close"), digits)
    out = _on_latest(snap.withColumn(f"atr{n}_pct", pct), _by_metric(f"atr{n}_pct"), k)
    return out.withColumnRenamed("last_date", "date")


def inside_outside_day(daily: DataFrame, k: int = 200):
    """Newest bar against the one before: outside, inside or normal (strict bounds)."""
    snap = (
        recent(daily, 2)
        .groupBy("ticker")
        .agg(
            _at(1, "short_name").alias("name"),
            _at(1, "date").alias("last_date"),
            *[_at(1, c).alias(f"{c}_today") for c in ("open", "high", "low", "close")],
            _at(2, "high").alias("_prev_high"),
            _at(2, "low").alias("_prev_low"),
        )
    )
    above = F.col("high_today") > F.col("_prev_high")
    below = F.col("low_today") < F.col("_prev_low")
    under = F.col("high_today") < F.col("_prev_high")
    over = F.col("low_today") > F.col("_prev_low")
    kind = F.when(above & below, "outside").when(under & over, "inside").otherwise("normal")
    order = F.when(F.col("day_type") == "outside", 1).when(F.col("day_type") == "inside", 2)
    snap = snap.withColumn("day_type", kind).drop("_prev_high", "_prev_low")
    out = _on_latest(snap, [order.otherwise(3), F.col("ticker")], k)
    return out.withColumnRenamed("last_date", "date")


def realised_vol(daily: DataFrame, n: int = 30, ann: int = TRADING_DAYS) -> DataFrame:
    """Series of annualised volatility: NULL until n real returns are in the frame."""
    w = Window.partitionBy("ticker").orderBy("date")
    prev = F.lag("close").over(w)
    ret = ln_positive("close") - ln_positive(prev)
    vol = trailing_std("_ret", n, w, min_periods=n) * F.sqrt(F.lit(ann))
    return daily.withColumn("_ret", ret).withColumn(f"rv{n}", vol).drop("_ret")


def realised_vol_rank(
    daily: DataFrame,
    n: int = 30,
    ann: int = TRADING_DAYS,
    k: int = 100,
    digits: int | None = 2,
):
    """Newest volatility and its percentile among the last year's.

    A ticker's year ends on its last date, which is the market's newest date for
    every ticker that is kept. With a row a day it has at most 367 rows; these and
    the n+1 before them are taken by number, in one pass that Spark limits below
    the exchange. In a table stored by month the year's months are read by date,
    and only the n+1 rows before them by number.
    """
    shown = ["ticker", "short_name", "date", "close"]
    if "ym" in daily.columns:
        first = add_years(newest_date(daily), -1)
        before = recent(daily.filter(F.col("date") < first).select(*shown), n + 1).withColumn("rn", F.lit(0))
        newest_first = Window.partitionBy("ticker").orderBy(F.col("date").desc())
        year = since(daily, first).select(*shown).withColumn("rn", F.row_number().over(newest_first))
        bars = year.unionByName(before)
    else:
        bars = recent(daily.select(*shown), 367 + n + 1)
    vol = f"rv{n}"
    per_ticker = Window.partitionBy("ticker")
    rows = (
        realised_vol(bars, n, ann)
        .withColumn("_current", F.max(F.when(F.col("rn") == 1, F.col(vol))).over(per_ticker))
        .withColumn("last_date", F.max("date").over(per_ticker))
        .filter(F.col("date") >= add_years("last_date", -1))
    )
    # Equal frames may differ in the last bits by the order of their sums.
    not_above = F.coalesce(F.col(vol) <= F.col("_current") * (1 + 1e-12), F.lit(False))
    rank = ratio(F.lit(100) * F.count_if(not_above), F.count("*"))
    snap = rows.groupBy("ticker").agg(
        _at(1, "short_name").alias("name"),
        F.max("last_date").alias("last_date"),
        F.max("_current").alias(vol),
        round_half_even(rank, digits).alias(f"{vol}_rank_1y"),
    )
    return _on_latest(snap, _by_metric(f"{vol}_rank_1y"), k).drop("last_date")


def vix_weekly(
    daily: DataFrame,
    ticker: str = "^VIX",
    weeks: int = 22,
    digits: int | None = 2,
    missing: str = "null",
):
    """Weekly closes of a volatility index with week-on-week changes and a level name.

    ``missing='zero'`` takes 0 as the close before the first week.
    """
    series = daily.filter((F.col("ticker") == ticker) & F.col("date").isNotNull())
    w = Window.partitionBy("ticker").orderBy("week_start")
    if "ym" in daily.columns:
        newest_week = period_start(newest_date(series), "week")
        first = F.date_sub(newest_week, 7 * (weeks - 1))
        # The first week shown is compared with the last one before it, however long ago.
        base = series.filter(F.col("date") < first).agg(F.max("date")).scalar()
        series = since(series, F.coalesce(period_start(base, "week"), first))
    else:
        # One pass: a series has few weeks, so the newest is found among them.
        first = F.date_sub(F.max("week_start").over(Window.partitionBy("ticker")), 7 * (weeks - 1))
    weekly = (
        series.groupBy("ticker", period_start("date", "week").alias("week_start"))
        .agg(
            F.max("date").alias("last_trading_date"),
            F.max_by("close", "date").alias("raw"),
            F.max_by("adj_close", "date").alias("adj"),
        )
    )
    rows = weekly.withColumn("_first", first)
    for kind in ("raw", "adj"):
        now, prev = F.col(kind), lag_value(kind, 1, w, missing)
        known = finite(prev) & finite(now)
        rows = rows.withColumn(f"_net_{kind}", F.when(known, now - prev))
        moved = F.when(known & (now != 0), F.lit(100) * (ratio(now, prev) - 1))
        rows = rows.withColumn(f"_pct_{kind}", moved)
    level = (
        F.when(F.col("raw") < CALM_BELOW, "Calm")
        .when(F.col("raw") < NORMAL_BELOW, "Normal")
        .otherwise("Fear")
    )
    shown = []
    for kind in ("raw", "adj"):
        shown += [
            round_half_even(kind, digits).alias(f"vix_close_{kind}"),
            round_half_even(f"_net_{kind}", digits).alias(f"vix_net_change_{kind}"),
            round_half_even(f"_pct_{kind}", digits).alias(f"vix_pct_change_{kind}_pct"),
        ]
    return rows.filter("week_start >= _first").select(
        "week_start", "last_trading_date", level.alias("vix_regime"), *shown
    )
