"""One-year correlations of daily log returns between two lists of tickers.

The focal returns are laid out as one row per date and block of focal tickers. That
table is bounded by the calendar year times the focal list, so it can be
broadcast; each universe row then meets one row of it a block and no pair of
rows is ever emitted. The universe is aggregated where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_date_col, or_zero, ratio, round_half_even, since

#: Focal tickers a block: one row of sums holds so many correlations.
FOCAL_BLOCK = 100


def log_returns(
    daily: DataFrame, tickers: list[str] | None, as_of, months: int = 12
) -> DataFrame:
    """Daily log returns in the last ``months``; one more month is read for the first base."""
    if tickers is not None:
        daily = daily.filter(F.col("ticker").isin(list(tickers)))
    day = as_date_col(as_of)
    w = Window.partitionBy("ticker").orderBy("date")
    return (
        since(daily, F.add_months(day, -(months + 1)))
        .filter(F.col("adj_close") > 0)
        .select("ticker", "date", "adj_close")
        .withColumn("ret", F.ln(ratio("adj_close", F.lag("adj_close").over(w))))
        .filter((F.col("date") >= F.add_months(day, -months)) & F.col("ret").isNotNull())
        .select("ticker", "date", "ret")
    )


def _corr(x: str, y: str) -> Column:
    """Pearson correlation that is NULL, not an error, for a constant series."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_pairs(
    daily: DataFrame,
    focal: list[str],
    universe: list[str] | None,
    as_of=None,
    min_obs: int = 150,
) -> DataFrame:
    """(ticker_a, ticker_b, corr_1y, n_obs) for focal x universe with enough common days.

    ``universe=None`` compares with every ticker of the table. The year is read once, however
    long the focal list: a row a day and block of focal tickers holds their returns as an
    array, and each universe row adds its products to one row of sums a block.
    """
    focal = list(dict.fromkeys(focal))
    names = F.array(*[F.lit(t) for t in focal]).cast("array<string>")
    read = None if universe is None else list(dict.fromkeys([*universe, *focal]))
    # both sides are this frame, whose shuffle Spark makes once
    returns = log_returns(daily.filter("ticker IS NOT NULL AND date IS NOT NULL"), read, as_of)
    width = min(FOCAL_BLOCK, max(1, len(focal)))
    slots = [F.max(F.when(F.col("slot") == j, F.col("ret"))) for j in range(width)]
    # a condition on the return too stays above the shuffle
    wide = returns.filter(F.when(F.col("ticker").isin(focal), F.col("ret")).isNotNull())
    place = F.array_position(names, F.col("ticker")) - 1
    wide = wide.select("date", "ret", F.floor(place / FOCAL_BLOCK).alias("block"), (place % FOCAL_BLOCK).alias("slot"))
    # a row a day of one year for each hundred focal tickers
    wide = wide.groupBy("date", "block").agg(F.array(*slots).alias("focal"))
    held = [F.col("focal")[j].alias(f"f{j}") for j in range(width)]
    met = returns.join(F.broadcast(wide), "date").select("ticker", "ret", "block", *held)
    cells = [F.struct(F.lit(j).alias("slot"), _corr(f"f{j}", "ret").alias("corr_1y"), F.count(f"f{j}").alias("n_obs")) for j in range(width)]
    sums = met.groupBy(F.col("ticker").alias("ticker_b"), "block").agg(F.array(*cells).alias("cells"))
    pairs = sums.select("ticker_b", "block", F.inline("cells")).filter(F.col("n_obs") >= min_obs)
    if universe is not None and not set(focal) <= set(universe):
        pairs = pairs.filter(F.col("ticker_b").isin(list(universe)))
    name = F.get(names, (F.col("block") * FOCAL_BLOCK + F.col("slot")).cast("int"))
    return pairs.select(name.alias("ticker_a"), "ticker_b", "corr_1y", "n_obs")


def correlation_matrix(
    daily: DataFrame,
    focal: list[str],
    universe: list[str],
    columns: list[str] | None = None,
    as_of=None,
    min_obs: int = 150,
    digits: int | None = 3,
    missing: str = "null",
) -> DataFrame:
    """One row per focal ticker, one column per ticker in ``columns`` (default: the universe).

    A pair without enough common days is NULL, or 0 with ``missing='zero'``.
    """
    pairs = correlation_pairs(daily, focal, universe, as_of, min_obs)
    cells = []
    for t in columns or universe:
        cell = round_half_even(F.max(F.when(F.col("ticker_b") == t, F.col("corr_1y"))), digits)
        cells.append(or_zero(cell, missing).alias(t))
    return pairs.groupBy("ticker_a").agg(*cells)
