"""User-level jobs: refresh, backfill, fundamentals, analytics."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date_col
from ..operators import ingest
from ..operators import quality as dq
from ..operators.fundamentals import latest_restatement
from ..schema import PERIODS, STATEMENTS
from ..session import path_exists, scratch_cleared
from ..sources import listings, tables
from . import registry


@dataclass(frozen=True)
class Warehouse:
    """Where the stored tables live."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def rebuild_bars(spark: SparkSession, store: Warehouse, touched: list[str] | None = None) -> None:
    """Weekly, monthly and quarterly tables: all of them, or what the touched months reach."""
    daily = tables.daily_prices(spark, store.table("daily_prices"))
    for period in PERIODS:
        tables.write_bars(spark, daily, period, store.table(f"{period}ly_prices"), touched)


def _leaves_no_scratch(job):
    """The job inside ``scratch_cleared``: what it writes on the way is removed when it ends or fails."""

    @wraps(job)
    def run(spark: SparkSession, *args, **named):
        with scratch_cleared(spark):
            return job(spark, *args, **named)

    return run


@_leaves_no_scratch
def refresh_market(
    spark: SparkSession,
    raw: DataFrame,
    store: Warehouse,
    tickers: DataFrame | None = None,
    today=None,
    lookback_days: int = ingest.LOOKBACK_DAYS,
    source: str = ingest.DEFAULT_SOURCE,
    ingested_at=None,
) -> list[str]:
    """Reload the overlap window of all tickers at once, then the bars they reach.

    ``tickers`` names those to refresh (default: the ones in ``raw``). A listed
    ticker without new rows still has its window cleared.
    """
    new = ingest.normalise_bars(raw, str(uuid.uuid4()), source, ingested_at)
    if tickers is not None:
        new = new.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    windows = ingest.reload_windows(new if tickers is None else tickers, today, lookback_days)
    day = as_date_col(today)
    new = ingest.clip(new, F.date_sub(day, lookback_days), F.date_add(day, 1))
    touched = tables.upsert_daily(spark, store.table("daily_prices"), new, windows)
    rebuild_bars(spark, store, touched)
    return touched


@_leaves_no_scratch
def backfill_market(
    spark: SparkSession,
    raw: DataFrame,
    store: Warehouse,
    start: str | None = ingest.BACKFILL_START,
    source: str = ingest.DEFAULT_SOURCE,
    ingested_at=None,
) -> list[str]:
    """Reload whole histories from ``start`` (None: all there is), then rebuild the bars."""
    new = ingest.normalise_bars(raw, str(uuid.uuid4()), source, ingested_at)
    new = ingest.clip(new, start)
    touched = tables.upsert_daily(spark, store.table("daily_prices"), new)
    rebuild_bars(spark, store)
    return touched


@_leaves_no_scratch
def refresh_fundamentals(
    spark: SparkSession,
    frames: dict[str, dict[str, DataFrame]],
    store: Warehouse,
    tickers: list[str] | None = None,
    labels: dict[str, str] | None = None,
    source: str = ingest.DEFAULT_SOURCE,
    loaded_at=None,
) -> dict[str, DataFrame]:
    """Melt and append the statements, then return long, wide and ratio frames.

    ``frames`` maps a statement to its ``A`` (annual) and ``Q`` (quarterly) wide
    frames. Rows without key and cells that cannot be read go to the table
    ``statement_rejects``, with their text and the load's ``batch_id``, and stop nothing.
    """
    batch_id = str(uuid.uuid4())
    for statement in STATEMENTS:
        sides = []
        for period in ("A", "Q"):
            wide = frames.get(statement, {}).get(period)
            if wide is None:
                continue
            if tickers is not None:
                wide = wide.filter(F.col("ticker").isin(list(tickers)))
            sides.append(ingest.statement_cells(wide, period, labels, source, loaded_at))
        if not sides:
            continue
        ledger = ingest.combine_statements(*(sides + [None])[:2])
        good, rejected = ingest.split_rejects(ledger)
        tables.append_statements(good.drop("raw"), store.table(statement), batch_id)
        rejected = rejected.withColumn("statement", F.lit(statement)).withColumn("batch_id", F.lit(batch_id))
        rejected.write.mode("append").parquet(store.table("statement_rejects"))
    ledgers = {
        s: latest_restatement(tables.statements(spark, store.table(s), "Q").drop("fiscal_ym"))
        for s in STATEMENTS
        if path_exists(spark, store.table(s))
    }
    return registry.build(ledgers)


def stored_frames(spark: SparkSession, store: Warehouse) -> dict[str, DataFrame]:
    """The stored tables of a warehouse: daily prices, bars of all periods, statement ledgers."""
    frames = {"daily_prices": tables.daily_prices(spark, store.table("daily_prices"))}
    for period in PERIODS:
        path = store.table(f"{period}ly_prices")
        if path_exists(spark, path):
            frames[f"{period}ly_prices"] = tables.read_bars(spark, path, period)
    for statement in STATEMENTS:
        path = store.table(statement)
        if path_exists(spark, path):
            quarterly = tables.statements(spark, path, "Q").drop("fiscal_ym")
            frames[statement] = latest_restatement(quarterly)
    return frames


def build_analytics(
    daily: DataFrame | dict[str, DataFrame],
    ledgers: dict[str, DataFrame] | None = None,
    publish: bool = False,
) -> dict[str, DataFrame]:
    """Every dataset as a lazy frame over stored tables (``stored_frames``, or the daily table alone).

    What is stored is read and not computed again. Nothing is cached: each
    dataset reads only its own columns.
    """
    given = daily if isinstance(daily, dict) else {"daily_prices": daily}
    frames = registry.build({**given, **(ledgers or {})})
    if publish:
        tables.publish_views(frames)
    return frames


def validate_exchanges(
    spark: SparkSession,
    vendor: DataFrame,
    lists: dict[str, list[str]] | None = None,
    keywords: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Listed tickers whose vendor exchange is not the one they are listed under.

    ``vendor`` has (ticker, full_exchange_name, exchange_code); lists and words are those
    of ``listings`` unless given. A ticker counts under the first list that has it.
    """
    universe = ingest.ticker_universe(listings.listing_rows(spark, lists))
    words = keywords or listings.EXCHANGE_KEYWORDS
    return dq.exchange_mismatches(universe, vendor, words, listings.KNOWN_EXCEPTIONS)


def check_report(frames: dict[str, DataFrame], as_of=None) -> DataFrame:
    """(check_name, failures, status) for every check that applies to the frames, computed now.

    One pass over each dataset gives all its checks, also the age of the newest load of daily
    prices (against ``as_of``, default now). The report has a row a check and reads nothing
    any more, so stores and scratch folders may go.
    """
    return dq.finished(reduce(DataFrame.unionByName, registry.checks(frames, as_of)))
