"""From landed vendor files to the base-table contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date_col, null_blank
from ..schema import DAILY_COLUMNS, PRICE_COLUMNS

# Vendor spellings (compared without case, blanks and '_') of the contract columns.
VENDOR_NAMES = {
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
    "adjclose": "adj_close",
    "volume": "volume",
    "date": "date",
    "tradedate": "date",
    "datetime": "date",
    "ticker": "ticker",
    "symbol": "ticker",
    "shortname": "short_name",
}

DEFAULT_SOURCE = "vendor"
BACKFILL_START = "1999-12-31"
LOOKBACK_DAYS = 21


def canonical_columns(raw: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Known columns under their contract names; all others are dropped.

    When two spellings of one column are present, the first that is not NULL
    counts, row by row.
    """
    names = names or VENDOR_NAMES
    found: dict[str, list[str]] = {}
    for c in raw.columns:
        target = names.get(c.lower().replace(" ", "").replace("_", ""))
        if target:
            found.setdefault(target, []).append(c)
    return raw.select(
        *[F.coalesce(*[F.col(f"`{c}`") for c in cs]).alias(t) for t, cs in found.items()]
    )


def flatten_two_level(wide: DataFrame, id_column: str = "date", sep: str = "__") -> DataFrame:
    """Columns named field__ticker to one row per (id, ticker) with the fields as columns.

    Each row becomes an array of per-ticker structs and is exploded in place:
    no shuffle, and only as many output rows as the input has cells.
    """
    cells: dict[str, dict[str, str]] = {}
    fields: list[str] = []
    for c in wide.columns:
        if sep not in c:
            continue
        field, ticker = c.split(sep, 1)
        cells.setdefault(ticker, {})[field] = c
        if field not in fields:
            fields.append(field)
    rows = [
        F.struct(
            F.lit(t).alias("ticker"),
            *[(F.col(f"`{at[f]}`") if f in at else F.lit(None)).alias(f) for f in fields],
        )
        for t, at in cells.items()
    ]
    return wide.select(id_column, F.inline(F.array(*rows)))


def trading_date(ts: Column, exchange_tz: str | None = None) -> Column:
    """Calendar day of an instant: in UTC, or in the exchange's own zone when given.

    Text with an offset is an instant; a plain date or local time is taken as UTC,
    which has to be the session's time zone.
    """
    at = ts.try_cast("timestamp")
    return F.to_date(F.from_utc_timestamp(at, exchange_tz) if exchange_tz else at)


def clip(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Rows from start to end, both days included; either may be open."""
    if start is not None:
        df = df.filter(F.col(column) >= as_date_col(start))
    if end is not None:
        df = df.filter(F.col(column) < F.date_add(as_date_col(end), 1))
    return df


def display_name(short: str, long: str, symbol: str, ticker: str) -> Column:
    """First name that is not blank, ending with the ticker itself."""
    return F.coalesce(*[null_blank(c) for c in (short, long, symbol)], F.col(ticker))


def currency_or_blank(currency: str, financial: str) -> Column:
    return F.coalesce(null_blank(currency), null_blank(financial), F.lit(""))


def stamp(df: DataFrame, batch_id: str, source: str = DEFAULT_SOURCE, at=None) -> DataFrame:
    """Lineage columns: load time, run id, upstream name."""
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return (
        df.withColumn("ingested_at", now)
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("source", F.lit(source))
    )


def normalise_bars(
    raw: DataFrame,
    batch_id: str,
    source: str = DEFAULT_SOURCE,
    ingested_at=None,
    exchange_tz: str | None = None,
    landed: str | None = None,
) -> DataFrame:
    """Raw bars of all tickers to the daily contract, in one projection and one filter.

    The load time is ``ingested_at`` (default: now), or row by row the raw column
    ``landed``. Unreadable prices become NULL and an unreadable volume 0; rows without a
    ticker, without a date or without any price are dropped.
    """
    if landed:
        raw = raw.withColumnRenamed(landed, "_landed")
    df = canonical_columns(raw, VENDOR_NAMES | ({"landed": "_landed"} if landed else {}))
    have = set(df.columns)
    if not {"ticker", "date"} <= have:
        raise ValueError("raw bars need a ticker and a date column")

    date = F.col("date")
    if not isinstance(df.schema["date"].dataType, T.DateType):
        date = trading_date(date, exchange_tz)
    prices = [
        (F.col(c).try_cast("double") if c in have else F.lit(None).cast("double")).alias(c)
        for c in PRICE_COLUMNS
    ]
    volume = F.col("volume").try_cast("double") if "volume" in have else F.lit(None).cast("double")
    name = null_blank(F.col("short_name")) if "short_name" in have else F.lit(None).cast("string")
    out = df.select(
        "ticker",
        F.coalesce(name, F.col("ticker")).alias("short_name"),
        date.alias("date"),
        *[F.when(~F.isnan(p), p).alias(c) for p, c in zip(prices, PRICE_COLUMNS)],
        F.coalesce(F.when(~F.isnan(volume), volume), F.lit(0.0)).cast("bigint").alias("volume"),
        *([F.col("_landed").cast("timestamp").alias("_landed")] if landed else []),
    )
    out = out.filter("ticker IS NOT NULL AND date IS NOT NULL").dropna("all", subset=PRICE_COLUMNS)
    stamped = stamp(out, batch_id, source, ingested_at)
    if landed:
        stamped = stamped.withColumn("ingested_at", F.col("_landed"))
    return stamped.select(*DAILY_COLUMNS)


def reload_windows(tickers: DataFrame, today=None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One window per ticker, from ``lookback_days`` back to tomorrow.

    It is cleared also for a ticker that delivers no new rows.
    """
    day = as_date_col(today)
    return tickers.select("ticker").distinct().select(
        "ticker",
        F.date_sub(day, lookback_days).alias("start_date"),
        F.date_add(day, 1).alias("end_date"),
    )


def batch_windows(new: DataFrame) -> DataFrame:
    """One window per ticker, from its first to its last new date."""
    return new.groupBy("ticker").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )


def overlap_reload(old: DataFrame, new: DataFrame, windows: DataFrame) -> DataFrame:
    """Old rows outside the windows plus the new rows; applying it twice changes nothing.

    An equi anti join on ticker with the date range as a further condition.
    Which side is broadcast, if any, is left to the sizes Spark measures.
    """
    w = windows.select(F.col("ticker").alias("_t"), "start_date", "end_date")
    inside = (F.col("ticker") == F.col("_t")) & F.col("date").between(
        F.col("start_date"), F.col("end_date")
    )
    return old.join(w, inside, "left_anti").unionByName(new.select(*old.columns))


def tagged_reload(
    rows: DataFrame, fresh: str = "is_new", start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """The same over one frame of old and new rows, which is read once.

    ``fresh`` tells new rows (true) from old ones (false); a row without it carries only
    bounds. A ticker's window reaches from its smallest ``start`` to its largest
    ``end``, on whatever rows they stand; its old rows inside go. One
    aggregation by ticker gathers bounds and rows: a history has at most a row a day.
    """
    shown = [c for c in rows.columns if c not in (fresh, start, end)]
    row = F.struct(F.col(fresh).alias("_new"), *shown)
    gathered = rows.groupBy("ticker").agg(
        F.min(start).alias("_start"),
        F.max(end).alias("_end"),
        F.collect_list(F.when(F.col(fresh).isNotNull(), row)).alias("_rows"),
    )
    inside = lambda r: r["date"].between(F.col("_start"), F.col("_end")) & r["ticker"].isNotNull()
    kept = F.filter("_rows", lambda r: r["_new"] | ~F.coalesce(inside(r), F.lit(False)))
    return gathered.select(F.inline(kept)).select(*shown)


def backfill_reload(old: DataFrame, new: DataFrame) -> DataFrame:
    """Reload of whole histories: each ticker's window is what its new rows cover."""
    return overlap_reload(old, new, batch_windows(new))


def melt_statement(
    wide: DataFrame,
    period: str,
    labels: dict[str, str] | None = None,
    source: str = DEFAULT_SOURCE,
    loaded_at=None,
    ids: tuple[str, ...] = ("ticker", "metric", "currency"),
) -> DataFrame:
    """Statement frames (a row per metric, a column per fiscal date) to ledger rows.

    Cells that cannot be read are left out here; ``statement_cells`` keeps them.
    """
    cells = statement_cells(wide, period, labels, source, loaded_at, ids)
    return split_rejects(cells)[0].drop("raw")


def statement_cells(
    wide: DataFrame,
    period: str,
    labels: dict[str, str] | None = None,
    source: str = DEFAULT_SOURCE,
    loaded_at=None,
    ids: tuple[str, ...] = ("ticker", "metric", "currency"),
) -> DataFrame:
    """All cells of statement frames that hold something, as ledger rows with the text they held.

    An unreadable value or date is NULL beside its text in ``raw`` ("date: value").
    """
    dates = [c for c in wide.columns if c not in ids]
    cells = wide.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in dates])
    metric = F.col("metric")
    for old_label, new_label in (labels or {}).items():
        metric = F.when(F.col("metric") == old_label, new_label).otherwise(metric)
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return (
        cells.unpivot(list(ids), dates, "fiscal_date", "value")
        .filter("trim(value) <> '' AND lower(trim(value)) <> 'nan'")
        .select(
            "ticker",
            F.col("fiscal_date").try_cast("date").alias("fiscal_date"),
            F.lit(period).alias("period"),
            metric.alias("metric"),
            F.col("value").try_cast("double").alias("value"),
            F.coalesce("currency", F.lit("")).alias("currency"),
            F.lit(source).alias("source"),
            now.alias("loaded_at"),
            F.concat_ws(": ", "fiscal_date", "value").alias("raw"),
        )
    )


def combine_statements(annual: DataFrame | None, quarterly: DataFrame | None) -> DataFrame:
    """Annual and quarterly ledger rows as one table; a missing side is skipped."""
    sides = [s for s in (annual, quarterly) if s is not None]
    if not sides:
        raise ValueError("no statement given")
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def split_rejects(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) ledger rows, so that one bad ticker or cell does not stop the rest."""
    good = F.expr(
        "ticker IS NOT NULL AND fiscal_date IS NOT NULL AND metric IS NOT NULL AND value IS NOT NULL"
    )
    return ledger.filter(good), ledger.filter(~good)


def ticker_universe(listings: DataFrame) -> DataFrame:
    """(ticker, exchange, priority, pos): each ticker once, under the exchange that lists it first.

    ``listings`` has (exchange, priority, pos, ticker); each task sends on one
    candidate per ticker.
    """
    first = F.min(F.struct("priority", "pos", "exchange"))
    found = listings.groupBy("ticker").agg(first.alias("_f"))
    parts = ("exchange", "priority", "pos")
    return found.select("ticker", *[F.col(f"_f.{c}").alias(c) for c in parts])


def tail(df: DataFrame, n: int = 10, key: str = "date", ticker: str | None = None) -> DataFrame:
    """Newest n rows, of one ticker or of all."""
    rows = df if ticker is None else df.filter(F.col("ticker") == ticker)
    return rows.orderBy(F.col(key).desc(), "ticker").limit(n)
