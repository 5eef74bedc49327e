"""Every operator as a query over the sample tables: name -> (spark, folder) -> DataFrame.

Doubles are shown with six decimals, which hides only the order in which sums
were taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import (
    bars,
    correlation,
    fundamentals,
    ingest,
    metrics,
    quality,
    regimes,
    relational,
    signals,
)
from ..operators.fundamentals import METRICS
from ..session import clear_scratch, scratch_cleared, scratch_path, stream_session
from ..sources import samples, tables
from ..sources.samples import table
from ..streaming import start_ingest, weekly_bars_stream
from . import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAILY_SHOWN = ["ticker", "short_name", "date", "open", "high", "low", "close", "adj_close", "volume"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def six(df: DataFrame) -> DataFrame:
    """Doubles with six decimals, half to even; NaN, infinities and large values stay as they are."""
    return df.select(
        *[
            (F.rint(F.col(f"`{f.name}`") * 1e6) / 1e6).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(make: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return six(make(spark, sf_dir))

    run.__doc__ = make.__doc__
    QUERIES[make.__name__] = run
    return make


def _brands(spark, d) -> list[str]:
    """All tickers, the shortest names first: the list parameters of the correlations."""
    brands = table(spark, d, "part").select("p_brand").distinct()
    return sorted((r.p_brand for r in brands.collect()), key=lambda b: (len(b), b))


def _weekly(spark, d):
    return bars.weekly_bars(samples.daily_prices(spark, d), stamp=False)


def _monthly(spark, d):
    return bars.monthly_bars(samples.daily_prices(spark, d), stamp=False)


def _quarterly(spark, d):
    return bars.quarterly_bars(samples.daily_prices(spark, d), stamp=False)


def _newest(df: DataFrame, column: str = "date"):
    return df.agg(F.max(column)).scalar()


# --- bars -------------------------------------------------------------------


@query
def daily_bars(spark, d):
    return samples.daily_prices(spark, d).select(*DAILY_SHOWN)


@query
def weekly_bars(spark, d):
    return _weekly(spark, d)


@query
def monthly_bars(spark, d):
    return _monthly(spark, d)


@query
def quarterly_bars(spark, d):
    return _quarterly(spark, d)


@query
def latest_load(spark, d):
    copies = samples.restated(samples.daily_prices(spark, d))
    return bars.latest_load(copies).select(*DAILY_SHOWN)


@query
def iso_calendar(spark, d):
    """Calendar expressions over all trading days."""
    day = F.col("date")
    days = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return (
        days.groupBy("date")
        .agg(F.count("*").alias("n_items"))
        .select(
            "date",
            "n_items",
            fn.iso_year(day).cast("int").alias("iso_year"),
            fn.iso_week(day).alias("iso_week"),
            fn.period_start(day, "week").alias("week_start"),
            fn.period_start(day, "month").alias("month_start"),
            fn.period_start(day, "quarter").alias("quarter_start"),
            fn.add_years(day, -1).alias("year_before"),
            fn.year_month(day).alias("ym"),
        )
    )


# --- screens ----------------------------------------------------------------


@query
def perf_52w(spark, d):
    daily = samples.daily_prices(spark, d)
    return signals.perf_52w(daily, as_of=_newest(daily), digits=None)


@query
def top_movers_1d(spark, d):
    return signals.top_movers_1d(samples.daily_prices(spark, d), digits=None)


@query
def volume_surge(spark, d):
    return signals.volume_surge(samples.daily_prices(spark, d), digits=None)


@query
def gap_scan(spark, d):
    return signals.gap_scan(samples.daily_prices(spark, d))


@query
def momentum(spark, d):
    return signals.momentum(samples.daily_prices(spark, d))


@query
def distance_from_sma(spark, d):
    return signals.distance_from_sma(samples.daily_prices(spark, d))


@query
def breadth(spark, d):
    return signals.breadth(samples.daily_prices(spark, d))


@query
def scanner_52w(spark, d):
    return signals.scanner_52w(samples.daily_prices(spark, d), digits=None)


@query
def atr_pct(spark, d):
    return signals.atr_pct(samples.daily_prices(spark, d), digits=None)


@query
def inside_outside_day(spark, d):
    return signals.inside_outside_day(samples.daily_prices(spark, d))


@query
def realised_vol_rank(spark, d):
    return signals.realised_vol_rank(samples.daily_prices(spark, d), digits=None)


@query
def vix_weekly(spark, d):
    return signals.vix_weekly(samples.index_prices(spark, d), samples.INDEX_TICKER, digits=None)


@query
def trailing_windows(spark, d):
    """Lags, moving means and deviations as full series."""
    w = Window.partitionBy("ticker").orderBy("date")
    return samples.daily_prices(spark, d).select(
        "ticker",
        "date",
        "close",
        fn.lag_value("close", 1, w).alias("close_1"),
        fn.lag_value("close", 20, w).alias("close_20"),
        fn.lag_value("close", 60, w, missing="zero").alias("close_60_or_0"),
        fn.trailing_mean("close", 50, w).alias("sma50"),
        fn.trailing_mean("close", 20, w, include_current=False).alias("prior_mean20"),
        fn.trailing_std("close", 20, w, include_current=False).alias("prior_std20"),
        fn.trailing_mean("close", 30, w, min_periods=30).alias("full_mean30"),
    )


@query
def series_tail(spark, d):
    return ingest.tail(samples.daily_prices(spark, d), 10, ticker="Brand#7").select(*DAILY_SHOWN)


# --- regimes, metrics, correlation --------------------------------------------


@query
def regime_daily(spark, d):
    copies = samples.restated(samples.daily_prices(spark, d))
    return regimes.regime_daily(copies, digits=None)


@query
def regime_weekly(spark, d):
    return regimes.regime_weekly(_weekly(spark, d), digits=None)


@query
def regime_monthly(spark, d):
    return regimes.regime_monthly(_monthly(spark, d), digits=None)


@query
def regime_quarterly(spark, d):
    return regimes.regime_quarterly(_quarterly(spark, d), digits=None)


@query
def return_metrics_weekly(spark, d):
    return metrics.return_metrics_weekly(_weekly(spark, d))


@query
def return_metrics_monthly(spark, d):
    return metrics.return_metrics_monthly(_monthly(spark, d))


@query
def return_metrics_quarterly(spark, d):
    return metrics.return_metrics_quarterly(_quarterly(spark, d))


@query
def correlation_pairs(spark, d):
    daily, brands = samples.daily_prices(spark, d), _brands(spark, d)
    return correlation.correlation_pairs(daily, brands[:5], brands, _newest(daily), min_obs=30)


@query
def correlation_matrix(spark, d):
    daily, brands = samples.daily_prices(spark, d), _brands(spark, d)
    return correlation.correlation_matrix(
        daily, brands[:5], brands, as_of=_newest(daily), min_obs=30, digits=None
    )


# --- as published: rounded to the default digits ---------------------------------


@query
def scanner_52w_rounded(spark, d):
    return signals.scanner_52w(samples.daily_prices(spark, d))


@query
def atr_pct_rounded(spark, d):
    return signals.atr_pct(samples.daily_prices(spark, d)).select("ticker", "atr14_pct")


@query
def vix_weekly_rounded(spark, d):
    return signals.vix_weekly(samples.index_prices(spark, d), samples.INDEX_TICKER)


@query
def correlation_matrix_rounded(spark, d):
    daily, brands = samples.daily_prices(spark, d), _brands(spark, d)
    return correlation.correlation_matrix(daily, brands[:5], brands, as_of=_newest(daily), min_obs=30)


# --- fundamentals -------------------------------------------------------------


def _long(spark, d):
    return fundamentals.fundamentals_long(*samples.ledgers(spark, d))


@query
def fundamentals_long(spark, d):
    return _long(spark, d).drop("loaded_at")


@query
def fundamentals_wide(spark, d):
    return fundamentals.fundamentals_wide(_long(spark, d))


@query
def key_ratios_wide(spark, d):
    return fundamentals.key_ratios_wide(fundamentals.fundamentals_wide(_long(spark, d)))


@query
def key_ratios_long(spark, d):
    return fundamentals.key_ratios_long(fundamentals.fundamentals_wide(_long(spark, d)))


@query
def latest_restatement(spark, d):
    """Income lines with a later copy of each first-quarter line, 100 higher."""
    ledger = samples.statement(spark, d, "income_statement")
    later = ledger.filter(F.month("fiscal_date") == 3).withColumn("value", F.col("value") + 100)
    later = later.withColumn("loaded_at", F.lit("2002-03-01 00:00:00").cast("timestamp"))
    annual = ledger.withColumn("period", F.lit("A"))
    copies = ledger.unionByName(later).unionByName(annual)
    return fundamentals.latest_restatement(copies).drop("loaded_at")


# --- ingest -------------------------------------------------------------------


def _raw_bars(spark, d) -> DataFrame:
    """Line items dressed up as vendor rows, with two spellings and unreadable cells."""
    price = F.col("l_extendedprice").cast("string")
    open_ = F.when(F.col("l_tax") == 0.08, "n/a").otherwise(price)
    gone = F.col("l_returnflag") == "N"
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("Symbol"),
        F.when(F.col("l_linenumber") == 6, "soon")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("Date"),
        F.when(~gone, open_).alias("Open"),
        F.when(~gone & (F.col("l_linestatus") == "F"), price).alias("High"),
        F.when(~gone, F.col("l_tax").cast("string")).alias("Low"),
        F.when(~gone, price).alias("Close"),
        F.when(~gone & (F.col("l_linenumber") <= 3), F.col("l_discount")).alias("Adj close"),
        F.when(~gone & (F.col("l_linenumber") > 3), F.col("l_quantity")).alias("AdjClose"),
        F.when(F.col("l_discount") == 0.1, "none")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("Volume"),
        F.lit("ignored").alias("Dividends"),
    )


@query
def normalise_bars(spark, d):
    out = ingest.normalise_bars(_raw_bars(spark, d), "b1", "feed", samples.LOADED_AT)
    return out.drop("ingested_at")


@query
def flatten_two_level(spark, d):
    """Per-day columns field__flag, laid flat."""
    day = F.col("l_shipdate").cast("date").alias("date")
    cells = []
    for flag in ("A", "N", "R"):
        mine = F.col("l_returnflag") == flag
        cells.append(F.max(F.when(mine, F.col("l_extendedprice"))).alias(f"Close__{flag}"))
        cells.append(F.sum(F.when(mine, F.col("l_quantity"))).alias(f"Volume__{flag}"))
    wide = table(spark, d, "lineitem").groupBy(day).agg(*cells)
    return ingest.flatten_two_level(wide)


@query
def clip_range(spark, d):
    daily = samples.daily_prices(spark, d)
    return ingest.clip(daily, "1996-02-29", "1997-02-28").select(*DAILY_SHOWN)


@query
def sample_price_table(spark, d):
    """The flat shape with its own date name, taken in through the vendor names."""
    flat = samples.daily_prices(spark, d).select(
        "ticker", F.col("date").alias("trade_date"), "open", "high", "low", "close", "volume"
    )
    out = ingest.normalise_bars(flat, "b1", "feed", samples.LOADED_AT)
    return out.select(*DAILY_SHOWN)


@query
def as_of_today(spark, d):
    """Bounds that default to today: the year that a screen reads, and the age of the newest order."""
    newest = table(spark, d, "orders").agg(F.max(F.col("o_orderdate").cast("date")).alias("newest_order"))
    today = fn.as_date_col(None)
    return newest.select(
        "newest_order",
        (today == F.current_date()).alias("is_today"),
        today.alias("today"),
        fn.add_years(today, -1).alias("year_start"),
        F.date_diff(today, "newest_order").cast("bigint").alias("age_days"),
    )


@query
def trading_dates(spark, d):
    """Trading day of each event instant in UTC and in two exchange zones."""
    at = F.col("ts").cast("timestamp")
    days = table(spark, d, "events").select(
        ingest.trading_date(at).alias("utc_day"),
        ingest.trading_date(at, "Asia/Tokyo").alias("tokyo_day"),
        ingest.trading_date(at, "America/New_York").alias("new_york_day"),
    )
    return days.groupBy("utc_day", "tokyo_day", "new_york_day").agg(F.count("*").alias("n"))


@query
def overlap_reload(spark, d):
    """The last 21 days again, one higher and without Brand#3, which only loses its rows."""
    daily = samples.daily_prices(spark, d).select(*DAILY_SHOWN)
    newest = _newest(daily)
    again = (F.col("date") >= F.date_sub(newest, 21)) & (F.col("ticker") != "Brand#3")
    rows = _with_again(daily, again, adj_close=F.col("adj_close") + 1)
    rows = rows.withColumn("start_date", F.date_sub(newest, 21)).withColumn("end_date", F.date_add(newest, 1))
    return ingest.tagged_reload(rows)


def _with_again(daily: DataFrame, again, **changed) -> DataFrame:
    """Every row as an old one, and those of ``again`` a second time as new ones with changed columns."""
    sides = F.when(again, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = daily.withColumn("is_new", F.explode(sides))
    return rows.withColumns({c: F.when(F.col("is_new"), e).otherwise(F.col(c)) for c, e in changed.items()})


@query
def backfill_reload(spark, d):
    """Two middle years again for the longer ticker names; rows between a ticker's ends go."""
    daily = samples.daily_prices(spark, d).select(*DAILY_SHOWN)
    again = F.expr("date between '1997-01-01' and '1998-12-31' and length(ticker) = 8 and day(date) <> 15")
    rows = _with_again(daily, again, volume=F.col("volume") + 1)
    covered = F.when(F.col("is_new"), F.col("date"))
    return ingest.tagged_reload(rows.withColumn("start_date", covered).withColumn("end_date", covered))


def _annual_frame(spark, d) -> DataFrame:
    """Statement frame: a row per ticker and metric, a column per fiscal year end."""
    cents = samples.whole(F.col("l_extendedprice") * 100)
    year = F.year(F.col("l_shipdate").cast("date"))
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    items = table(spark, d, "lineitem")
    years = sorted(r.y for r in items.select(year.alias("y")).distinct().collect() if r.y)
    cells = [(F.sum(F.when(year == y, cents)) / 100).alias(f"{y}-12-31") for y in years]
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("ticker"), F.col("l_returnflag").alias("metric"))
        .agg(*cells)
        .withColumn("currency", F.lit("USD"))
    )


LABELS = {"A": "Total Revenue", "R": "Cost Of Revenue"}


@query
def melt_statement(spark, d):
    out = ingest.melt_statement(_annual_frame(spark, d), "A", LABELS, "feed", samples.LOADED_AT)
    return out.drop("loaded_at")


@query
def combine_statements(spark, d):
    annual = ingest.melt_statement(
        _annual_frame(spark, d), "A", LABELS, "sample", samples.LOADED_AT
    )
    quarterly = samples.statement(spark, d, "income_statement")
    return ingest.combine_statements(annual, quarterly).drop("loaded_at")


def _listings(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("exchange"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"),
    )


@query
def ticker_universe(spark, d):
    return ingest.ticker_universe(_listings(spark, d))


@query
def display_names(spark, d):
    short = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_name")).otherwise("")
    long = F.when(F.col("c_nationkey") % 2 == 0, F.concat("c_mktsegment", F.lit(" "), "c_name"))
    symbol = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("S"), "c_custkey")).otherwise("")
    meta = table(spark, d, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("ticker"),
        short.alias("short_name"),
        long.alias("long_name"),
        symbol.alias("symbol"),
        F.when(F.col("c_nationkey") < 10, "USD").otherwise("").alias("currency"),
        F.when(F.col("c_nationkey") < 20, "EUR").alias("financial"),
    )
    return meta.select(
        "ticker",
        ingest.display_name("short_name", "long_name", "symbol", "ticker").alias("name"),
        ingest.currency_or_blank("currency", "financial").alias("currency"),
    )


# --- relational helpers ---------------------------------------------------------


@query
def star_prefix(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(*relational.star(orders, ["O_ORDERDATE", "o_totalprice"], "x_", "_y"))


@query
def blank_to_null(spark, d):
    customer = table(spark, d, "customer")
    segment = F.when(F.col("c_nationkey") < 5, "").otherwise(F.col("c_mktsegment"))
    return relational.blank_to_null(customer.withColumn("c_mktsegment", segment))


@query
def deduplicate(spark, d):
    """One line per (order, line number): the dearest, then by part, supplier and the rest."""
    order = [F.col("l_extendedprice").desc()]
    order += ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
    order += ["l_returnflag", "l_linestatus", "l_shipdate"]
    rows = relational.deduplicate(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order
    )
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query
def ordered_distinct(spark, d):
    return relational.ordered_distinct(_listings(spark, d), "ticker", "pos")


@query
def column_values(spark, d):
    orders = table(spark, d, "orders")
    return relational.column_values(orders, "o_custkey", max_records=20, where="o_totalprice > 1e5")


@query
def pivot_cells(spark, d):
    """Counts by priority, money above and below a status, distinct customers."""
    many = relational.pivot_cells("o_orderpriority", PRIORITIES, prefix="n_")
    money = relational.pivot_cells(
        "o_orderstatus", ["F"], agg="max", cmp="<>", prefix="top_not_",
        then_value=F.col("o_totalprice"), else_value=F.lit(0.0),
    )
    people = relational.pivot_cells(
        "o_orderstatus", ["O"], agg="count", suffix="_customers", distinct=True,
        then_value=F.col("o_custkey"), else_value=F.lit(None),
    )
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(*many, *money, *people)


@query
def pivot_map(spark, d):
    """A column with as many values as rows, by a key of few values: three maps of a third of all rows, in parts."""
    items = table(spark, d, "lineitem").withColumn("line", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    maps = relational.pivot_map(items, ["l_returnflag"], "line", F.sum("l_quantity").cast("bigint"), most=5000)
    return maps.groupBy("l_returnflag").agg(
        F.sum(F.size("cells")).alias("n_cells"),
        F.min(F.array_min(F.map_keys("cells"))).alias("first_line"),
        F.max(F.array_max(F.map_keys("cells"))).alias("last_line"),
        F.sum(F.expr("aggregate(map_values(cells), 0L, (a, x) -> a + x)")).alias("quantity"),
        # each cell is found under its own value
        F.sum(F.expr("aggregate(map_entries(cells), 0L, (a, e) -> a + e.key % 1000 * e.value)")).alias("weighted"),
    )


@query
def union_relations(spark, d):
    customer, supplier = table(spark, d, "customer"), table(spark, d, "supplier")
    customer = customer.withColumnsRenamed({"c_nationkey": "nationkey", "c_acctbal": "acctbal"})
    supplier = supplier.withColumnsRenamed({"s_nationkey": "nationkey", "s_acctbal": "acctbal"})
    return relational.union_relations(
        {"customer": customer, "supplier": supplier},
        column_override={"nationkey": "bigint"},
        exclude=["C_NAME", "s_name"],
        where="acctbal > 0",
    )


@query
def unpivot(spark, d):
    items = table(spark, d, "lineitem")
    return relational.unpivot(
        items,
        "double",
        exclude=["l_orderkey", "l_linenumber", "l_partkey"],
        remove=["l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"],
        field_name="measure",
        value_name="amount",
    )


@query
def generate_series(spark, d):
    """Order numbers up to the largest in use that no line item refers to."""
    keys = table(spark, d, "lineitem").select("l_orderkey").distinct()
    largest = keys.agg(F.max("l_orderkey")).first()[0]
    series = relational.generate_series(spark, largest)
    return series.join(keys, F.col("generated_number") == F.col("l_orderkey"), "left_anti")


@query
def date_spine(spark, d):
    """All days between the first and the last order day, with their order counts."""
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    ends = orders.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    first, last = ends.select("a").scalar(), ends.select("b").scalar()
    counts = orders.groupBy("day").agg(F.count("*").alias("n_orders"))
    spine = relational.date_spine(spark, "day", first, last)
    joined = spine.join(counts, F.col("date_day") == F.col("day"), "left")
    return joined.select("date_day", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


# --- scalar helpers ---------------------------------------------------------------


@query
def safe_math(spark, d):
    tax = F.nullif("l_tax", F.lit(0.0))
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        fn.ratio("l_discount", "l_tax").alias("ratio"),
        fn.pct_change("l_discount", "l_tax").alias("pct"),
        fn.safe_add([tax, "l_discount", F.nullif("l_quantity", F.lit(1.0))]).alias("total"),
        fn.safe_subtract(["l_quantity", tax, "l_discount"]).alias("left_over"),
        fn.ln_positive("l_discount").alias("log"),
        fn.finite(fn.ratio("l_discount", "l_tax")).alias("is_finite"),
    )


@query
def width_bucket(spark, d):
    price = F.col("l_extendedprice")
    rows = table(spark, d, "lineitem").select(
        fn.width_bucket(price, 20000, 100000, 10).cast("int").alias("price_bucket"),
        fn.width_bucket("l_quantity", 10, 40, 3).cast("int").alias("quantity_bucket"),
        "l_extendedprice",
    )
    return rows.groupBy("price_bucket", "quantity_bucket").agg(
        F.count("*").alias("n"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )


@query
def haversine(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") * 3.0 - 36.0).alias("lat1"),
        ((F.col("c_custkey") % 360) - 180.0).alias("lon1"),
        (F.col("c_acctbal") / 200.0).alias("lat2"),
        ((F.col("c_custkey") * 7 % 360) - 180.0).alias("lon2"),
    )
    return rows.select(
        "c_custkey",
        fn.haversine("lat1", "lon1", "lat2", "lon2").alias("miles"),
        fn.haversine("lat1", "lon1", "lat2", "lon2", "km").alias("km"),
    )


@query
def surrogate_key(spark, d):
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        fn.surrogate_key(["o_orderkey", "o_orderstatus", priority]).alias("key"),
        fn.surrogate_key(["o_orderkey", "o_orderstatus", priority], True).alias("loose_key"),
    )


@query
def url_parts(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        fn.url_host("url").alias("host"),
        fn.url_path("url").alias("path"),
        fn.url_parameter("url", "page").alias("page"),
        fn.url_parameter("url", "utm_source").alias("utm_source"),
    )


@query
def normalise_label(spark, d):
    return table(spark, d, "pages").select("page_id", fn.normalise_label("url").alias("label"))


# --- data checks ----------------------------------------------------------------


@query
def dq_not_null(spark, d):
    orders = table(spark, d, "orders")
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return quality.not_null(orders, "o_orderstatus").drop("o_orderdate")


@query
def dq_accepted_values(spark, d):
    return quality.accepted_values(table(spark, d, "orders"), "o_orderpriority", PRIORITIES[:3])


@query
def dq_not_accepted_values(spark, d):
    return quality.not_accepted_values(table(spark, d, "orders"), "o_orderpriority", PRIORITIES[2:])


@query
def dq_unique_combination(spark, d):
    return quality.unique_combination(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_freshness(spark, d):
    out = quality.freshness(table(spark, d, "events"), "ts", "2024-02-09 00:00:00")
    return out.withColumn("max_loaded_at", F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query
def dq_accepted_range(spark, d):
    out = quality.accepted_range(table(spark, d, "orders"), "o_totalprice", 5000, 490000, False)
    return out.drop("o_orderdate")


@query
def dq_at_least_one(spark, d):
    orders = table(spark, d, "orders")
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    return quality.at_least_one(orders, "o_orderstatus", ["o_custkey"])


@query
def dq_cardinality_equality(spark, d):
    """Orders per customer against suppliers' line items per the same number."""
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem")
    return quality.cardinality_equality(orders, "o_custkey", items, "l_suppkey")


def _two_order_tables(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    nudge = F.when(F.col("o_orderkey") % 5 == 0, 0.00001).when(F.col("o_orderkey") % 7 == 0, 1.0)
    b = a.withColumn("o_totalprice", F.col("o_totalprice") + F.coalesce(nudge, F.lit(0.0)))
    return a, b


@query
def dq_equality(spark, d):
    a, b = _two_order_tables(spark, d)
    return quality.equality(a, b, exclude_columns=["O_CUSTKEY"])


@query
def dq_equality_precision(spark, d):
    """Prices as doubles, and beside them decimals of 38 digits that differ beyond the sixteenth."""
    a, b = _two_order_tables(spark, d)
    large = F.lit("123456789012345678901234567890").cast("decimal(30,0)") + F.col("o_orderkey")
    a = a.withColumn("large", large.cast("decimal(38,4)"))
    step = F.when(F.col("o_orderkey") % 3 == 0, F.lit("0.0049")).when(F.col("o_orderkey") % 11 == 0, F.lit("0.0050"))
    b = b.withColumn("large", (large + F.coalesce(step, F.lit("0")).cast("decimal(5,4)")).cast("decimal(38,4)"))
    return quality.equality(a, b, precision=2).withColumn("large", F.col("large").cast("string"))


@query
def dq_equal_rowcount(spark, d):
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem")
    items = items.select(F.col("l_suppkey").alias("o_custkey"))
    return quality.equal_rowcount(orders, items, ["o_custkey"])


@query
def dq_fewer_rows_than(spark, d):
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem")
    items = items.select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.fewer_rows_than(orders, items, ["o_orderkey"])


@query
def dq_fewer_rows_total(spark, d):
    return quality.fewer_rows_than(table(spark, d, "lineitem"), table(spark, d, "orders"))


@query
def dq_expression_is_true(spark, d):
    out = quality.expression_is_true(
        table(spark, d, "lineitem"), "l_quantity * l_discount <= 4.5 or l_tax > 0"
    )
    return out.drop("l_shipdate")


def _order_spans(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        "o_custkey", day.alias("a"), F.date_add(day, F.col("o_orderkey").cast("int") % 60).alias("b")
    )


@query
def dq_exclusive_ranges(spark, d):
    """Overlapping or empty order spans of the same customer."""
    return quality.mutually_exclusive_ranges(_order_spans(spark, d), "a", "b", ["o_custkey"])


@query
def dq_exclusive_ranges_total(spark, d):
    """Spans from one order to the next; the whole table is one order of rows."""
    orders = table(spark, d, "orders")
    step = F.when(F.col("o_totalprice") > 495000, 2).otherwise(1)
    spans = orders.select(F.col("o_orderkey").alias("a"), (F.col("o_orderkey") + step).alias("b"))
    return quality.mutually_exclusive_ranges(spans, "a", "b", gaps="not_allowed")


@query
def dq_not_constant(spark, d):
    return quality.not_constant(table(spark, d, "lineitem"), "l_returnflag", ["l_orderkey"])


@query
def dq_not_empty_string(spark, d):
    part = table(spark, d, "part")
    name = F.when(F.col("p_size") > 45, F.lit("  ")).otherwise(F.col("p_name"))
    return quality.not_empty_string(part.withColumn("p_name", name), "p_name")


@query
def dq_not_null_proportion(spark, d):
    items = table(spark, d, "lineitem")
    items = items.withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return quality.not_null_proportion(items, "l_tax", 0.8, 0.95, ["l_suppkey"])


@query
def dq_recency(spark, d):
    out = quality.recency(
        table(spark, d, "events"), "ts", "day", 2, "2024-01-31 00:00:00", True, ["user_id"]
    )
    return out


@query
def dq_relationships(spark, d):
    orders = table(spark, d, "orders")
    return quality.relationships(
        table(spark, d, "lineitem"), "l_orderkey", orders, "o_orderkey",
        "l_quantity > 2", "o_orderstatus <> 'P'",
    )


@query
def dq_sequential_values(spark, d):
    """Line numbers of an order that skip or repeat."""
    items = table(spark, d, "lineitem")
    return quality.sequential_values(items, "l_linenumber", group_by=["l_orderkey"])


@query
def dq_sequential_total(spark, d):
    """Order numbers of all line items as one sequence."""
    return quality.sequential_values(table(spark, d, "lineitem"), "l_orderkey")


@query
def dq_sequential_dates(spark, d):
    """Days on which a brand's daily bars do not follow the day before."""
    daily = samples.daily_prices(spark, d)
    out = quality.sequential_values(daily, "date", 1, "day", ["ticker"])
    return out


@query
def dq_values_differ(spark, d):
    items = table(spark, d, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return quality.values_differ(items, "l_discount", "l_tax").drop("l_shipdate")


@query
def dq_exchange_mismatches(spark, d):
    keywords = {
        "1-URGENT": ["AUTO", "BUILD"],
        "2-HIGH": ["MACHIN"],
        "3-MEDIUM": ["HOUSE", "FURN"],
        "4-NOT SPECIFIED": ["BUILD"],
        "5-LOW": [],
    }
    vendor = table(spark, d, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("ticker"),
        F.when(F.col("c_nationkey") < 20, F.lower("c_mktsegment")).alias("full_exchange_name"),
        F.col("c_mktsegment").alias("exchange_code"),
    )
    universe = ingest.ticker_universe(_listings(spark, d))
    exceptions = {"C1": ("1-URGENT", "MACHIN"), "C2": ("1-URGENT", "FURN")}
    return quality.exchange_mismatches(universe, vendor, keywords, exceptions)


@query
def dq_row_counts(spark, d):
    names = ["orders", "lineitem", "customer", "part", "supplier", "events"]
    return quality.row_counts({n: table(spark, d, n) for n in names})


@query
def check_report(spark, d):
    """All checks of all datasets, built over stored daily prices, bars and ledgers, which go afterwards."""
    with scratch_cleared(spark):
        store = jobs.Warehouse(scratch_path(spark, "warehouse"))
        tables.append_daily(samples.daily_prices(spark, d), store.table("daily_prices"))
        jobs.rebuild_bars(spark, store)
        for name in ("income_statement", "balance_sheet", "cashflow_statement"):
            tables.append_statements(samples.statement(spark, d, name), store.table(name), "b1")
        frames = jobs.build_analytics(jobs.stored_frames(spark, store))
        return jobs.check_report(frames, as_of="2002-01-05 00:00:00")


# --- streams ----------------------------------------------------------------------


@query
def stream_weekly_bars(spark, d):
    """Weekly bars per event type; weeks still open at the end are not shown."""
    source = f"{d}/events.parquet"
    schema = table(spark, d, "events").schema
    value = F.col("value")
    rows = (
        stream_session(spark)
        .readStream.schema(schema)
        .parquet(source + "*")
        .select(
            F.col("event_type").alias("ticker"),
            F.col("ts").cast("timestamp").alias("ts"),
            *[value.alias(c) for c in ("open", "high", "low", "close")],
            F.lit(1).cast("bigint").alias("volume"),
        )
    )
    out, state = scratch_path(spark, "weekly-stream"), scratch_path(spark, "weekly-state")
    _run_weekly(weekly_bars_stream(rows, "7 days"), out, state)
    clear_scratch(spark, [state])
    return spark.read.parquet(out)


def _run_weekly(bars: DataFrame, out: str, state: str) -> None:
    """Takes what has landed, then stops."""
    writer = bars.writeStream.format("parquet").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start(out).awaitTermination()


@query
def stream_weekly_late(spark, d):
    """The same with the default delay, and odd days that land after later ones, up to 20 days late."""
    events = table(spark, d, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").cast("timestamp").alias("ts"),
        *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1).cast("bigint").alias("volume"),
    )
    middle = F.timestamp_add("DAY", F.lit(-30), events.agg(F.max("ts")).scalar())
    landing, out, state = (scratch_path(spark, f"late-{n}") for n in ("landing", "stream", "state"))
    odd = (F.dayofmonth("ts") % 2 == 1) & (F.col("ts") > F.timestamp_add("DAY", F.lit(-20), middle))
    late = F.coalesce((F.col("ts") > middle) | odd, F.lit(False))
    session = stream_session(spark)
    for part in (events.filter(~late), events.filter(late)):
        # each part lands in as many files as it has tasks, and is a run of its own
        part.write.mode("append").parquet(landing)
        _run_weekly(weekly_bars_stream(session.readStream.schema(events.schema).parquet(landing)), out, state)
    clear_scratch(spark, [landing, state])
    return spark.read.parquet(out)


def _vendor_rows(daily: DataFrame) -> DataFrame:
    names = {"ticker": "Symbol", "date": "Date", "adj_close": "Adj Close", "short_name": "ShortName"}
    return daily.select(*DAILY_SHOWN).withColumnsRenamed(names)


def _last_days_again(daily: DataFrame) -> DataFrame:
    """The last 21 days as a vendor would deliver them anew, two higher."""
    again = daily.filter(F.col("date") >= F.date_sub(_newest(daily), 21))
    return _vendor_rows(again.withColumn("adj_close", F.col("adj_close") + 2))


@query
def stream_ingest(spark, d):
    """The daily table landed as files, then its last 21 days again."""
    daily = samples.daily_prices(spark, d)
    return _ingested(spark, [_vendor_rows(daily), _last_days_again(daily)])


def _ingested(spark, deliveries: list[DataFrame]) -> DataFrame:
    """The table after each delivery has landed, in as many files as it has tasks, and was taken by a run of its own."""
    landing, store, state = (scratch_path(spark, f"ingest-{n}") for n in ("landing", "daily", "state"))
    for rows in deliveries:
        rows.write.mode("append").parquet(landing)
        start_ingest(spark, landing, rows.schema, store, state).awaitTermination()
    clear_scratch(spark, [landing, state])
    return tables.daily_prices(spark, store).select(*DAILY_SHOWN)


@query
def stream_ingest_split(spark, d):
    """As ``stream_ingest``, each delivery in two: odd days, then even ones."""
    daily = samples.daily_prices(spark, d)
    odd = F.dayofmonth("Date") % 2 == 1
    deliveries = (_vendor_rows(daily), _last_days_again(daily))
    return _ingested(spark, [rows.filter(part) for rows in deliveries for part in (odd, ~odd)])


# --- stored tables and jobs ---------------------------------------------------------


def _stored_daily(spark, d) -> str:
    path = scratch_path(spark, "daily")
    tables.append_daily(samples.daily_prices(spark, d), path)
    return path


@query
def market_refresh(spark, d):
    """Backfill of the whole history, then a refresh of the last 21 days."""
    store = jobs.Warehouse(scratch_path(spark, "warehouse"))
    daily = samples.daily_prices(spark, d)
    jobs.backfill_market(spark, _vendor_rows(daily), store, start=None)
    today = tables.daily_prices(spark, store.table("daily_prices")).agg(F.max("date")).first()[0]
    jobs.refresh_market(spark, _last_days_again(daily), store, today=today)
    return tables.daily_prices(spark, store.table("daily_prices")).select(*DAILY_SHOWN)


@query
def fundamentals_refresh(spark, d):
    """Two loads of all statements, the first with other values; amounts in whole tens of cents
    cannot be read, nor can a column that is no date.

    All frames come from statement lines that are aggregated and stored once, so the join of
    items and parts runs, and sends its smaller side, once and not for every frame and write."""
    store = jobs.Warehouse(scratch_path(spark, "warehouse"))
    path = scratch_path(spark, "lines")
    samples.statement_lines(spark, d).write.parquet(path)
    lines = spark.read.parquet(path)
    for factor, at in [(3, "2002-01-01 00:00:00"), (1, "2002-02-01 00:00:00")]:
        frames = {s: {"Q": _statement_frame(samples.statement(spark, d, s, lines), factor)} for s in METRICS}
        out = jobs.refresh_fundamentals(spark, frames, store, loaded_at=at)
    rejects = spark.read.parquet(store.table("statement_rejects")).filter(F.col("loaded_at") == at)
    return out["fundamentals_wide"].withColumn("n_rejects", rejects.agg(F.count("*")).scalar())


def _statement_frame(ledger: DataFrame, factor: int) -> DataFrame:
    """A vendor's frame of one statement: text cells, some of them unreadable."""
    long = ledger.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    cell = F.when(F.col("cents") % 10 == 0, "n/a").otherwise((F.col("cents") * factor / 100).cast("string"))
    dates = sorted(str(r.fiscal_date) for r in long.select("fiscal_date").distinct().collect())
    cells = [F.max(F.when(F.col("fiscal_date") == F.lit(e).cast("date"), cell)).alias(e) for e in dates]
    return long.groupBy("ticker", "metric").agg(F.lit("USD").alias("currency"), *cells, F.lit("1").alias("TTM"))


@query
def stored_daily_since(spark, d):
    """The stored daily table from a day on; older month folders are not read."""
    stored = tables.daily_prices(spark, _stored_daily(spark, d))
    return tables.since(stored, "2000-03-15").select(*DAILY_SHOWN)


def _stored(spark, d, daily=None) -> DataFrame:
    path = scratch_path(spark, "daily")
    tables.append_daily(samples.daily_prices(spark, d) if daily is None else daily, path)
    return tables.daily_prices(spark, path)


@query
def stored_scanner_52w(spark, d):
    """The scanner over the stored table: only the last year's month folders are read."""
    return signals.scanner_52w(_stored(spark, d), digits=None)


@query
def stored_vix_weekly(spark, d):
    stored = _stored(spark, d, samples.index_prices(spark, d))
    return signals.vix_weekly(stored, samples.INDEX_TICKER, digits=None)


@query
def stored_correlation(spark, d):
    stored, brands = _stored(spark, d), _brands(spark, d)
    return correlation.correlation_pairs(stored, brands[:5], brands, _newest(stored), min_obs=30)


@query
def stored_weekly_bars(spark, d):
    path = scratch_path(spark, "weekly")
    tables.write_bars(spark, samples.daily_prices(spark, d), "week", path)
    return tables.read_bars(spark, path, "week").drop("built_at")


@query
def published_view(spark, d):
    tables.publish_views({"sample_weekly": _weekly(spark, d)})
    return spark.sql("select ticker, count(*) as n_weeks from sample_weekly group by ticker")


@query
def stored_statements(spark, d):
    path = scratch_path(spark, "balance")
    tables.append_statements(samples.statement(spark, d, "balance_sheet"), path, "b1")
    stored = tables.statements(spark, path, "Q")
    return stored.drop("loaded_at", "batch_id", "fiscal_ym")


@query
def csv_seed(spark, d):
    path = scratch_path(spark, "seed")
    supplier = table(spark, d, "supplier")
    supplier.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, supplier.schema)
