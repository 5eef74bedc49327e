"""Maps an order-entry star schema onto the market contracts.

Line items are taken as trades: the brand is the ticker, discount and tax give
the price, the quantity is the volume. Everything is derived by Spark from the
whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fundamentals import METRICS

LOADED_AT = "2002-01-01 00:00:00"
INDEX_TICKER = "Brand#11"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(c: Column) -> Column:
    """Nearest whole number of a value that is not negative, without going through decimals."""
    return (c + 0.5).cast("bigint")


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their brand. Broadcast or sort-merge is left to the measured sizes;
    a hot part is split by the adaptive skew join."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def daily_prices(spark: SparkSession, sf_dir: str, price: Column | None = None) -> DataFrame:
    """Daily bars of all brands under the daily contract.

    First and last trade of a day: (order, line) and the whole-number price are
    packed into one long, whose min and max need 8 bytes of hash-aggregation
    buffer and no sort. Partial bars are made where the items are read, so a
    brand with most of the trades sends no more rows than the others.
    """
    if price is None:
        price = F.lit(100) + whole(F.col("l_discount") * 100) - whole(F.col("l_tax") * 100)
    px = price.cast("bigint")
    order = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000
    trades = _trades(spark, sf_dir).select(
        "ticker",
        F.col("l_shipdate").cast("date").alias("date"),
        px.alias("px"),
        (order + px).alias("seq"),
        F.col("l_quantity").alias("qty"),
    )
    bars = trades.groupBy("ticker", "date").agg(
        F.min("seq").alias("first"),
        F.max("seq").alias("last"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.sum("qty").alias("qty"),
    )
    close = (F.col("last") % 1000).cast("double")
    return bars.select(
        "ticker",
        F.concat(F.lit("Brand "), F.col("ticker")).alias("short_name"),
        "date",
        (F.col("first") % 1000).cast("double").alias("open"),
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
        close.alias("close"),
        (close - 1).alias("adj_close"),
        F.col("qty").cast("bigint").alias("volume"),
        F.lit(LOADED_AT).cast("timestamp").alias("ingested_at"),
        F.lit("sample").alias("batch_id"),
        F.lit("sample").alias("source"),
    )


def index_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series in the range of a volatility index (10 to 25)."""
    price = F.lit(10) + whole(F.col("l_discount") * 150)
    return daily_prices(spark, sf_dir, price)


def restated(daily: DataFrame) -> DataFrame:
    """The daily table with a second, later copy of all even days, priced 3 higher.

    The copies are made row by row, so the input is read once.
    """
    loads = F.when(F.dayofmonth("date") % 2 == 0, F.array(F.lit(1), F.lit(2)))
    rows = daily.withColumn("_load", F.explode(F.coalesce(loads, F.array(F.lit(1)))))
    later = F.col("_load") == 2
    at = F.when(later, F.lit("2002-02-01 00:00:00").cast("timestamp"))
    return (
        rows.withColumn("adj_close", F.col("adj_close") + F.when(later, 3).otherwise(0))
        .withColumn("ingested_at", F.coalesce(at, "ingested_at"))
        .drop("_load")
    )


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 14 metrics of each (brand, quarter) from one pass, as (metric, value) rows.

    Amounts are summed as whole cents, so the sums are exact in any order.
    """
    cents = whole(F.col("l_extendedprice") * 100)
    lines = _trades(spark, sf_dir).select(
        "ticker",
        F.last_day(F.add_months(F.trunc(F.col("l_shipdate").cast("date"), "quarter"), 2)).alias(
            "fiscal_date"
        ),
        cents.alias("ext"),
        "l_returnflag",
        "l_linestatus",
        "l_tax",
        "l_discount",
        "l_linenumber",
    )
    ext = F.col("ext")
    returned = F.when(F.col("l_returnflag") == "R", ext)
    balance = [F.sum(F.when(F.col("l_linenumber") == i + 1, ext)) for i in range(7)]
    sums = dict(zip(METRICS["balance_sheet"].values(), balance))
    sums |= {
        "Total Revenue": F.sum(ext),
        "Cost Of Revenue": F.sum(returned),
        "Gross Profit": F.sum(ext) - F.sum(returned),
        "Operating Income": F.sum(F.when(F.col("l_linestatus") == "F", ext)),
        "Net Income": F.sum(F.when(F.col("l_tax") == 0, ext)),
        "Total Cash From Operating Activities": F.sum(F.when(F.col("l_discount") >= 0.05, ext)),
        "Capital Expenditures": F.sum(F.when(F.col("l_discount") < 0.02, ext)),
    }
    wide = lines.groupBy("ticker", "fiscal_date").agg(*[c.alias(m) for m, c in sums.items()])
    return wide.unpivot(["ticker", "fiscal_date"], list(sums), "metric", "cents").filter(
        "cents IS NOT NULL"
    )


def statement(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame | None = None) -> DataFrame:
    """One quarterly ledger. The three share their aggregation in a common plan, or the stored
    ``lines`` when more than one action reads them."""
    lines = statement_lines(spark, sf_dir) if lines is None else lines
    rows = lines.filter(F.col("metric").isin(list(METRICS[name].values())))
    return rows.select(
        "ticker",
        "fiscal_date",
        F.lit("Q").alias("period"),
        "metric",
        (F.col("cents") / 100).alias("value"),
        F.lit("USD").alias("currency"),
        F.lit("sample").alias("source"),
        F.lit(LOADED_AT).cast("timestamp").alias("loaded_at"),
    )


def ledgers(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [statement(spark, sf_dir, name) for name in METRICS]
