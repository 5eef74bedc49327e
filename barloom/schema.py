"""Column contracts of the base tables.

A base table is described by a ``StructType`` and nothing else; it is never a
build step, so declaring it cannot replace stored rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]

DAILY_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("short_name", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
DAILY_COLUMNS = DAILY_SCHEMA.fieldNames()
DAILY_KEY = ["ticker", "date"]

# The flat sample shape: a subset of the daily contract under another date name.
SAMPLE_PRICE_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("trade_date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

STATEMENT_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("fiscal_date", T.DateType(), False),
        T.StructField("period", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("batch_id", T.StringType()),
    ]
)
STATEMENT_COLUMNS = STATEMENT_SCHEMA.fieldNames()
STATEMENT_KEY = ["ticker", "fiscal_date", "period", "metric"]

STATEMENTS = ["income_statement", "balance_sheet", "cashflow_statement"]

# period name -> (trunc unit, key column of the bar table)
PERIODS = {
    "week": ("week", "week_ending"),
    "month": ("month", "month_ending"),
    "quarter": ("quarter", "quarter_ending"),
}


def bar_schema(period: str) -> T.StructType:
    """Contract of a bar table: the daily columns with the period's last trading day as key."""
    key = PERIODS[period][1]
    names = ["ticker", "short_name", key, "open", "high", "low", "close", "adj_close", "volume"]
    kinds = {f.name: f.dataType for f in DAILY_SCHEMA.fields} | {key: T.DateType()}
    fields = [T.StructField(n, kinds[n]) for n in names]
    fields.append(T.StructField("source_max_date", T.DateType()))
    fields.append(T.StructField("built_at", T.TimestampType()))
    return T.StructType(fields)
