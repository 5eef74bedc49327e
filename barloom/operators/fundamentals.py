"""Statement ledgers: union, pivot, key ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import or_zero, ratio
from ..schema import STATEMENT_KEY

LONG_COLUMNS = [
    "statement",
    "ticker",
    "fiscal_date",
    "period",
    "metric",
    "value",
    "currency",
    "source",
    "loaded_at",
]

# The vendor's metric labels, by statement, and their column names.
METRICS = {
    "income_statement": {
        "total_revenue": "Total Revenue",
        "cost_of_revenue": "Cost Of Revenue",
        "gross_profit": "Gross Profit",
        "operating_income": "Operating Income",
        "net_income": "Net Income",
    },
    "balance_sheet": {
        "total_assets": "Total Assets",
        "total_liab": "Total Liab",
        "equity": "Total Stockholder Equity",
        "current_assets": "Total Current Assets",
        "current_liab": "Total Current Liabilities",
        "cash_and_equiv": "Cash And Cash Equivalents",
        "long_term_debt": "Long Term Debt",
    },
    "cashflow_statement": {
        "cfo": "Total Cash From Operating Activities",
        "capex": "Capital Expenditures",
    },
}

RATIOS = [
    "gross_margin",
    "operating_margin",
    "net_margin",
    "current_ratio",
    "debt_to_equity",
    "fcf",
]


def latest_restatement(ledger: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per statement line: the one loaded last.

    The key includes the period, so an annual and a quarterly line of the same
    fiscal date never replace each other.
    """
    key = list(key or STATEMENT_KEY)
    if "statement" in ledger.columns and "statement" not in key:
        key = ["statement", *key]
    rest = [c for c in ledger.columns if c not in key]
    ordered = ["loaded_at"] + [c for c in rest if c != "loaded_at"]
    return (
        ledger.groupBy(*key)
        .agg(F.max(F.struct(*ordered)).alias("_row"))
        .select(*[c if c in key else F.col(f"_row.{c}").alias(c) for c in ledger.columns])
    )


def fundamentals_long(
    income: DataFrame, balance: DataFrame, cashflow: DataFrame, period: str | None = "Q"
) -> DataFrame:
    """The three ledgers as one, tagged by statement; quarterly lines by default."""
    tagged = []
    for name, ledger in zip(METRICS, (income, balance, cashflow)):
        rows = ledger if period is None else ledger.filter(F.col("period") == period)
        tagged.append(rows.withColumn("statement", F.lit(name)).select(*LONG_COLUMNS))
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def fundamentals_wide(
    long: DataFrame, metrics: dict[str, dict[str, str]] | None = None, missing: str = "null"
) -> DataFrame:
    """One row per (ticker, fiscal_date) with the named metrics as columns.

    A metric without a line is NULL, or 0 with ``missing='zero'``.

    A single pass: each metric is the value loaded last among its lines, so
    restatements need no separate de-duplication and the statements no joins.
    """
    metrics = metrics or METRICS
    cells = []
    for statement, labels in metrics.items():
        for column, label in labels.items():
            mine = (F.col("statement") == statement) & (F.col("metric") == label)
            newest = F.max(F.when(mine, F.struct("loaded_at", "value")))
            cells.append(or_zero(newest.getField("value"), missing).alias(column))
    currency = F.max(F.struct("loaded_at", "currency")).getField("currency")
    return long.groupBy("ticker", "fiscal_date").agg(currency.alias("currency"), *cells)


def _or_zero(num: str, den: str) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def key_ratios_wide(wide: DataFrame) -> DataFrame:
    """Margins, current ratio, debt to equity (0 when undefined) and free cash flow."""
    base = [c for c in wide.columns if c != "cost_of_revenue"]
    return wide.select(
        *base,
        _or_zero("gross_profit", "total_revenue").alias("gross_margin"),
        _or_zero("operating_income", "total_revenue").alias("operating_margin"),
        _or_zero("net_income", "total_revenue").alias("net_margin"),
        _or_zero("current_assets", "current_liab").alias("current_ratio"),
        _or_zero("total_liab", "equity").alias("debt_to_equity"),
        (F.col("cfo") - F.col("capex")).alias("fcf"),
    )


def key_ratios_long(wide: DataFrame) -> DataFrame:
    """The six ratios as (metric, value) rows, expanded from one pass over the input."""
    return key_ratios_wide(wide).unpivot(
        ["ticker", "fiscal_date", "currency"], RATIOS, "metric", "value"
    )
