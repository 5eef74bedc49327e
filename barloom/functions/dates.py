"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col


def as_date_col(value) -> Column:
    """A date given as Column, ``date`` or ISO text; ``None`` means today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(value).cast("date")


def period_start(c: ColumnOrName, unit: str) -> Column:
    """First day of the ISO week, month or quarter."""
    return F.trunc(_col(c), unit).cast("date")


def add_years(c: ColumnOrName, years: int) -> Column:
    """Same day in another year; 29 February falls back to the 28th."""
    return F.add_months(_col(c), 12 * years)


def iso_year(c: ColumnOrName) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(c))


def iso_week(c: ColumnOrName) -> Column:
    return F.weekofyear(_col(c))


def since(df: DataFrame, start, column: str = "date") -> DataFrame:
    """Rows from a day on (a Column, ``date`` or text).

    Where the table is stored by month (a column ``ym`` stands beside the date), older months
    are not read; a bound that is only known at run time prunes at run time.
    """
    day = as_date_col(start)
    if "ym" in df.columns and column == "date":
        df = df.filter(F.col("ym") >= year_month(day))
    return df.filter(F.col(column) >= day)


def newest_date(daily: DataFrame) -> Column:
    """max(date) as a scalar subquery; in a table stored by month only the newest month is read."""
    if "ym" in daily.columns:
        daily = daily.filter(F.col("ym") == daily.agg(F.max("ym")).scalar())
    return daily.agg(F.max("date")).scalar()


def newest_dates(daily: DataFrame, n: int = 2) -> DataFrame:
    """The newest n distinct dates, from one pass over the date column.

    In a table stored by month these lie in its newest n months, and only those are read.
    """
    if "ym" in daily.columns:
        months = daily.select("ym").distinct().orderBy(F.desc("ym")).limit(n)
        daily = daily.filter(F.col("ym") >= months.agg(F.min("ym")).scalar())
    days = daily.filter(F.col("date").isNotNull()).select("date").distinct()
    return days.orderBy(F.desc("date")).limit(n)


def year_month(c: ColumnOrName) -> Column:
    """yyyyMM, the partition key of the stored tables."""
    return F.date_format(_col(c), "yyyyMM")
