"""Stored tables: Parquet folders partitioned by month, CSV seeds, temp views."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import period_start, since, year_month
from ..operators.bars import latest_load, period_bars
from ..operators.ingest import batch_windows, overlap_reload
from ..schema import DAILY_COLUMNS, DAILY_SCHEMA, PERIODS, STATEMENT_SCHEMA, bar_schema
from ..session import path_exists, remove_path, shared_dir


def _with_month(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(name, T.StringType())])


def daily_prices(spark: SparkSession, path: str, dedupe: bool = False) -> DataFrame:
    """The daily table under its contract. Filters on ``date`` go through :func:`since`.

    ``dedupe`` keeps the newest load of each (ticker, date) while a reload is
    running; a finished table needs no such pass.
    """
    df = spark.read.schema(_with_month(DAILY_SCHEMA, "ym")).parquet(path)
    if not dedupe:
        return df
    merged = latest_load(df, [c for c in df.columns if c not in ("ticker", "date")])
    return merged.select(*DAILY_COLUMNS, "ym")


def _laid_out(df: DataFrame, folder: str, *order: str) -> DataFrameWriter:
    """Writer of files of about equal size, each holding few folders, sorted by key.

    The rebalance hint lets Spark split a folder that holds most of the rows
    over many tasks and put small folders together, by the sizes it measures.
    """
    rows = df.hint("rebalance", F.col(folder)).sortWithinPartitions(folder, *order)
    return rows.write.partitionBy(folder)


def append_daily(df: DataFrame, path: str) -> None:
    """Append in contract order, one folder per month, sorted by key inside the files."""
    rows = df.select(*DAILY_COLUMNS, year_month("date").alias("ym"))
    _laid_out(rows, "ym", "ticker", "date").mode("append").parquet(path)


def upsert_daily(
    spark: SparkSession, path: str, new: DataFrame, windows: DataFrame | None = None
) -> list[str]:
    """Clear the windows and insert the new rows; only the months they touch are rewritten.

    Without windows, each ticker's is what its new rows cover. Copies of a key
    within the new rows are merged, which keeps (ticker, date) unique. Returns
    the touched months.
    """
    return _replace_months(spark, path, new, lambda fresh: batch_windows(fresh) if windows is None else windows)


def merge_daily(spark: SparkSession, path: str, new: DataFrame) -> list[str]:
    """Insert new rows by key: of the rows of one (ticker, date) the newest load stays.

    The table does not depend on how the rows are cut into deliveries. Returns
    the touched months.
    """
    return _replace_months(spark, path, new, None)


def _replace_months(spark, path, new, windows) -> list[str]:
    """Writes the touched months anew to a stage, then puts them in the table's place.

    The stage has one name per table. Its marker is written when all its rows
    are; a run that ends after that is completed by the next one, so no old row
    is lost between removing and replacing a month. Months left without rows
    are removed, because a dynamic overwrite does not touch a partition it
    writes nothing to.
    """
    stage = f"{shared_dir(spark).rstrip('/')}/stage-{hashlib.md5(path.encode()).hexdigest()}"
    finish_replacement(spark, path)
    remove_path(spark, stage)
    fresh = f"{stage}/new"
    new.select(*DAILY_COLUMNS).write.parquet(fresh)
    new = latest_load(spark.read.schema(DAILY_SCHEMA).parquet(fresh)).select(*DAILY_COLUMNS)
    spans = None
    if windows is not None:
        windows(new).write.parquet(f"{stage}/windows")
        spans = spark.read.parquet(f"{stage}/windows")
    touched = _months(new, spans)
    if not touched:
        remove_path(spark, stage)
        return []
    rows = new
    if path_exists(spark, path):
        old = daily_prices(spark, path)
        old = old.filter(F.col("ym").isin(touched)).select(*DAILY_COLUMNS)
        rows = latest_load(old.unionByName(new)) if spans is None else overlap_reload(old, new, spans)
    append_daily(rows, f"{stage}/rows")
    months = spark.createDataFrame([(m,) for m in touched], "ym string")
    months.coalesce(1).write.parquet(f"{stage}/ready")
    finish_replacement(spark, path)
    return touched


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Completes a replacement of months whose stage is ready; else does nothing."""
    stage = f"{shared_dir(spark).rstrip('/')}/stage-{hashlib.md5(path.encode()).hexdigest()}"
    if not path_exists(spark, f"{stage}/ready/_SUCCESS"):
        return
    touched = [r.ym for r in spark.read.schema("ym string").parquet(f"{stage}/ready").collect()]
    staged = spark.read.schema(_with_month(DAILY_SCHEMA, "ym")).parquet(f"{stage}/rows")
    left = {r.ym for r in staged.select("ym").distinct().collect()}
    replace = _laid_out(staged, "ym", "ticker", "date").mode("overwrite")
    replace.option("partitionOverwriteMode", "dynamic").parquet(path)
    for month in touched:
        if month not in left:
            remove_path(spark, f"{path.rstrip('/')}/ym={month}")
    remove_path(spark, stage)


def _months(new: DataFrame, windows: DataFrame | None) -> list[str]:
    """Months covered by the windows or the new rows: at most twelve a year reach the driver."""
    mine = new.select(year_month("date").alias("ym"))
    if windows is None:
        return sorted(r.ym for r in mine.distinct().collect())
    step = F.expr("interval 1 month")
    spans = windows.select(F.trunc("start_date", "month").alias("a"), F.col("end_date").alias("b"))
    covered = spans.distinct().select(F.explode(F.sequence("a", "b", step)).alias("m"))
    both = covered.select(year_month("m").alias("ym")).unionByName(mine)
    return sorted(r.ym for r in both.distinct().collect())


def write_bars(
    spark: SparkSession, daily: DataFrame, period: str, path: str, touched: list[str] | None = None
) -> None:
    """Bars of a period as a table, one folder per year of the period's first day.

    Without ``touched`` all of it is rebuilt. Given the months (yyyyMM) whose
    daily rows changed, only the years of the periods that reach into them are
    read and replaced. A week may start in the year before its last day, so the
    folder goes by the first day, which does not move when rows arrive.
    """
    key = PERIODS[period][1]
    if touched is None or not path_exists(spark, path):
        bars = _bars_by_year(daily, period)
        _laid_out(bars, "year", "ticker", key).mode("overwrite").parquet(path)
        return
    years = sorted({y for m in touched for y in _start_years(m, period)})
    if not years:
        return
    # The last week of a year ends in the January after it.
    months = [f"{y}{m:02d}" for y in years for m in range(1, 13)] + [f"{y + 1}01" for y in years]
    rows = daily.filter(F.col("ym").isin(months)) if "ym" in daily.columns else daily
    bars = _bars_by_year(rows, period).filter(F.col("year").isin(years))
    writer = _laid_out(bars, "year", "ticker", key).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    present = {r.y for r in rows.select(F.year(_first_day(period)).alias("y")).distinct().collect()}
    for year in years:
        if year not in present:
            remove_path(spark, f"{path.rstrip('/')}/year={year}")


def _first_day(period: str) -> Column:
    return period_start("date", PERIODS[period][0])


def _bars_by_year(daily: DataFrame, period: str) -> DataFrame:
    bars = period_bars(daily, period, keep_start=True)
    return bars.withColumn("year", F.year("period_start")).drop("period_start")


def _start_years(month: str, period: str) -> set[int]:
    """Years in which periods start that reach into a month."""
    year = int(month[:4])
    return {year - 1, year} if period == "week" and month.endswith("01") else {year}


def read_bars(spark: SparkSession, path: str, period: str) -> DataFrame:
    schema = bar_schema(period)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def statements(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """A statement ledger; the period filter reaches the Parquet scan."""
    df = spark.read.schema(_with_month(STATEMENT_SCHEMA, "fiscal_ym")).parquet(path)
    return df if period is None else df.filter(F.col("period") == period)


def append_statements(ledger: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Append ledger rows, partitioned by fiscal month, ordered by key inside the files."""
    run = F.lit(batch_id) if batch_id else F.expr("uuid()")
    rows = ledger if "batch_id" in ledger.columns else ledger.withColumn("batch_id", run)
    rows = rows.select(*STATEMENT_SCHEMA.fieldNames(), year_month("fiscal_date").alias("fiscal_ym"))
    _laid_out(rows, "fiscal_ym", "ticker", "fiscal_date", "metric").mode("append").parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV seed with a header row, under an explicit schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str = "date") -> None:
    """A catalog table bucketed by ticker: windows and bars by ticker then need no shuffle."""
    (
        df.repartition(buckets, "ticker")
        .write.mode("overwrite")
        .bucketBy(buckets, "ticker")
        .sortBy("ticker", key)
        .saveAsTable(name)
    )


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Register frames as temp views; they stay lazy and are computed on read."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
