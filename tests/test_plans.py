"""Shapes of the physical plans: what is shuffled, limited and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars, correlation, regimes, signals
from barloom.plans.queries import QUERIES
from barloom.sources import samples, tables

EAGER = {
    "check_report", "stream_weekly_bars", "stream_weekly_late", "stream_ingest", "stream_ingest_split",
    "market_refresh", "fundamentals_refresh",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "InPandas" not in text


@pytest.mark.parametrize(
    "build, rows",
    [
        (signals.gap_scan, 2),
        (signals.momentum, 61),
        (signals.distance_from_sma, 200),
        (signals.atr_pct, 15),
        (signals.inside_outside_day, 2),
        (signals.realised_vol_rank, 398),
        (regimes.regime_daily, 141),
    ],
)
def test_history_is_limited_before_the_shuffle(make_daily, build, rows):
    text = plan(build(make_daily([("A", "2024-01-02", 1.0)])))
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if f"row_number(), {rows}, Partial" in line)
    assert any("Exchange hashpartitioning(ticker" in line for line in lines[:at])


def test_daily_bars_use_hash_aggregation(spark, sf_dir):
    text = plan(samples.daily_prices(spark, sf_dir))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    scan = next(line for line in text.splitlines() if "l_partkey" in line and "FileScan" in line)
    assert "l_extendedprice" not in scan.split("Batched")[0]


def test_period_bars_shuffle_once(make_daily):
    text = plan(bars.weekly_bars(make_daily([("A", "2024-01-02", 1.0)])))
    assert len(re.findall(r"Exchange ", text)) == 1


def test_date_filter_reaches_the_scan(spark, sf_dir):
    daily = samples.daily_prices(spark, sf_dir)
    text = plan(signals.scanner_52w(daily))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_discount" in line)
    assert "l_shipdate" in scan.split("DataFilters")[1]


def test_correlation_broadcasts_only_the_focal_year(make_daily):
    daily = make_daily([("A", "2024-01-02", 1.0)])
    text = plan(correlation.correlation_pairs(daily, ["A"], None, "2024-01-02"))
    assert text.count("BroadcastExchange") == 1
    assert re.search(r"BroadcastHashJoin \[date", text)


def test_same_bars_without_broadcast_and_with_split_partitions(spark, sf_dir):
    """A hot part key: sort-merge join with skew splitting gives the same bars."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    want = sorted(map(tuple, samples.daily_prices(spark, sf_dir).select("ticker", "date", "open", "close", "volume").collect()))
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
    }
    assert items.count() > 0
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = samples.daily_prices(spark, sf_dir).select("ticker", "date", "open", "close", "volume")
        got = sorted(map(tuple, df.collect()))
        assert "SortMergeJoin" in plan(df)
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert got == want


def test_copies_of_one_key_are_merged_before_the_shuffle(spark, make_daily):
    """Half the rows share a key; each task sends one row of it."""
    one = make_daily([("HOT", "2024-01-02", 1.0)]).crossJoin(spark.range(0, 2000, 1, 4).select("id"))
    copies = one.withColumn("adj_close", F.col("id").cast("double")).drop("id")
    copies = copies.withColumn("ingested_at", F.timestamp_seconds(F.col("adj_close").cast("bigint")))
    out = bars.latest_load(copies)
    text = plan(out)
    assert "partial_max" in text
    assert out.first().adj_close == 1999.0


def test_bucketed_table_needs_no_shuffle(spark, make_daily):
    tables.save_bucketed(make_daily([("A", "2024-01-02", 1.0), ("B", "2024-01-03", 2.0)]), "daily_by_ticker", 4)
    df = spark.table("daily_by_ticker")
    for out in (bars.weekly_bars(df), signals.realised_vol(df), regimes.regime(df)):
        assert "Exchange" not in plan(out)
    spark.sql("drop table daily_by_ticker")


@pytest.mark.parametrize(
    "build",
    [
        signals.perf_52w,
        signals.scanner_52w,
        signals.top_movers_1d,
        signals.volume_surge,
        signals.realised_vol_rank,
        lambda df: signals.vix_weekly(df, "A"),
        lambda df: correlation.correlation_pairs(df, ["A"], ["A"], "2024-01-02"),
    ],
)
def test_stored_months_are_pruned(spark, make_daily, tmp_path, build):
    path = str(tmp_path / "daily")
    days = [f"2023-{m:02d}-03" for m in range(1, 13)] + ["2024-01-02"]
    tables.append_daily(make_daily([("A", d, 1.0 + i) for i, d in enumerate(days)]), path)
    text = plan(build(tables.daily_prices(spark, path)))
    bounds = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert any("ym" in b and ">=" in b for b in bounds)


def test_the_newest_date_is_read_from_the_newest_month(spark, make_daily, tmp_path):
    from barloom.functions import newest_date

    path = str(tmp_path / "daily")
    tables.append_daily(make_daily([("A", "2023-01-03", 1.0), ("A", "2024-01-02", 2.0)]), path)
    daily = tables.daily_prices(spark, path)
    assert str(spark.range(1).select(newest_date(daily)).first()[0]) == "2024-01-02"
    none = daily.filter("date < date '2023-12-01'")
    assert str(spark.range(1).select(newest_date(none)).first()[0]) == "2023-01-03"
    both = tables.daily_prices(spark, path, dedupe=True)
    assert "ym" in both.columns and both.count() == 2


def test_refreshed_statements_read_stored_lines(spark, sf_dir, monkeypatch):
    """Items and parts are joined once; no frame of the two loads joins them again."""
    from barloom.plans import jobs

    class Seen(Exception):
        pass

    def refresh(spark, frames, store, **named):
        raise Seen([f["Q"] for f in frames.values()])

    monkeypatch.setattr(jobs, "refresh_fundamentals", refresh)
    with pytest.raises(Seen) as seen:
        QUERIES["fundamentals_refresh"](spark, sf_dir)
    for frame in seen.value.args[0]:
        assert "Join" not in plan(frame) and "l_partkey" not in plan(frame)
