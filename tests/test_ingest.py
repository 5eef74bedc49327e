"""Vendor rows to contracts, and the stored tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barloom.operators import ingest
from barloom.operators.bars import period_bars
from barloom.plans import jobs, registry
from barloom.schema import DAILY_COLUMNS
from barloom.sources import tables


def raw_frame(spark, rows, names=("Symbol", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume")):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def raw_bar(ticker, day, close, volume="100"):
    return (ticker, day, *[str(close)] * 5, volume)


def shown(df):
    return sorted((r.ticker, r.date, r.close, r.volume) for r in df.collect())


def test_normalise(spark):
    raw = raw_frame(
        spark,
        [
            ("A", "2024-01-02", "1", "2", "0.5", "n/a", "NaN", "10.0"),
            ("A", "2024-01-03", None, None, None, "", None, "5"),
            ("A", "never", "1", "1", "1", "1", "1", "1"),
            (None, "2024-01-02", "1", "1", "1", "1", "1", "1"),
            ("B", "2024-01-02", None, None, None, None, "7", "many"),
        ],
    )
    out = ingest.normalise_bars(raw, "run", "feed", "2024-02-01 00:00:00")
    assert out.columns == DAILY_COLUMNS
    got = {r.ticker: r for r in out.collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].open, got["A"].close, got["A"].adj_close, got["A"].volume) == (1.0, None, None, 10)
    assert (got["B"].adj_close, got["B"].volume, got["B"].short_name) == (7.0, 0, "B")
    assert (got["B"].batch_id, got["B"].source) == ("run", "feed")


def test_vendor_spellings(spark):
    raw = spark.createDataFrame([(1.0, None, 2.0, "x")], "`Adj close` double, AdjClose double, Close double, Other string")
    assert ingest.canonical_columns(raw).columns == ["adj_close", "close"]
    assert tuple(ingest.canonical_columns(raw).first()) == (1.0, 2.0)
    with pytest.raises(ValueError):
        ingest.normalise_bars(raw, "run")


def test_trading_date_zone(spark):
    df = spark.createDataFrame([("2024-01-02T23:30:00Z",), ("2024-01-02T09:00:00+09:00",), ("x",)], "t string")
    utc = [r[0] for r in df.select(ingest.trading_date(F.col("t"))).collect()]
    tokyo = [r[0] for r in df.select(ingest.trading_date(F.col("t"), "Asia/Tokyo")).collect()]
    assert utc == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None]
    assert tokyo == [dt.date(2024, 1, 3), dt.date(2024, 1, 2), None]


def test_flatten(spark):
    wide = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 3.0)], "date string, Close__A double, Close__B double, Open__A double")
    got = {r.ticker: (r.Close, r.Open) for r in ingest.flatten_two_level(wide).collect()}
    assert got == {"A": (1.0, 3.0), "B": (2.0, None)}


def test_names_and_currency(spark):
    df = spark.createDataFrame([("", None, "S", "T"), (None, "", "", "T"), ("a", "b", "c", "T")], "s string, l string, y string, t string")
    assert [r[0] for r in df.select(ingest.display_name("s", "l", "y", "t")).collect()] == ["S", "T", "a"]
    assert [r[0] for r in df.select(ingest.currency_or_blank("s", "l")).collect()] == ["", "", "a"]


def test_clip_includes_both_ends(make_daily):
    daily = make_daily([("A", f"2024-01-0{i}", float(i)) for i in range(1, 6)])
    assert sorted(r.close for r in ingest.clip(daily, "2024-01-02", "2024-01-04").collect()) == [2.0, 3.0, 4.0]
    assert ingest.clip(daily).count() == 5


def test_reload_is_idempotent(make_daily):
    old = make_daily([("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("B", "2024-01-02", 3.0)])
    new = make_daily([("A", "2024-01-02", 9.0)])
    windows = ingest.reload_windows(old, "2024-01-02", 0)
    once = ingest.overlap_reload(old, new, windows)
    assert shown(once) == [("A", dt.date(2024, 1, 1), 1.0, 100), ("A", dt.date(2024, 1, 2), 9.0, 100)]
    assert shown(ingest.overlap_reload(once, new, windows)) == shown(once)
    back = ingest.backfill_reload(old, new)
    assert len(shown(back)) == 3


def test_melt_and_combine(spark):
    wide = spark.createDataFrame(
        [("T", "Rev", None, 10.0, float("nan")), ("T", "Cost", "EUR", None, 4.0)],
        "ticker string, metric string, currency string, `2023-12-31` double, `2022-12-31` double",
    )
    out = ingest.melt_statement(wide, "A", {"Rev": "Total Revenue"})
    assert sorted((r.metric, r.fiscal_date, r.value, r.currency) for r in out.collect()) == [
        ("Cost", dt.date(2022, 12, 31), 4.0, "EUR"), ("Total Revenue", dt.date(2023, 12, 31), 10.0, ""),
    ]
    assert ingest.combine_statements(None, out).count() == 2
    with pytest.raises(ValueError):
        ingest.combine_statements(None, None)


def test_tail(make_daily):
    daily = make_daily([("A", f"2024-01-0{i}", float(i)) for i in range(1, 6)] + [("B", "2024-02-01", 1.0)])
    assert [r.close for r in ingest.tail(daily, 2, ticker="A").collect()] == [5.0, 4.0]
    assert ingest.tail(daily, 1).first().ticker == "B"


def test_csv_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("size,color\nS,red\nM,\n")
    got = [tuple(r) for r in tables.read_csv(spark, str(path), "size string, color string").collect()]
    assert got == [("S", "red"), ("M", None)]


def month_days(year, month, count):
    return [f"{year}-{month:02d}-{d:02d}" for d in range(1, count + 1)]


def test_refresh_twice_is_refresh_once(spark, tmp_path):
    store = jobs.Warehouse(str(tmp_path))
    history = [raw_bar(t, d, i + 1) for t in "AB" for i, d in enumerate(month_days(2023, 12, 28) + month_days(2024, 1, 28))]
    jobs.backfill_market(spark, raw_frame(spark, history), store, ingested_at="2024-02-01 00:00:00")
    daily = store.table("daily_prices")
    assert tables.daily_prices(spark, daily).count() == 2 * 56

    fresh = [raw_bar("A", d, 50) for d in month_days(2024, 1, 28)[20:]]
    touched = None
    seen = []
    for _ in range(2):
        touched = jobs.refresh_market(
            spark, raw_frame(spark, fresh), store, today="2024-01-28", lookback_days=7, ingested_at="2024-02-02 00:00:00"
        )
        seen.append(shown(tables.daily_prices(spark, daily)))
    assert touched == ["202401"]
    assert seen[0] == seen[1]
    a = {r[1]: r[2] for r in seen[0] if r[0] == "A"}
    assert len(a) == 56 and a[dt.date(2024, 1, 28)] == 50.0 and a[dt.date(2024, 1, 20)] != 50.0
    # The bars of the touched years equal a rebuild of everything.
    for period, name in [("week", "weekly_prices"), ("month", "monthly_prices"), ("quarter", "quarterly_prices")]:
        stored = tables.read_bars(spark, store.table(name), period).drop("built_at")
        full = period_bars(tables.daily_prices(spark, daily), period, stamp=False)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, full.select(*stored.columns).collect()))


def test_empty_delivery_clears_its_window(spark, tmp_path):
    store = jobs.Warehouse(str(tmp_path))
    jobs.backfill_market(spark, raw_frame(spark, [raw_bar("A", "2023-12-30", 1), raw_bar("A", "2024-01-05", 2)]), store)
    none = raw_frame(spark, [raw_bar("A", "1999-01-01", 1)]).limit(0)
    who = spark.createDataFrame([("A",)], "ticker string")
    touched = jobs.refresh_market(spark, none, store, who, today="2024-01-07", lookback_days=10)
    daily = store.table("daily_prices")
    assert touched == ["202312", "202401"]
    assert tables.daily_prices(spark, daily).count() == 0
    assert not os.path.exists(f"{daily}/ym=202401")
    assert tables.read_bars(spark, store.table("monthly_prices"), "month").count() == 0


def test_copies_in_a_delivery_are_merged(spark, tmp_path, make_daily):
    path = str(tmp_path / "daily")
    a = make_daily([("A", "2024-01-02", 1.0)], "2024-02-01 00:00:00")
    b = make_daily([("A", "2024-01-02", 2.0)], "2024-02-02 00:00:00")
    both = a.unionByName(b)
    tables.upsert_daily(spark, path, both, ingest.batch_windows(both))
    assert shown(tables.daily_prices(spark, path)) == [("A", dt.date(2024, 1, 2), 2.0, 100)]


def test_month_folders_are_pruned(spark, tmp_path, make_daily):
    path = str(tmp_path / "daily")
    tables.append_daily(make_daily([("A", "2023-11-30", 1.0), ("A", "2024-01-02", 2.0)]), path)
    df = tables.since(tables.daily_prices(spark, path), "2024-01-01")
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan
    assert df.count() == 1
    assert tables.daily_prices(spark, path, dedupe=True).count() == 2


def statement_frame(spark, metric, value, year=2023, ticker="T"):
    return spark.createDataFrame(
        [(ticker, metric, "USD", value)], f"ticker string, metric string, currency string, `{year}-12-31` double"
    )


def test_fundamentals_refresh(spark, tmp_path):
    store = jobs.Warehouse(str(tmp_path))
    frames = {
        "income_statement": {
            "Q": statement_frame(spark, "Rev", 200.0).unionByName(statement_frame(spark, "Gross Profit", 50.0)),
            "A": statement_frame(spark, "Rev", 999.0),
        },
        "balance_sheet": {"Q": statement_frame(spark, "Total Current Assets", 30.0)},
        "cashflow_statement": {"Q": statement_frame(spark, None, 1.0).unionByName(statement_frame(spark, "Capital Expenditures", 5.0))},
    }
    labels = {"Rev": "Total Revenue"}
    jobs.refresh_fundamentals(spark, frames, store, labels=labels, loaded_at="2024-01-01 00:00:00")
    restated = {**frames, "income_statement": {"Q": statement_frame(spark, "Rev", 100.0)}}
    out = jobs.refresh_fundamentals(spark, restated, store, ["T"], labels, loaded_at="2024-02-01 00:00:00")
    row = out["key_ratios_wide"].first()
    assert (row.total_revenue, row.gross_margin, row.net_margin, row.current_ratio) == (100.0, 0.5, 0.0, 0.0)
    assert row.fcf is None and row.currency == "USD"
    assert out["fundamentals_long"].filter("period <> 'Q'").count() == 0
    assert spark.read.parquet(store.table("statement_rejects")).count() == 2
    ratios = {r.metric: r.value for r in out["key_ratios_long"].collect()}
    assert set(ratios) == {"gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity", "fcf"}
    assert jobs.refresh_fundamentals(spark, frames, store, ["OTHER"])["fundamentals_wide"].count() == 1


def test_analytics_and_report(spark, make_daily):
    import random

    rng = random.Random(1)
    rows = [(t, str(dt.date(2023, 1, 1) + dt.timedelta(days=i)), rng.uniform(9, 11)) for t in ("A", "^VIX") for i in range(60)]
    frames = jobs.build_analytics(make_daily(rows), publish=True)
    assert spark.table("gap_scan").count() == 2
    assert "fundamentals_wide" not in frames and "correlation_matrix" in frames
    some = {n: frames[n] for n in ("daily_prices", "weekly_prices", "regime_daily", "vix_weekly", "breadth")}
    report = {r.check_name: r.status for r in jobs.check_report(some, as_of="2024-01-05").collect()}
    assert set(report.values()) == {"pass"}
    doubled = {"daily_prices": make_daily(rows + rows[:1])}
    bad = {r.check_name: r.failures for r in jobs.check_report(doubled).collect()}
    assert bad["daily_prices: unique (ticker, date)"] == 1


def test_registry_inputs_exist():
    known = {"daily_prices", "income_statement", "balance_sheet", "cashflow_statement"}
    for name, dataset in registry.DATASETS.items():
        assert set(dataset.inputs) <= known, name
        known.add(name)


# --- replacement of months, by window and by key ---------------------------------


def _days(rows):
    return sorted((r.ticker, str(r.date), r.close) for r in rows.collect())


def test_merge_by_key_does_not_depend_on_the_cut(spark, make_daily, tmp_path):
    days = [(("A"), f"2024-01-{d:02d}", float(d)) for d in range(1, 21)]
    odd, even = days[::2], days[1::2]
    late = make_daily([("A", "2024-01-03", 99.0)], "2024-02-01 00:00:00")
    tables_at = []
    for i, parts in enumerate([[days], [odd, even], [even, odd]]):
        path = str(tmp_path / f"t{i}")
        for part in parts:
            tables.merge_daily(spark, path, make_daily(part))
        tables.merge_daily(spark, path, late)
        tables_at.append(_days(tables.daily_prices(spark, path)))
    assert tables_at[0] == tables_at[1] == tables_at[2]
    assert len(tables_at[0]) == 20 and ("A", "2024-01-03", 99.0) in tables_at[0]


def test_a_broken_replacement_is_completed(spark, make_daily, tmp_path, monkeypatch):
    from barloom.session import path_exists, shared_dir

    path = str(tmp_path / "t")
    tables.upsert_daily(spark, path, make_daily([("A", "2024-01-05", 1.0), ("B", "2024-01-06", 2.0)]))
    finish = tables.finish_replacement
    calls = []

    def broken(spark, path):
        calls.append(path)
        if len(calls) > 1:  # after the stage is ready: the month is gone, nothing put in its place
            from barloom.session import remove_path

            remove_path(spark, f"{path}/ym=202401")
            raise RuntimeError("lost")
        finish(spark, path)

    monkeypatch.setattr(tables, "finish_replacement", broken)
    with pytest.raises(RuntimeError):
        tables.upsert_daily(spark, path, make_daily([("A", "2024-01-05", 7.0)]))
    monkeypatch.setattr(tables, "finish_replacement", finish)
    tables.upsert_daily(spark, path, make_daily([("C", "2024-02-01", 3.0)]))
    assert _days(tables.daily_prices(spark, path)) == [("A", "2024-01-05", 7.0), ("B", "2024-01-06", 2.0), ("C", "2024-02-01", 3.0)]
    import os

    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("stage-")]
    assert not path_exists(spark, f"{path}/nothing")


def test_scratch_is_cleared(spark):
    from barloom.operators import quality
    from barloom.session import scratch_cleared, shared_dir
    import os

    before = set(os.listdir(shared_dir(spark)))
    with scratch_cleared(spark):
        assert quality.sequential_values(spark.range(5).select("id"), "id").count() == 0
        assert set(os.listdir(shared_dir(spark))) > before
    assert set(os.listdir(shared_dir(spark))) == before


def test_unreadable_cells_are_kept_apart(spark):
    wide = spark.createDataFrame(
        [("A", "Rev", "USD", "1.5", "n/a", "2"), ("B", "Rev", None, "NaN", " ", None)],
        "ticker string, metric string, currency string, `2023-12-31` string, `2022-12-31` string, TTM string",
    )
    cells = ingest.statement_cells(wide, "A")
    good, bad = ingest.split_rejects(cells)
    assert [(r.ticker, str(r.fiscal_date), r.value) for r in good.collect()] == [("A", "2023-12-31", 1.5)]
    assert sorted((r.ticker, r.raw) for r in bad.collect()) == [("A", "2022-12-31: n/a"), ("A", "TTM: 2")]
    assert ingest.melt_statement(wide, "A").count() == 1


def test_exchanges_are_validated_over_the_real_lists(spark):
    rows = [("AAPL", "NasdaqGS", "NMS"), ("JNJ", None, "NYQ"), ("PLTR", "NasdaqGS", "NMS"), ("EQNR.OL", "Oslo", "OSL"), ("SPY", "Frankfurt", "FRA")]
    vendor = spark.createDataFrame(rows, "ticker string, full_exchange_name string, exchange_code string")
    found = {r.ticker: (r.expected, r.actual) for r in jobs.validate_exchanges(spark, vendor).collect()}
    assert found["SPY"] == ("ARCX", "FRANKFURT") and not {"AAPL", "JNJ", "PLTR", "EQNR.OL"} & set(found)
    assert found["KO"] == ("NYSE", "")  # no vendor row


def test_tagged_reload_equals_the_reload_of_two_tables(spark):
    bars = "ticker string, date date, close double"
    day = lambda n: dt.date(2024, 1, n)
    old = spark.createDataFrame([(t, day(n), 1.0) for t in ("A", "B", "C", None) for n in range(1, 11)], bars)
    new = spark.createDataFrame([("A", day(4), 2.0), ("A", day(6), 2.0), ("D", day(2), 2.0), ("C", day(9), 2.0)], bars)
    spans = spark.createDataFrame([("A", day(3), day(7)), ("B", day(9), day(30)), ("E", day(1), day(9))], "ticker string, start_date date, end_date date")
    tagged = old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
    rows = tagged.unionByName(spans, allowMissingColumns=True)
    want = sorted(map(str, ingest.overlap_reload(old, new, spans).collect()))
    once = ingest.tagged_reload(rows)
    assert once.columns == old.columns and sorted(map(str, once.collect())) == want
    covered = F.when(F.col("is_new"), F.col("date"))
    back = ingest.tagged_reload(tagged.withColumn("start_date", covered).withColumn("end_date", covered))
    assert sorted(map(str, back.collect())) == sorted(map(str, ingest.backfill_reload(old, new).collect()))


def test_jobs_leave_no_scratch(spark, tmp_path, make_daily):
    import os

    from barloom.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    rows = [(t, str(dt.date(2024, 1, 1) + dt.timedelta(days=i)), 10.0 + i) for t in ("A", "B") for i in range(40)]
    raw = make_daily(rows).select(F.col("ticker").alias("Symbol"), F.col("date").alias("Date"), "open", "high", "low", "close", F.col("adj_close").alias("Adj Close"), "volume")
    store = jobs.Warehouse(str(tmp_path / "store"))
    jobs.backfill_market(spark, raw, store, start=None)
    jobs.refresh_market(spark, raw.filter("Date >= '2024-02-01'"), store, today="2024-02-09")
    report = jobs.check_report(jobs.build_analytics(jobs.stored_frames(spark, store)), as_of="2024-02-10")
    assert {r.check_name for r in report.collect()} >= {"daily_prices: fresh", "weekly_prices: unique (ticker, week_ending)"}
    assert set(os.listdir(shared_dir(spark))) == before
