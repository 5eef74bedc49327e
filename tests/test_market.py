"""Screens, regimes and metrics on series short enough to check by hand."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars, correlation, fundamentals, metrics, regimes, signals
from barloom.sources import listings

D0 = dt.date(2023, 1, 2)


def days(n, start=D0):
    return [str(start + dt.timedelta(days=i)) for i in range(n)]


def series(ticker, closes, start=D0):
    return [(ticker, d, float(c)) for d, c in zip(days(len(closes), start), closes)]


def by_ticker(df):
    return {r.ticker: r for r in df.collect()}


def test_week_spanning_two_years_is_one_bar(make_daily):
    daily = make_daily(series("A", [10, 11, 12, 13, 14], dt.date(2020, 12, 30)))
    rows = sorted(bars.weekly_bars(daily).collect(), key=lambda r: r.week_ending)
    assert [(r.week_ending, r.open, r.close, r.volume) for r in rows] == [
        (dt.date(2021, 1, 3), 10.0, 14.0, 500)
    ]
    assert rows[0].source_max_date == dt.date(2021, 1, 3)
    assert rows[0].built_at is not None


def test_bars_take_the_name_of_the_last_day(make_daily):
    daily = make_daily(series("A", [1, 2, 3]))
    renamed = daily.withColumn("short_name", F.concat(F.lit("n"), F.col("close").cast("int")))
    assert bars.monthly_bars(renamed).first().short_name == "n3"


def test_bar_volume_and_bounds(make_daily):
    random.seed(1)
    closes = [random.uniform(5, 50) for _ in range(400)]
    daily = make_daily(series("A", closes) + series("B", closes[::-1]))
    total = daily.agg(F.sum("volume")).first()[0]
    for period in ("week", "month", "quarter"):
        b = bars.period_bars(daily, period)
        assert b.agg(F.sum("volume")).first()[0] == total
        assert b.filter("low > open or low > close or high < open or high < close").count() == 0


def test_latest_load_wins(make_daily):
    old = make_daily([("A", "2023-01-02", 1.0), ("A", "2023-01-03", 2.0)])
    new = make_daily([("A", "2023-01-03", 9.0)], "2024-02-01 00:00:00")
    both = old.unionByName(new)
    for df in (bars.latest_load(both), bars.latest_load(both, ["adj_close"])):
        assert {r.date.day: r.adj_close for r in df.collect()} == {2: 1.0, 3: 9.0}


def test_range_screens_cut_at_a_leap_day(make_daily):
    daily = make_daily(
        [("A", "2023-02-27", 1.0), ("A", "2023-02-28", 5.0), ("A", "2024-02-29", 10.0), ("Z", "2022-01-01", 3.0)]
    )
    row = by_ticker(signals.scanner_52w(daily))
    assert set(row) == {"A"}
    assert (row["A"].low_52w, row["A"].high_52w, row["A"].pct_from_low) == (5.0, 10.0, 100.0)
    assert by_ticker(signals.perf_52w(daily, "2024-02-29"))["A"].pct_from_high == 0.0
    assert signals.perf_52w(daily, "2025-06-01").count() == 0


def test_zero_low_gives_null_not_an_error(make_daily):
    daily = make_daily(series("A", [0, 5]) + series("B", [4, 5]))
    rows = signals.scanner_52w(daily).collect()
    assert [(r.ticker, r.pct_from_low) for r in rows] == [("B", 25.0), ("A", None)]


def test_movers_need_both_days(make_daily):
    daily = make_daily(series("A", [10, 11]) + series("B", [10, 8]) + [("C", days(2)[1], 7.0), ("D", days(1)[0], 7.0)])
    rows = signals.top_movers_1d(daily).collect()
    assert [(r.ticker, r.pct_change) for r in rows] == [("A", 10.0), ("B", -20.0)]
    assert signals.top_movers_1d(make_daily([("A", "2023-01-02", 1.0)])).count() == 0


def test_volume_surge_uses_calendar_days(make_daily):
    def bar(day, volume):
        return ("A", day, 1.0, 1.0, 1.0, 1.0, 1.0, volume)

    daily = make_daily([bar("2023-01-01", 1000), bar("2023-01-11", 10), bar("2023-01-31", 30)])
    row = signals.volume_surge(daily).first()
    assert (row.volume_today, row.vol_20d_avg, row.vol_surge) == (30, 20.0, 1.5)


def test_snapshot_screens_keep_only_the_newest_date(make_daily):
    daily = make_daily(series("A", [10, 20, 30]) + series("OLD", [1, 100]) + [("NEW", days(3)[2], 5.0)])
    for screen in (signals.gap_scan, signals.momentum, signals.distance_from_sma, signals.atr_pct,
                   signals.inside_outside_day, signals.realised_vol_rank):
        assert {r.ticker for r in screen(daily).collect()} == {"A", "NEW"}


def test_snapshot_screen_limit_smaller_than_market(make_daily):
    rows = [r for i in range(30) for r in series(f"T{i:02d}", [10, 10 + i])]
    rows += [r for i in range(30) for r in series(f"OLD{i}", [1])]
    out = signals.gap_scan(make_daily(rows), k=5).collect()
    assert [r.ticker for r in out] == ["T29", "T28", "T27", "T26", "T25"]


def test_gap_of_a_single_bar_is_null(make_daily):
    row = signals.gap_scan(make_daily([("A", "2023-01-02", 5.0)])).first()
    assert (row.prev_close, row.gap_pct) == (None, None)


def test_momentum_counts_rows(make_daily):
    row = signals.momentum(make_daily(series("A", range(1, 62)))).first()
    assert row.ret_20d_pct == pytest.approx(100 * (61 - 41) / 41)
    assert row.ret_60d_pct == pytest.approx(6000.0)


def test_short_history_still_has_a_mean(make_daily):
    row = signals.distance_from_sma(make_daily(series("A", [10, 20, 30]))).first()
    assert (row.sma50, row.sma200, row.dist_sma50_pct) == (20.0, 20.0, 50.0)


def test_breadth_counts_stale_tickers(make_daily):
    daily = make_daily(series("UP", [1, 2, 3]) + series("DOWN", [3, 2, 1]) + series("STALE", [1, 2]))
    row = signals.breadth(daily).first()
    assert row.pct_above_50d == pytest.approx(200 / 3)


def test_atr_first_bar(make_daily):
    daily = make_daily([("A", "2023-01-02", 10.0, 12.0, 9.0, 10.0, 10.0, 1)])
    assert signals.atr_pct(daily).first().last_atr14 == 3.0
    assert signals.atr_pct(daily, missing="zero").first().last_atr14 == 12.0


def test_atr_of_long_history_ignores_what_is_older(make_daily):
    random.seed(3)
    rows = []
    for d in days(40):
        low = random.uniform(5, 10)
        rows.append(("A", d, low, low + random.random(), low, low + 0.3, 1.0, 1))
    trs = []
    for prev, cur in zip(rows, rows[1:]):
        high, low, pc = cur[3], cur[4], prev[5]
        trs.append(max(high - low, abs(high - pc), abs(low - pc)))
    row = signals.atr_pct(make_daily(rows), digits=None).first()
    assert row.last_atr14 == pytest.approx(statistics.fmean(trs[-14:]))


@pytest.mark.parametrize(
    "today, kind",
    [((13.0, 8.0), "outside"), ((11.0, 9.5), "inside"), ((12.0, 9.5), "normal"), ((13.0, 9.5), "normal")],
)
def test_day_type(make_daily, today, kind):
    high, low = today
    daily = make_daily(
        [("A", "2023-01-02", 10.0, 12.0, 9.0, 10.0, 10.0, 1), ("A", "2023-01-03", 10.0, high, low, 10.0, 10.0, 1)]
    )
    assert signals.inside_outside_day(daily).first().day_type == kind


def test_day_type_order(make_daily):
    rows = []
    for ticker, high, low in [("C", 11.0, 9.5), ("B", 13.0, 8.0), ("A", 12.0, 9.0)]:
        rows += [(ticker, "2023-01-02", 10.0, 12.0, 9.0, 10.0, 10.0, 1), (ticker, "2023-01-03", 10.0, high, low, 10.0, 10.0, 1)]
    out = signals.inside_outside_day(make_daily(rows)).collect()
    assert [(r.ticker, r.day_type) for r in out] == [("B", "outside"), ("C", "inside"), ("A", "normal")]


def test_realised_vol_by_hand(make_daily):
    random.seed(5)
    closes = [100.0]
    for _ in range(499):
        closes.append(closes[-1] * math.exp(random.gauss(0, 0.01)))
    rets = [math.log(b / a) for a, b in zip(closes, closes[1:])]
    vols = [statistics.pstdev(rets[i - 29 : i + 1]) * math.sqrt(252) for i in range(29, len(rets))]
    last_year = vols[-367:]  # both ends and a leap day
    row = signals.realised_vol_rank(make_daily(series("A", closes)), digits=None).first()
    assert row.rv30 == pytest.approx(vols[-1])
    share = 100 * sum(v <= vols[-1] * (1 + 1e-12) for v in last_year) / len(last_year)
    assert row.rv30_rank_1y == pytest.approx(share)


def test_realised_vol_needs_a_full_frame(make_daily):
    row = signals.realised_vol_rank(make_daily(series("A", range(1, 31)))).first()
    assert (row.rv30, row.rv30_rank_1y) == (None, 0.0)


def test_vix_levels_and_changes(make_daily):
    closes = [(d, c) for d, c in zip(["2023-01-06", "2023-01-13", "2023-01-19"], [14.0, 0.0, 21.0])]
    daily = make_daily([("^VIX", d, c) for d, c in closes] + series("A", [1, 2]))
    rows = sorted(signals.vix_weekly(daily).collect(), key=lambda r: r.week_start)
    assert [r.vix_regime for r in rows] == ["Calm", "Calm", "Fear"]
    assert [r.vix_net_change_raw for r in rows] == [None, -14.0, 21.0]
    assert [r.vix_pct_change_raw_pct for r in rows] == [None, None, None]
    assert rows[0].week_start == dt.date(2023, 1, 2)


def test_vix_keeps_22_weeks(make_daily):
    daily = make_daily(series("^VIX", [16] * 300))
    assert signals.vix_weekly(daily).count() == 22


def test_constant_series_is_typical(make_daily):
    rows = sorted(regimes.regime_daily(make_daily(series("A", [5] * 6))).collect(), key=lambda r: r.trade_date)
    assert [r.regime for r in rows] == ["N/A", "N/A"] + ["Neutral – Typical"] * 4
    assert all(r.zscore_20d is None for r in rows)


def test_regime_by_hand(make_daily):
    random.seed(11)
    closes = [100 * math.exp(random.gauss(0, 0.05)) for _ in range(300)]
    out = sorted(regimes.regime_daily(make_daily(series("A", closes)), digits=None).collect(), key=lambda r: r.trade_date)
    assert len(out) == 120
    rets = [b / a - 1 for a, b in zip(closes, closes[1:])]
    seen = set()
    for i, row in enumerate(out):
        k = len(rets) - 120 + i
        past = rets[k - 20 : k]
        z = (rets[k] - statistics.fmean(past)) / statistics.pstdev(past)
        assert row.zscore_20d == pytest.approx(z)
        side = "Bull" if rets[k] > 0 else "Bear"
        want = "Neutral – Typical" if abs(z) < 1 else f"{side} – {'Volatile' if abs(z) < 2 else 'Outlier'}"
        assert row.regime == want
        seen.add(want)
    assert len(seen) == 5


def test_regime_drops_invalid_prices_before_the_lag(make_daily):
    rows = sorted(regimes.regime_daily(make_daily(series("A", [10, 0, 11]))).collect(), key=lambda r: r.trade_date)
    assert [(r.close_price, r.prev_close) for r in rows] == [(10.0, None), (11.0, 10.0)]


def test_metrics_by_hand(make_daily):
    random.seed(7)
    closes = [100 * math.exp(random.gauss(0, 0.1)) for _ in range(40)]
    rows = [("A", str(D0 + dt.timedelta(weeks=i)), c) for i, c in enumerate(closes)]
    row = metrics.return_metrics(bars.weekly_bars(make_daily(rows)), keep=30).first()
    rets = [b / a - 1 for a, b in zip(closes, closes[1:])][-30:]
    logs = [math.log(1 + r) for r in rets]
    mu, sd = statistics.fmean(logs), statistics.pstdev(logs)
    assert (row.n_weeks, row.n_weeks_ret_valid, row.n_weeks_log_valid) == (30, 30, 30)
    assert row.mu_log == pytest.approx(mu)
    assert row.sigma_log == pytest.approx(sd)
    assert row.skew == pytest.approx(statistics.fmean([((x - mu) / sd) ** 3 for x in logs]))
    assert row.kurt == pytest.approx(statistics.fmean([((x - mu) / sd) ** 4 for x in logs]))
    up = statistics.fmean([r for r in rets if r > 0])
    down = abs(statistics.fmean([r for r in rets if r < 0]))
    hit = sum(r > 0 for r in rets) / 30
    assert row.payoff == pytest.approx(up / down)
    assert row.expectancy_per_wk == pytest.approx((hit * up - (1 - hit) * down) * closes[-1])
    assert row.bucket_count_sum == 30
    assert row.bucket_sum == pytest.approx(1.0)


def test_metrics_of_one_bar(make_daily):
    row = metrics.return_metrics_weekly(bars.weekly_bars(make_daily([("A", "2023-01-02", 5.0)]))).first()
    assert (row.n_weeks, row.n_weeks_ret_valid, row.last_close) == (1, 0, 5.0)
    assert row.payoff is None and row.expectancy_per_wk is None and row.mu_log is None


def test_correlation(make_daily):
    random.seed(2)
    steps = [random.gauss(0, 0.02) for _ in range(60)]

    def walk(sign):
        out = [100.0]
        for s in steps:
            out.append(out[-1] * math.exp(sign * s))
        return out

    rows = series("A", walk(1)) + series("B", walk(-1)) + series("FLAT", [7] * 61) + series("FEW", walk(1)[:10])
    daily = make_daily(rows)
    last = days(61)[-1]
    pairs = {
        (r.ticker_a, r.ticker_b): (r.corr_1y, r.n_obs)
        for r in correlation.correlation_pairs(daily, ["A", "FLAT"], None, last, 30).collect()
    }
    assert pairs[("A", "A")] == (pytest.approx(1.0), 60)
    assert pairs[("A", "B")] == (pytest.approx(-1.0), 60)
    assert pairs[("A", "FLAT")] == (None, 60)
    assert ("A", "FEW") not in pairs and ("FLAT", "B") in pairs
    matrix = correlation.correlation_matrix(daily, ["A"], ["B", "FEW"], as_of=last, min_obs=30).first()
    assert (matrix["B"], matrix["FEW"]) == (-1.0, None)


def test_zero_in_place_of_what_is_missing(spark, make_daily):
    one = make_daily([("A", "2024-01-02", 5.0)])
    gap = signals.gap_scan(one, missing="zero").first()
    assert (gap.prev_close, gap.gap_pct) == (0.0, None)
    row = regimes.regime(one, missing="zero").first()
    assert (row.prev_close, row.net_change, row.pct_change, row.regime) == (0.0, 5.0, None, "N/A")
    vix = signals.vix_weekly(one, "A", missing="zero").first()
    assert (vix.vix_net_change_raw, vix.vix_pct_change_raw_pct) == (5.0, None)
    two = make_daily([("A", "2024-01-02", 5.0), ("A", "2024-01-03", 6.0)])
    matrix = correlation.correlation_matrix(two, ["A"], ["A", "B"], as_of="2024-01-03", min_obs=1, missing="zero")
    assert matrix.first()["B"] == 0.0
    ledger = spark.createDataFrame(
        [("T", "2023-12-31", "Q", "Net Income", 3.0, "USD", "s", "2024-01-01")],
        "ticker string, fiscal_date string, period string, metric string, value double, currency string, source string, loaded_at string",
    )
    long = fundamentals.fundamentals_long(ledger, ledger.limit(0), ledger.limit(0))
    assert fundamentals.fundamentals_wide(long, missing="zero").first().total_revenue == 0.0
    assert fundamentals.fundamentals_wide(long).first().total_revenue is None


def test_default_matrix_against_direct_sums(spark, make_daily):
    """All 26 rows and 25 columns of the default lists, with gaps in the series."""
    rng = random.Random(17)
    tickers = sorted(set(listings.CORRELATION_FOCAL) | set(listings.CORRELATION_UNIVERSE))
    rows, rets = [], {}
    for t in tickers:
        price, mine, last = 100.0, {}, None
        for i, d in enumerate(days(45)):
            price *= math.exp(rng.gauss(0, 0.02))
            if rng.random() < 0.05:
                continue
            rows.append((t, d, price))
            if last is not None:
                mine[i] = math.log(price / last)
            last = price
        rets[t] = mine
    daily = make_daily(rows)
    out = correlation.correlation_matrix(
        daily,
        listings.CORRELATION_FOCAL,
        listings.CORRELATION_UNIVERSE,
        listings.CORRELATION_COLUMNS,
        as_of=days(45)[-1],
        min_obs=38,
        digits=None,
    )
    got = {r.ticker_a: r.asDict() for r in out.collect()}
    assert out.columns == ["ticker_a", *listings.CORRELATION_COLUMNS]
    seen = 0
    for a in listings.CORRELATION_FOCAL:
        for b in listings.CORRELATION_COLUMNS:
            both = sorted(set(rets[a]) & set(rets[b]))
            value = got[a][b] if a in got else None
            if len(both) < 38:
                assert value is None
                continue
            x, y = [rets[a][i] for i in both], [rets[b][i] for i in both]
            assert value == pytest.approx(statistics.correlation(x, y))
            seen += 1
    assert seen > 200


def test_long_focal_lists_go_block_by_block(make_daily):
    rng = random.Random(3)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(8)]
    rows = [("A", str(d), rng.uniform(9, 11)) for d in days] + [("B", str(d), rng.uniform(9, 11)) for d in days]
    focal = [f"T{i}" for i in range(499)] + ["A", "B"]
    out = correlation.correlation_pairs(make_daily(rows), focal, ["A", "B"], "2024-01-08", min_obs=3)
    assert sorted((r.ticker_a, r.ticker_b) for r in out.collect()) == [("A", "A"), ("A", "B"), ("B", "A"), ("B", "B")]


def test_vol_rank_takes_the_year_by_date(make_daily):
    """Two loads of each day: the year is whole all the same."""
    rng = random.Random(8)
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(700)]
    rows = [("A", str(d), rng.uniform(9, 11)) for d in days]
    once = signals.realised_vol_rank(make_daily(rows), digits=None).first()
    bars = make_daily(rows)
    year = bars.filter(F.col("date") >= F.lit(str(days[-1].replace(year=days[-1].year - 1))))
    assert year.count() == 366 and once.rv30_rank_1y is not None
    doubled = signals.realised_vol_rank(bars.union(bars), digits=None).first()
    assert doubled is not None and 0 <= doubled.rv30_rank_1y <= 100


def test_screens_without_a_limit(make_daily):
    rows = [(t, "2024-01-02", 1.0) for t in "ABC"] + [("D", "2024-01-01", 1.0)]
    assert signals.gap_scan(make_daily(rows), k=None).count() == 3


def test_correlations_of_more_focal_tickers_than_a_block(make_daily, monkeypatch):
    """Pairs in several blocks of focal tickers are those of one."""
    rng = random.Random(3)
    rows = [(f"T{k}", str(dt.date(2024, 1, 1) + dt.timedelta(days=i)), rng.uniform(9, 11)) for k in range(7) for i in range(60) if rng.random() < 0.9]
    daily, names = make_daily(rows), [f"T{k}" for k in range(7)]
    one = correlation.correlation_pairs(daily, names, None, "2024-03-10", min_obs=20).collect()
    monkeypatch.setattr(correlation, "FOCAL_BLOCK", 3)
    many = correlation.correlation_pairs(daily, names, None, "2024-03-10", min_obs=20).collect()
    assert len(one) == 49 and sorted(one) == sorted(many)
    mirrored = {(r.ticker_a, r.ticker_b): round(r.corr_1y, 9) for r in one}
    assert all(mirrored[a, b] == mirrored[b, a] for a, b in mirrored) and mirrored["T1", "T1"] == 1
    other = correlation.correlation_pairs(daily, ["T0", "T5"], ["T5", "T6"], "2024-03-10", min_obs=20).collect()
    assert {(r.ticker_a, r.ticker_b) for r in other} == {(a, b) for a in ("T0", "T5") for b in ("T5", "T6")}
    assert correlation.correlation_pairs(daily, [], None, "2024-03-10").count() == 0


def test_movers_between_the_two_newest_dates(spark, make_daily, tmp_path):
    rows = [("A", "2024-01-31", 10.0), ("A", "2024-03-04", 11.0), ("B", "2024-01-31", 4.0), ("C", "2024-03-04", 1.0), ("A", "2023-01-31", 1.0)]
    moved = signals.top_movers_1d(make_daily(rows)).collect()
    assert [(r.ticker, r.close_prev, r.close_last, r.pct_change) for r in moved] == [("A", 10.0, 11.0, 10.0)]
    assert signals.top_movers_1d(make_daily(rows[:1])).count() == 0  # one date only
    assert signals.top_movers_1d(make_daily([])).count() == 0
    from barloom.sources import tables

    path = str(tmp_path / "daily")
    tables.append_daily(make_daily(rows), path)
    stored = tables.daily_prices(spark, path)
    assert signals.top_movers_1d(stored).collect() == moved
    tables.append_daily(make_daily([("Z", "2022-01-03", 1.0)]), path)
    assert len(tables.daily_prices(spark, path).inputFiles()) >= 4
    assert signals.top_movers_1d(tables.daily_prices(spark, path)).collect() == moved


def test_volatility_year_with_leap_day_and_a_long_gap(make_daily):
    """All days of a leap year and a first return from long before count."""
    rng = random.Random(4)
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(5)] + [dt.date(2020, 1, 15) + dt.timedelta(days=i) for i in range(400)]
    rows = [("A", str(d), rng.uniform(9, 11)) for d in days] + [("B", "2019-06-01", 3.0)]
    got = signals.realised_vol_rank(make_daily(rows), n=3, digits=None).collect()
    closes = [c for _, _, c in rows[:-1]]
    returns = [None] + [math.log(b / a) for a, b in zip(closes, closes[1:])]
    vols = [statistics.pstdev(returns[i - 2 : i + 1]) if i > 2 else None for i in range(len(closes))]
    year = [v for v, d in zip(vols, days) if d >= dt.date(days[-1].year - 1, days[-1].month, days[-1].day)]
    assert [r.ticker for r in got] == ["A"]
    assert got[0].rv3_rank_1y == pytest.approx(100 * sum(v <= vols[-1] * (1 + 1e-12) for v in year) / len(year))
