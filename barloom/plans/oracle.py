"""The same results as :mod:`queries`, written in DuckDB SQL over the raw tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

PRICE = "100 + round(100 * l_discount) - round(100 * l_tax)"
INDEX_PRICE = "10 + round(150 * l_discount)"


def _daily(price: str = PRICE) -> str:
    return f"""
trades as (
  select p_brand as ticker, cast(l_shipdate as date) as date, {price} as px, l_quantity as qty,
         l_orderkey as o, l_linenumber as n
  from lineitem join part on l_partkey = p_partkey
),
daily as (
  select ticker, 'Brand ' || ticker as short_name, date,
         arg_min(px, (o, n, px)) as open, max(px) as high, min(px) as low,
         arg_max(px, (o, n, px)) as close, arg_max(px, (o, n, px)) - 1 as adj_close,
         cast(sum(qty) as bigint) as volume
  from trades group by ticker, date
)"""


DAILY = _daily()

# Each ticker's bars numbered from the newest, with the market's newest date.
NUMBERED = f"""{DAILY},
b as (
  select *, row_number() over (partition by ticker order by date desc) as rn,
         max(date) over () as newest, max(date) over (partition by ticker) as own_last
  from daily
)"""


def _bars(unit: str, key: str) -> str:
    return f"""
{unit}ly as (
  select ticker, arg_max(short_name, date) as short_name, max(date) as {key},
         arg_min(open, date) as open, max(high) as high, min(low) as low,
         arg_max(close, date) as close, arg_max(adj_close, date) as adj_close,
         cast(sum(volume) as bigint) as volume, max(date) as source_max_date
  from daily group by ticker, date_trunc('{unit}', date)
)"""


WEEKLY = f"{DAILY},{_bars('week', 'week_ending')}"
MONTHLY = f"{DAILY},{_bars('month', 'month_ending')}"
QUARTERLY = f"{DAILY},{_bars('quarter', 'quarter_ending')}"

BAR_COLUMNS = "ticker, short_name, date, open, high, low, close, adj_close, volume"


def oracle(name: str, sql: str, doubles: str = "") -> None:
    """Registers a query; ``doubles`` are shown with six decimals."""
    if doubles:
        cells = ", ".join(f'round_even("{c}" * 1e6, 0) / 1e6 as "{c}"' for c in doubles.split())
        sql = f"select * replace ({cells}) from ({sql}) as q"
    ORACLE[name] = sql


# --- bars -------------------------------------------------------------------

oracle("daily_bars", f"with {DAILY} select {BAR_COLUMNS} from daily")
oracle("weekly_bars", f"with {WEEKLY} select * from weekly")
oracle("monthly_bars", f"with {MONTHLY} select * from monthly")
oracle("quarterly_bars", f"with {QUARTERLY} select * from quarterly")

RESTATED = f"""{DAILY},
copies as (
  select *, 1 as load from daily
  union all
  select * replace (adj_close + 3 as adj_close), 2 as load from daily where day(date) % 2 = 0
),
newest_copy as (
  select ticker, date, arg_max(short_name, load) as short_name, arg_max(open, load) as open,
         arg_max(high, load) as high, arg_max(low, load) as low, arg_max(close, load) as close,
         arg_max(adj_close, load) as adj_close, arg_max(volume, load) as volume
  from copies group by ticker, date
)"""
oracle("latest_load", f"with {RESTATED} select {BAR_COLUMNS} from newest_copy")

oracle(
    "iso_calendar",
    """
select date, count(*) as n_items, cast(isoyear(date) as int) as iso_year,
       cast(week(date) as int) as iso_week,
       cast(date_trunc('week', date) as date) as week_start,
       cast(date_trunc('month', date) as date) as month_start,
       cast(date_trunc('quarter', date) as date) as quarter_start,
       cast(date - interval 1 year as date) as year_before, strftime(date, '%Y%m') as ym
from (select cast(l_shipdate as date) as date from lineitem) group by date
""",
)

# --- screens ----------------------------------------------------------------

LAST_YEAR = f"""{DAILY},
y as (
  select ticker, arg_max(short_name, date) as name, max(date) as last_date,
         arg_max(close, date) as last_close, max(close) as high_52w, min(close) as low_52w
  from daily
  where date >= (select cast(max(date) - interval 1 year as date) from daily)
  group by ticker
),
ranges as (
  select *, 100 * (last_close - low_52w) / nullif(low_52w, 0) as pct_from_low,
         100 * (last_close - high_52w) / nullif(high_52w, 0) as pct_from_high
  from y
)"""
oracle(
    "perf_52w",
    f"with {LAST_YEAR} select * from ranges order by pct_from_low desc nulls last, ticker limit 20",
    "pct_from_low pct_from_high",
)
oracle(
    "scanner_52w",
    f"""with {LAST_YEAR}
select ticker, name, high_52w, low_52w, last_close, pct_from_low, pct_from_high
from ranges order by pct_from_low desc nulls last, ticker limit 100""",
    "pct_from_low pct_from_high",
)
oracle(
    "top_movers_1d",
    f"""with {DAILY},
days as (select distinct date from daily order by date desc limit 2),
ends as (select max(date) as d, min(date) as p from days having count(*) = 2)
select a.ticker, a.short_name as name, a.date as last_date, a.close as close_last,
       b.close as close_prev, 100 * (a.close - b.close) / nullif(b.close, 0) as pct_change
from ends join daily a on a.date = ends.d join daily b on b.date = ends.p and a.ticker = b.ticker
order by pct_change desc nulls last, a.ticker limit 50""",
    "pct_change",
)
oracle(
    "volume_surge",
    f"""with {NUMBERED}
select ticker, arg_max(short_name, date) as name, max(date) as last_date,
       max(volume) filter (date = newest) as volume_today, avg(volume) as vol_20d_avg,
       max(volume) filter (date = newest) / nullif(avg(volume), 0) as vol_surge
from b where date >= newest - 20 group by ticker
having max(volume) filter (date = newest) is not null and avg(volume) > 0
order by vol_surge desc nulls last, ticker limit 50""",
    "vol_20d_avg vol_surge",
)
oracle(
    "gap_scan",
    f"""with {DAILY},
l as (select *, lag(close) over (partition by ticker order by date) as prev_close from daily)
select ticker, short_name as name, date, open as open_today, prev_close,
       100 * (open - prev_close) / nullif(prev_close, 0) as gap_pct
from l where date = (select max(date) from daily)
order by gap_pct desc nulls last, ticker limit 50""",
    "gap_pct",
)
oracle(
    "momentum",
    f"""with {DAILY},
l as (
  select *, lag(close, 20) over (partition by ticker order by date) as c20,
         lag(close, 60) over (partition by ticker order by date) as c60
  from daily
)
select ticker, short_name as name, close as last_close,
       100 * (close - c20) / nullif(c20, 0) as ret_20d_pct,
       100 * (close - c60) / nullif(c60, 0) as ret_60d_pct
from l where date = (select max(date) from daily)
order by ret_20d_pct desc nulls last, ticker limit 100""",
    "ret_20d_pct ret_60d_pct",
)

SMA = f"""{DAILY},
s as (
  select *,
         avg(close) over (partition by ticker order by date rows 49 preceding) as sma50,
         avg(close) over (partition by ticker order by date rows 199 preceding) as sma200,
         max(date) over (partition by ticker) as own_last
  from daily
)"""
oracle(
    "distance_from_sma",
    f"""with {SMA}
select ticker, short_name as name, close as last_close, sma50, sma200,
       100 * (close - sma50) / nullif(sma50, 0) as dist_sma50_pct,
       100 * (close - sma200) / nullif(sma200, 0) as dist_sma200_pct
from s where date = (select max(date) from daily)
order by dist_sma50_pct desc nulls last, ticker limit 100""",
    "sma50 sma200 dist_sma50_pct dist_sma200_pct",
)
oracle(
    "breadth",
    f"""with {SMA}
select 100.0 * count(*) filter (close > sma50) / count(*) as pct_above_50d,
       100.0 * count(*) filter (close > sma200) / count(*) as pct_above_200d
from s where date = own_last""",
    "pct_above_50d pct_above_200d",
)
oracle(
    "atr_pct",
    f"""with {DAILY},
p as (select *, lag(close) over (partition by ticker order by date) as pc from daily),
t as (
  select *, greatest(abs(high - low), coalesce(abs(high - pc), 0), coalesce(abs(low - pc), 0)) as tr
  from p
),
a as (
  select *, avg(tr) over (partition by ticker order by date rows 13 preceding) as atr from t
)
select ticker, short_name as name, date, close as last_close, atr as last_atr14,
       100 * atr / nullif(close, 0) as atr14_pct
from a where date = (select max(date) from daily)
order by atr14_pct desc nulls last, ticker limit 100""",
    "last_atr14 atr14_pct",
)
oracle(
    "inside_outside_day",
    f"""with {DAILY},
p as (
  select *, lag(high) over (partition by ticker order by date) as ph,
         lag(low) over (partition by ticker order by date) as pl
  from daily
),
k as (
  select *, case when high > ph and low < pl then 'outside'
                 when high < ph and low > pl then 'inside' else 'normal' end as day_type
  from p where date = (select max(date) from daily)
)
select ticker, short_name as name, date, open as open_today, high as high_today, low as low_today,
       close as close_today, day_type
from k
order by case day_type when 'outside' then 1 when 'inside' then 2 else 3 end, ticker limit 200""",
)
oracle(
    "realised_vol_rank",
    f"""with {DAILY},
r as (
  select *, case when close > 0 then ln(close) end
            - lag(case when close > 0 then ln(close) end) over (partition by ticker order by date) as ret
  from daily
),
v as (
  select *,
         case when count(ret) over w = 30 then stddev_pop(ret) over w * sqrt(252) end as rv
  from r window w as (partition by ticker order by date rows 29 preceding)
),
c as (select ticker, max(date) as last_date, arg_max(struct_pack(x := rv), date).x as cur from v group by ticker)
select v.ticker, arg_max(short_name, date) as name, max(cur) as rv30,
       100.0 * count(*) filter (rv <= cur * (1 + 1e-12)) / count(*) as rv30_rank_1y
from v join c using (ticker), (select max(date) as newest from daily)
where date >= newest - interval 1 year and last_date = newest
group by v.ticker order by rv30_rank_1y desc nulls last, v.ticker limit 100""",
    "rv30 rv30_rank_1y",
)
oracle(
    "vix_weekly",
    f"""with {_daily(INDEX_PRICE)},
w as (
  select cast(date_trunc('week', date) as date) as week_start, max(date) as last_trading_date,
         arg_max(close, date) as vix_close_raw, arg_max(adj_close, date) as vix_close_adj
  from daily where ticker = 'Brand#11' group by 1
),
l as (
  select *, lag(vix_close_raw) over (order by week_start) as pr,
         lag(vix_close_adj) over (order by week_start) as pa from w
)
select week_start, last_trading_date,
       case when vix_close_raw < 15 then 'Calm' when vix_close_raw < 20 then 'Normal'
            else 'Fear' end as vix_regime,
       vix_close_raw, vix_close_raw - pr as vix_net_change_raw,
       100 * (nullif(vix_close_raw, 0) / nullif(pr, 0) - 1) as vix_pct_change_raw_pct,
       vix_close_adj, vix_close_adj - pa as vix_net_change_adj,
       100 * (nullif(vix_close_adj, 0) / nullif(pa, 0) - 1) as vix_pct_change_adj_pct
from l where week_start >= (select max(week_start) from w) - 147""",
    "vix_net_change_raw vix_pct_change_raw_pct vix_net_change_adj vix_pct_change_adj_pct",
)
oracle(
    "trailing_windows",
    f"""with {DAILY}
select ticker, date, close, lag(close) over w as close_1, lag(close, 20) over w as close_20,
       lag(close, 60, 0) over w as close_60_or_0,
       avg(close) over (w rows 49 preceding) as sma50,
       avg(close) over (w rows between 20 preceding and 1 preceding) as prior_mean20,
       stddev_pop(close) over (w rows between 20 preceding and 1 preceding) as prior_std20,
       case when count(close) over (w rows 29 preceding) >= 30
            then avg(close) over (w rows 29 preceding) end as full_mean30
from daily window w as (partition by ticker order by date)""",
    "sma50 prior_mean20 prior_std20 full_mean30",
)
oracle(
    "series_tail",
    f"""with {DAILY}
select {BAR_COLUMNS} from daily where ticker = 'Brand#7' order by date desc limit 10""",
)

# --- regimes ------------------------------------------------------------------


def _regime(source: str, key: str, out: str, n: int, keep: int, sfx: str) -> str:
    return f"""
r0 as (
  select ticker, {key} as k, adj_close as c, lag(adj_close) over (partition by ticker order by {key}) as p
  from {source} where adj_close > 0
),
r1 as (select *, c / nullif(p, 0) - 1 as ret from r0),
r2 as (
  select *, avg(ret) over w as m, stddev_pop(ret) over w as s,
         row_number() over (partition by ticker order by k desc) as rn
  from r1 window w as (partition by ticker order by k rows between {n} preceding and 1 preceding)
),
r3 as (select *, case when s > 0 then (ret - m) / s end as z from r2 where rn <= {keep})
select ticker, k as {out}, c as close_price, p as prev_close, c - p as net_change,
       ret as pct_change, 100 * ret as pct_change_pct, m as mean_{sfx}, s as std_{sfx},
       z as zscore_{sfx},
       case when ret is null or s is null then 'N/A'
            when z is null or ret = 0 or abs(z) < 1 then 'Neutral – Typical'
            else (case when ret > 0 then 'Bull – ' else 'Bear – ' end)
                 || (case when abs(z) < 2 then 'Volatile' else 'Outlier' end) end as regime
from r3"""


def _regime_doubles(sfx: str) -> str:
    return f"net_change pct_change pct_change_pct mean_{sfx} std_{sfx} zscore_{sfx}"


oracle(
    "regime_daily",
    f"with {RESTATED},{_regime('newest_copy', 'date', 'trade_date', 20, 120, '20d')}",
    _regime_doubles("20d"),
)
oracle(
    "regime_weekly",
    f"with {WEEKLY},{_regime('weekly', 'week_ending', 'week_end', 12, 100, '12w')}",
    _regime_doubles("12w"),
)
oracle(
    "regime_monthly",
    f"with {MONTHLY},{_regime('monthly', 'month_ending', 'month_ending', 12, 60, '12m')}",
    _regime_doubles("12m"),
)
oracle(
    "regime_quarterly",
    f"with {QUARTERLY},{_regime('quarterly', 'quarter_ending', 'quarter_ending', 12, 20, '12q')}",
    _regime_doubles("12q"),
)

# --- return metrics -------------------------------------------------------------


def _metrics(source: str, key: str, keep: int, unit: str, short: str) -> str:
    edges = [("0_5", "-1", "0.05"), ("5_10", "0.05", "0.10"), ("10_15", "0.10", "0.15")]
    edges += [("15_20", "0.15", "0.20"), ("ge_20", "0.20", "1e300")]
    cells = ",\n".join(
        f"count(*) filter (abs(r) > {a} and abs(r) <= {b}) as n_{e}, "
        f"count(*) filter (abs(r) > {a} and abs(r) <= {b}) / nullif(count(r), 0)::double as b_{e}"
        for e, a, b in edges
    )
    n_sum = " + ".join(f"n_{e}" for e, _, _ in edges)
    b_sum = " + ".join(f"b_{e}" for e, _, _ in edges)
    return f"""
m0 as (
  select ticker, adj_close, {key} as k, lag(adj_close) over (partition by ticker order by {key}) as p,
         row_number() over (partition by ticker order by {key} desc) as rn
  from {source}
),
m1 as (
  select ticker, rn, adj_close, case when p > 0 then adj_close / p - 1 end as r from m0 where rn <= {keep}
),
m2 as (select *, case when 1 + r > 0 then ln(1 + r) end as g from m1),
m3 as (select *, avg(g) over (partition by ticker) as gm from m2),
m4 as (
  select ticker, count(*) as n_all, count(r) as n_r, count(g) as n_g, avg(g) as mu, stddev_pop(g) as sd,
         avg(power(g - gm, 3)) as c3, avg(power(g - gm, 4)) as c4,
         count(*) filter (r > 0) / nullif(count(r), 0)::double as hit,
         count(*) filter (abs(r) > 0.05) / nullif(count(r), 0)::double as outl,
         {cells},
         max(adj_close) filter (rn = 1) as last_close, stddev_pop(r) as rsd,
         avg(r) filter (r > 0) as up, abs(avg(r) filter (r < 0)) as down
  from m3 group by ticker
)
select ticker, n_all as n_{unit}, n_r as n_{unit}_ret_valid, n_g as n_{unit}_log_valid,
       mu as mu_log, sd as sigma_log, c3 / nullif(power(sd, 3), 0) as skew,
       c4 / nullif(power(sd, 4), 0) as kurt, hit as hit_rate, outl as pct_outlier,
       n_0_5, b_0_5, n_5_10, b_5_10, n_10_15, b_10_15, n_15_20, b_15_20, n_ge_20, b_ge_20,
       {n_sum} as bucket_count_sum, {b_sum} as bucket_sum, last_close,
       rsd * last_close as hist_em_abs, up * last_close as avg_up_dollar,
       down * last_close as avg_down_dollar, up / nullif(down, 0) as payoff,
       hit * up * last_close - (1 - hit) * down * last_close as expectancy_per_{short}
from m4"""


METRIC_DOUBLES = (
    "mu_log sigma_log skew kurt hit_rate pct_outlier b_0_5 b_5_10 b_10_15 b_15_20 b_ge_20 "
    "bucket_sum hist_em_abs avg_up_dollar avg_down_dollar payoff expectancy_per_"
)
oracle(
    "return_metrics_weekly",
    f"with {WEEKLY},{_metrics('weekly', 'week_ending', 260, 'weeks', 'wk')}",
    METRIC_DOUBLES + "wk",
)
oracle(
    "return_metrics_monthly",
    f"with {MONTHLY},{_metrics('monthly', 'month_ending', 60, 'months', 'mo')}",
    METRIC_DOUBLES + "mo",
)
oracle(
    "return_metrics_quarterly",
    f"with {QUARTERLY},{_metrics('quarterly', 'quarter_ending', 20, 'quarters', 'qtr')}",
    METRIC_DOUBLES + "qtr",
)

# --- correlation ----------------------------------------------------------------

FOCAL = ", ".join(f"'Brand#{i}'" for i in range(1, 6))
PAIRS = f"""{DAILY},
g as (
  select ticker, date, ln(adj_close / lag(adj_close) over (partition by ticker order by date)) as ret
  from daily, (select max(date) as newest from daily)
  where adj_close > 0 and date >= newest - interval 13 month
),
h as (
  select ticker, date, ret from g
  where ret is not null and date >= (select max(date) - interval 12 month from daily)
),
pairs as (
  select a.ticker as ticker_a, b.ticker as ticker_b,
         covar_pop(a.ret, b.ret) / nullif(stddev_pop(a.ret) * stddev_pop(b.ret), 0) as corr_1y,
         count(*) as n_obs
  from h a join h b on a.date = b.date
  where a.ticker in ({FOCAL})
  group by all having count(*) >= 30
)"""
oracle("correlation_pairs", f"with {PAIRS} select * from pairs", "corr_1y")
MATRIX_CELLS = ", ".join(
    f"max(corr_1y) filter (ticker_b = 'Brand#{i}') as \"Brand#{i}\"" for i in range(1, 26)
)
oracle(
    "correlation_matrix",
    f"with {PAIRS} select ticker_a, {MATRIX_CELLS} from pairs group by ticker_a",
    " ".join(f"Brand#{i}" for i in range(1, 26)),
)

# --- fundamentals -----------------------------------------------------------------

STATEMENT_LINES = {
    "income_statement": {
        "Total Revenue": "sum(ext)",
        "Cost Of Revenue": "sum(ext) filter (l_returnflag = 'R')",
        "Gross Profit": "sum(ext) - sum(ext) filter (l_returnflag = 'R')",
        "Operating Income": "sum(ext) filter (l_linestatus = 'F')",
        "Net Income": "sum(ext) filter (l_tax = 0)",
    },
    "balance_sheet": {
        "Total Assets": "sum(ext) filter (l_linenumber = 1)",
        "Total Liab": "sum(ext) filter (l_linenumber = 2)",
        "Total Stockholder Equity": "sum(ext) filter (l_linenumber = 3)",
        "Total Current Assets": "sum(ext) filter (l_linenumber = 4)",
        "Total Current Liabilities": "sum(ext) filter (l_linenumber = 5)",
        "Cash And Cash Equivalents": "sum(ext) filter (l_linenumber = 6)",
        "Long Term Debt": "sum(ext) filter (l_linenumber = 7)",
    },
    "cashflow_statement": {
        "Total Cash From Operating Activities": "sum(ext) filter (l_discount >= 0.05)",
        "Capital Expenditures": "sum(ext) filter (l_discount < 0.02)",
    },
}
CENTS = """
cents as (
  select p_brand as ticker,
         last_day(cast(date_trunc('quarter', l_shipdate) + interval 2 month as date)) as fiscal_date,
         cast(round(l_extendedprice * 100) as bigint) as ext, l_returnflag, l_linestatus, l_tax,
         l_discount, l_linenumber
  from lineitem join part on l_partkey = p_partkey
)"""
LONG = f"""{CENTS},
lines as (
  {" union all ".join(
      f"select '{s}' as statement, ticker, fiscal_date, '{m}' as metric, "
      f"cast({e} as bigint) / 100 as value from cents group by ticker, fiscal_date"
      for s, rows in STATEMENT_LINES.items() for m, e in rows.items()
  )}
),
ledger as (
  select statement, ticker, fiscal_date, 'Q' as period, metric, value, 'USD' as currency,
         'sample' as source
  from lines where value is not null
)"""
oracle("fundamentals_long", f"with {LONG} select * from ledger", "value")

WIDE_NAMES = {
    "total_revenue": "Total Revenue",
    "cost_of_revenue": "Cost Of Revenue",
    "gross_profit": "Gross Profit",
    "operating_income": "Operating Income",
    "net_income": "Net Income",
    "total_assets": "Total Assets",
    "total_liab": "Total Liab",
    "equity": "Total Stockholder Equity",
    "current_assets": "Total Current Assets",
    "current_liab": "Total Current Liabilities",
    "cash_and_equiv": "Cash And Cash Equivalents",
    "long_term_debt": "Long Term Debt",
    "cfo": "Total Cash From Operating Activities",
    "capex": "Capital Expenditures",
}
WIDE = f"""{LONG},
wide as (
  select ticker, fiscal_date, max(currency) as currency,
         {", ".join(f"max(value) filter (metric = '{m}') as {c}" for c, m in WIDE_NAMES.items())}
  from ledger group by ticker, fiscal_date
)"""
oracle("fundamentals_wide", f"with {WIDE} select * from wide", " ".join(WIDE_NAMES))

RATIO_CELLS = {
    "gross_margin": "coalesce(gross_profit / nullif(total_revenue, 0), 0)",
    "operating_margin": "coalesce(operating_income / nullif(total_revenue, 0), 0)",
    "net_margin": "coalesce(net_income / nullif(total_revenue, 0), 0)",
    "current_ratio": "coalesce(current_assets / nullif(current_liab, 0), 0)",
    "debt_to_equity": "coalesce(total_liab / nullif(equity, 0), 0)",
    "fcf": "cfo - capex",
}
oracle(
    "key_ratios_wide",
    f"""with {WIDE} select * exclude (cost_of_revenue),
{", ".join(f"{e} as {c}" for c, e in RATIO_CELLS.items())} from wide""",
    " ".join([*[c for c in WIDE_NAMES if c != "cost_of_revenue"], *RATIO_CELLS]),
)
oracle(
    "key_ratios_long",
    f"with {WIDE} "
    + " union all ".join(
        f"select ticker, fiscal_date, currency, '{c}' as metric, {e} as value from wide"
        for c, e in RATIO_CELLS.items()
    ),
    "value",
)
oracle(
    "latest_restatement",
    f"""with {LONG},
inc as (select * exclude (statement) from ledger where statement = 'income_statement')
select * replace (case when month(fiscal_date) = 3 then value + 100 else value end as value) from inc
union all select * replace ('A' as period) from inc""",
    "value",
)

# --- ingest -----------------------------------------------------------------------

oracle(
    "normalise_bars",
    """
with r as (
  select 'S' || l_suppkey as ticker, 'S' || l_suppkey as short_name, cast(l_shipdate as date) as date,
         case when l_tax <> 0.08 then l_extendedprice end as open,
         case when l_linestatus = 'F' then l_extendedprice end as high,
         l_tax as low, l_extendedprice as close,
         case when l_linenumber <= 3 then l_discount else l_quantity end as adj_close,
         cast(case when l_discount = 0.1 then 0 else l_quantity end as bigint) as volume
  from lineitem where l_linenumber <> 6 and l_returnflag <> 'N'
)
select *, 'b1' as batch_id, 'feed' as source from r""",
    "open high low close adj_close",
)
oracle(
    "flatten_two_level",
    " union all ".join(
        f"""select cast(l_shipdate as date) as date, '{f}' as ticker,
max(l_extendedprice) filter (l_returnflag = '{f}') as "Close",
sum(l_quantity) filter (l_returnflag = '{f}') as "Volume" from lineitem group by 1"""
        for f in "ANR"
    ),
    "Close Volume",
)
oracle(
    "clip_range",
    f"""with {DAILY} select {BAR_COLUMNS} from daily
where date between date '1996-02-29' and date '1997-02-28'""",
)
oracle(
    "sample_price_table",
    f"""with {DAILY} select ticker, ticker as short_name, date, open, high, low, close,
cast(null as double) as adj_close, volume from daily""",
)
oracle(
    "trading_dates",
    """
select cast(ts as date) as utc_day, cast(ts + interval 9 hour as date) as tokyo_day,
       cast(ts - interval 5 hour as date) as new_york_day, count(*) as n
from events group by all""",
)
oracle(
    "overlap_reload",
    f"""with {DAILY}, e as (select max(date) as d from daily)
select {BAR_COLUMNS} from daily, e where date < d - 21
union all
select {BAR_COLUMNS.replace("adj_close", "adj_close + 1 as adj_close")} from daily, e
where date >= d - 21 and ticker <> 'Brand#3'""",
)
oracle(
    "backfill_reload",
    f"""with {DAILY},
fresh as (
  select * replace (volume + 1 as volume) from daily
  where year(date) in (1997, 1998) and length(ticker) = 8 and day(date) <> 15
),
ends as (select ticker, min(date) as a, max(date) as b from fresh group by ticker)
select {BAR_COLUMNS} from fresh
union all
select {BAR_COLUMNS} from daily d
where not exists (select 1 from ends e where e.ticker = d.ticker and d.date between a and b)""",
)
ANNUAL = """
annual as (
  select p_brand as ticker, make_date(cast(year(l_shipdate) as int), 12, 31) as fiscal_date,
         'A' as period,
         case l_returnflag when 'A' then 'Total Revenue' when 'R' then 'Cost Of Revenue'
              else l_returnflag end as metric,
         cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) / 100 as value,
         'USD' as currency
  from lineitem join part on l_partkey = p_partkey
  group by 1, 2, 3, 4
)"""
oracle("melt_statement", f"with {ANNUAL} select *, 'feed' as source from annual", "value")
oracle(
    "combine_statements",
    f"""with {LONG},{ANNUAL}
select *, 'sample' as source from annual
union all
select ticker, fiscal_date, period, metric, value, currency, source from ledger
where statement = 'income_statement'""",
    "value",
)
LISTINGS = """
listings as (
  select o_orderpriority as exchange, cast(left(o_orderpriority, 1) as int) as priority,
         o_orderkey as pos, 'C' || o_custkey as ticker
  from orders
),
universe as (
  select ticker, exchange, priority, pos from listings
  qualify row_number() over (partition by ticker order by priority, pos) = 1
)"""
oracle("ticker_universe", f"with {LISTINGS} select * from universe")
oracle(
    "display_names",
    """
select 'C' || c_custkey as ticker,
       case when c_nationkey % 3 <> 0 then c_name
            when c_nationkey % 2 = 0 then c_mktsegment || ' ' || c_name
            when c_acctbal > 0 then 'S' || c_custkey else 'C' || c_custkey end as name,
       case when c_nationkey < 10 then 'USD' when c_nationkey < 20 then 'EUR' else '' end as currency
from customer""",
)

# --- relational helpers -------------------------------------------------------------

oracle(
    "star_prefix",
    """select o_orderkey as x_o_orderkey_y, o_custkey as x_o_custkey_y,
o_orderstatus as x_o_orderstatus_y, o_orderpriority as x_o_orderpriority_y from orders""",
)
oracle(
    "blank_to_null",
    """select * replace (case when c_nationkey >= 5 then c_mktsegment end as c_mktsegment)
from customer""",
    "c_acctbal",
)
oracle(
    "deduplicate",
    """select * replace (cast(l_shipdate as date) as l_shipdate) from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_extendedprice desc, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag,
           l_linestatus, l_shipdate) = 1""",
    "l_quantity l_extendedprice l_discount l_tax",
)
oracle("ordered_distinct", f"with {LISTINGS} select ticker, min(pos) as pos from listings group by 1")
oracle(
    "column_values",
    """select o_custkey as value, count(*) as n from orders where o_totalprice > 1e5
group by 1 order by n desc, value limit 20""",
)
oracle(
    "pivot_cells",
    """select o_orderstatus,
"""
    + ", ".join(
        f"count(*) filter (o_orderpriority = '{p}') as \"n_{p}\""
        for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    )
    + """,
max(case when o_orderstatus <> 'F' then o_totalprice else 0 end) as "top_not_F",
count(distinct case when o_orderstatus = 'O' then o_custkey end) as "O_customers"
from orders group by o_orderstatus""",
    "top_not_F",
)
oracle(
    "union_relations",
    """select 'customer' as source_relation, c_custkey, cast(c_nationkey as bigint) as nationkey,
c_acctbal as acctbal, c_mktsegment, cast(null as bigint) as s_suppkey from customer where c_acctbal > 0
union all
select 'supplier', null, s_nationkey, s_acctbal, null, s_suppkey from supplier where s_acctbal > 0""",
    "acctbal",
)
oracle(
    "unpivot",
    " union all ".join(
        f"select l_orderkey, l_linenumber, l_partkey, '{c}' as measure, {c} as amount from lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "amount",
)
oracle(
    "generate_series",
    """select g as generated_number
from (select unnest(generate_series(1, (select max(l_orderkey) from lineitem))) as g)
where g not in (select l_orderkey from lineitem)""",
)
oracle(
    "date_spine",
    """
with o as (select cast(o_orderdate as date) as day from orders),
spine as (
  select cast(unnest(generate_series(min(day), max(day) - interval 1 day, interval 1 day)) as date) as date_day
  from o
)
select date_day, count(day) as n_orders from spine left join o on day = date_day group by date_day""",
)

# --- scalar helpers -------------------------------------------------------------------

oracle(
    "safe_math",
    """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_discount / nullif(l_tax, 0) as ratio,
       100 * (l_discount - l_tax) / nullif(l_tax, 0) as pct,
       l_tax + l_discount + case when l_quantity = 1 then 0 else l_quantity end as total,
       l_quantity - l_tax - l_discount as left_over,
       case when l_discount > 0 then ln(l_discount) end as log,
       l_tax <> 0 as is_finite
from lineitem""",
    "l_extendedprice ratio pct total left_over log",
)
oracle(
    "width_bucket",
    """
select cast(case when l_extendedprice < 20000 then 0 when l_extendedprice >= 100000 then 11
            else floor((l_extendedprice - 20000) / 8000) + 1 end as int) as price_bucket,
       cast(case when l_quantity < 10 then 0 when l_quantity >= 40 then 4
            else floor((l_quantity - 10) / 10) + 1 end as int) as quantity_bucket,
       count(*) as n, min(l_extendedprice) as low, max(l_extendedprice) as high
from lineitem group by 1, 2""",
    "low high",
)
oracle(
    "haversine",
    """
with p as (
  select c_custkey, radians(c_nationkey * 3.0 - 36.0) as a1, radians((c_custkey % 360) - 180.0) as o1,
         radians(c_acctbal / 200.0) as a2, radians((c_custkey * 7 % 360) - 180.0) as o2
  from customer
),
q as (
  select c_custkey, 2 * 3961 * asin(sqrt(power(sin((a2 - a1) / 2), 2)
         + cos(a1) * cos(a2) * power(sin((o2 - o1) / 2), 2))) as miles
  from p
)
select c_custkey, miles, miles * 1.60934::double as km from q""",
    "miles km",
)
oracle(
    "surrogate_key",
    """
select o_orderkey,
       md5(o_orderkey || '-' || o_orderstatus || '-' || case when o_orderpriority = '5-LOW'
           then '_dbt_utils_surrogate_key_null_' else o_orderpriority end) as key,
       md5(o_orderkey || '-' || o_orderstatus || '-' || case when o_orderpriority = '5-LOW'
           then '' else o_orderpriority end) as loose_key
from orders""",
)
oracle(
    "url_parts",
    """
select page_id, regexp_extract(url, '^https?://([^/?]*)', 1) as host,
       regexp_extract(url, '^https?://[^/?]*/?([^?]*)', 1) as path,
       nullif(regexp_extract(url, 'page=([^&]*)', 1), '') as page,
       nullif(regexp_extract(url, 'utm_source=([^&]*)', 1), '') as utm_source
from pages""",
)
oracle(
    "normalise_label",
    """
select page_id, trim(regexp_replace(upper(url), '[^A-Z0-9]+', ' ', 'g')) as label from pages""",
)

# --- data checks ------------------------------------------------------------------------

ORDERS = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"
oracle(
    "dq_not_null",
    f"select {ORDERS}, cast(null as varchar) as o_orderstatus from orders where o_orderstatus = 'P'",
    "o_totalprice",
)
oracle(
    "dq_accepted_values",
    """select o_orderpriority as value_field, count(*) as n_rows from orders
where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""",
)
oracle(
    "dq_not_accepted_values",
    """select distinct o_orderpriority as value_field from orders
where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
)
oracle(
    "dq_unique_combination",
    "select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1",
)
oracle(
    "dq_freshness",
    """
with m as (select max(ts) as t from events),
a as (
  select t, (epoch(timestamp '2024-02-09 00:00:00') - floor(epoch(t))) / 86400.0 as age_days from m
)
select strftime(t, '%Y-%m-%d %H:%M:%S') as max_loaded_at, age_days,
       case when age_days > 15 then 'error' when age_days > 8 then 'warn' else 'pass' end as status
from a""",
    "age_days",
)
oracle(
    "dq_accepted_range",
    f"""select {ORDERS}, o_orderstatus from orders
where o_totalprice <= 5000 or o_totalprice >= 490000""",
    "o_totalprice",
)
oracle(
    "dq_at_least_one",
    """select o_custkey, count(*) filter (o_orderstatus = 'F') as n_values from orders
group by 1 having n_values = 0""",
)
oracle(
    "dq_cardinality_equality",
    """
with a as (select o_custkey as value, count(*) as num_rows from orders group by 1),
b as (select l_suppkey as value, count(*) as num_rows from lineitem group by 1)
select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
union all
select 'b_minus_a', * from (select * from b except select * from a)""",
)
TWO_ORDERS = """
a as (select o_orderkey, o_custkey, o_totalprice from orders),
b as (
  select o_orderkey, o_custkey,
         o_totalprice + case when o_orderkey % 5 = 0 then 0.00001::double
                             when o_orderkey % 7 = 0 then 1.0::double else 0.0::double end as o_totalprice
  from orders
)"""
oracle(
    "dq_equality",
    f"""with {TWO_ORDERS}
select 'a_minus_b' as which_diff, * from (
  select o_orderkey, o_totalprice from a except select o_orderkey, o_totalprice from b)
union all
select 'b_minus_a', * from (
  select o_orderkey, o_totalprice from b except select o_orderkey, o_totalprice from a)""",
    "o_totalprice",
)
oracle(
    "dq_equality_precision",
    f"""with {TWO_ORDERS},
big as (select o_orderkey, 123456789012345678901234567890::decimal(38,4) + o_orderkey as large from orders),
ra as (select o_orderkey, o_custkey, round(o_totalprice, 2) as o_totalprice, cast(cast(large as decimal(38,2)) as varchar) as large from a join big using (o_orderkey)),
rb as (
  select o_orderkey, o_custkey, round(o_totalprice, 2) as o_totalprice,
    cast(cast(large + case when o_orderkey % 11 = 0 and o_orderkey % 3 <> 0 then 0.01 else 0 end as decimal(38,2)) as varchar) as large
  from b join big using (o_orderkey)
)
select 'a_minus_b' as which_diff, * from (select * from ra except select * from rb)
union all
select 'b_minus_a', * from (select * from rb except select * from ra)""",
    "o_totalprice",
)


def _two_counts(left: str, lcol: str, right: str, rcol: str, key: str) -> str:
    return f"""
a as (select {lcol} as {key}_a, count(*) as count_a from {left} group by 1),
b as (select {rcol} as {key}_b, count(*) as count_b from {right} group by 1),
c as (select * from a full join b on {key}_a = {key}_b)"""


oracle(
    "dq_equal_rowcount",
    f"""with {_two_counts('orders', 'o_custkey', 'lineitem', 'l_suppkey', 'o_custkey')}
select *, abs(count_a - count_b) as diff_count from c""",
)
DELTA = """case when count_a > count_b then count_a - count_b when count_a = count_b then 1
else 0 end as row_count_delta"""
oracle(
    "dq_fewer_rows_than",
    f"""with {_two_counts('orders', 'o_orderkey', 'lineitem', 'l_orderkey', 'o_orderkey')}
select *, {DELTA} from c""",
)
oracle(
    "dq_fewer_rows_total",
    f"""select *, {DELTA} from (select count(*) as count_a from lineitem),
(select count(*) as count_b from orders)""",
)
oracle(
    "dq_expression_is_true",
    """select * exclude (l_shipdate) from lineitem
where not (l_quantity * l_discount <= 4.5 or l_tax > 0)""",
    "l_quantity l_extendedprice l_discount l_tax",
)


def _ranges(source: str, part: str, fits: str) -> str:
    p = f"partition by {part}" if part else ""
    cols = f"{part}, " if part else ""
    return f"""
w as (
  select {cols}a as lower_bound, b as upper_bound,
         lead(a) over ({p} order by a, b) as next_lower_bound,
         row_number() over ({p} order by a desc, b desc) = 1 as is_last
  from {source}
)
select {cols}lower_bound, upper_bound, next_lower_bound, count(*) as n_rows from w
where not (lower_bound < upper_bound and coalesce({fits}, is_last)) group by all"""


oracle(
    "dq_exclusive_ranges",
    f"""with s as (
  select o_custkey, cast(o_orderdate as date) as a,
         cast(o_orderdate as date) + cast(o_orderkey % 60 as int) as b from orders),
{_ranges('s', 'o_custkey', 'upper_bound <= next_lower_bound')}""",
)
oracle(
    "dq_exclusive_ranges_total",
    f"""with s as (
  select o_orderkey as a, o_orderkey + case when o_totalprice > 495000 then 2 else 1 end as b
  from orders),
{_ranges('s', '', 'upper_bound = next_lower_bound')}""",
)
oracle(
    "dq_not_constant",
    """select l_orderkey, count(distinct l_returnflag) as n_distinct from lineitem
group by 1 having n_distinct = 1""",
)
oracle(
    "dq_not_empty_string",
    "select * replace ('' as p_name) from part where p_size > 45",
    "p_retailprice",
)
oracle(
    "dq_not_null_proportion",
    """select l_suppkey, count(*) filter (l_tax <> 0) / count(*)::double as not_null_proportion
from lineitem group by 1 having not_null_proportion < 0.8 or not_null_proportion > 0.95""",
    "not_null_proportion",
)
oracle(
    "dq_recency",
    """select user_id, cast(max(ts) as date) as most_recent, date '2024-01-29' as threshold
from events group by 1 having cast(max(ts) as date) < date '2024-01-29'""",
)
oracle(
    "dq_relationships",
    """select l_orderkey as id, count(*) as n_rows from lineitem
where l_quantity > 2 and l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
group by 1""",
)


def _sequence(source: str, col: str, part: str, due: str) -> str:
    p = f"partition by {part}" if part else ""
    cols = f"{part}, " if part else ""
    return f"""
s as (select {cols}{col}, lag({col}) over ({p} order by {col}) as previous_{col} from {source})
select *, count(*) as n_rows from s where not ({col} = {due}) group by all"""


oracle(
    "dq_sequential_values",
    "with " + _sequence("lineitem", "l_linenumber", "l_orderkey", "previous_l_linenumber + 1"),
)
oracle(
    "dq_sequential_total",
    "with " + _sequence("lineitem", "l_orderkey", "", "previous_l_orderkey + 1"),
)
oracle(
    "dq_sequential_dates",
    f"with {DAILY}," + _sequence("daily", "date", "ticker", "previous_date + 1"),
)
oracle(
    "dq_values_differ",
    "select * exclude (l_shipdate) from lineitem where l_tax <> 0 and l_discount <> l_tax",
    "l_quantity l_extendedprice l_discount l_tax",
)
oracle(
    "dq_exchange_mismatches",
    f"""with {LISTINGS},
x as (
  select u.ticker, u.exchange as expected, coalesce(c_mktsegment, '') as actual
  from universe u left join customer on u.ticker = 'C' || c_custkey
)
select * from x where not (
  (expected = '1-URGENT' and (contains(actual, 'AUTO') or contains(actual, 'BUILD')))
  or (expected = '2-HIGH' and contains(actual, 'MACHIN'))
  or (expected = '3-MEDIUM' and (contains(actual, 'HOUSE') or contains(actual, 'FURN')))
  or (expected = '4-NOT SPECIFIED' and contains(actual, 'BUILD'))
  or (ticker = 'C1' and expected = '1-URGENT' and contains(actual, 'MACHIN'))
  or (ticker = 'C2' and expected = '1-URGENT' and contains(actual, 'FURN')))""",
)
oracle(
    "dq_row_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from {t}"
        for t in ["orders", "lineitem", "customer", "part", "supplier", "events"]
    ),
)
KNOWN = """('N/A', 'Neutral – Typical', 'Bull – Volatile', 'Bear – Volatile', 'Bull – Outlier',
'Bear – Outlier')"""


def _nulls(name: str, source: str, columns: list[str]) -> str:
    total = " + ".join(f"count(*) filter ({c} is null)" for c in columns)
    return f"select '{name}: not null ({', '.join(columns)})', {total} from {source}"


def _copies(name: str, source: str, key: list[str]) -> str:
    k = ", ".join(key)
    return f"""select '{name}: unique ({k})', count(*) from (
  select {k} from {source} group by {k} having count(*) > 1)"""


def _unknown(name: str, source: str) -> str:
    return f"select '{name}: known regime', count(*) filter (regime not in {KNOWN}) from {source}"


REQUIRED = {
    "weekly_prices": ["ticker", "week_ending"],
    "monthly_prices": ["ticker", "month_ending"],
    "quarterly_prices": ["ticker", "quarter_ending"],
    "perf_52w": ["ticker", "last_date", "last_close"],
    "top_movers_1d": ["ticker", "last_date", "close_last"],
    "volume_surge": ["ticker", "last_date", "volume_today"],
    "gap_scan": ["ticker", "date", "open_today"],
    "momentum": ["ticker", "last_close"],
    "distance_from_sma": ["ticker", "last_close"],
    "breadth": ["pct_above_50d", "pct_above_200d"],
    "scanner_52w": ["ticker", "last_close"],
    "atr_pct": ["ticker", "date", "last_close"],
    "inside_outside_day": ["ticker", "date", "day_type"],
    "realised_vol_rank": ["ticker"],
    "vix_weekly": ["week_start", "last_trading_date"],
    "regime_daily": ["ticker", "trade_date"],
    "regime_weekly": ["ticker", "week_end"],
    "regime_monthly": ["ticker", "month_ending"],
    "regime_quarterly": ["ticker", "quarter_ending"],
    "return_metrics_weekly": ["ticker"],
    "return_metrics_monthly": ["ticker"],
    "return_metrics_quarterly": ["ticker"],
    "correlation_matrix": ["ticker_a"],
    "fundamentals_long": ["ticker", "fiscal_date", "statement", "metric"],
    "fundamentals_wide": ["ticker", "fiscal_date"],
    "key_ratios_wide": ["ticker", "fiscal_date"],
    "key_ratios_long": ["ticker", "fiscal_date"],
}
BARS = {"weekly_prices": "weekly_bars", "monthly_prices": "monthly_bars", "quarterly_prices": "quarterly_bars"}
REGIMES = ["regime_daily", "regime_weekly", "regime_monthly", "regime_quarterly"]
REPORT = " union all ".join(
    [
        *(_nulls(n, f"({ORACLE[BARS.get(n, n)]}) as t", columns) for n, columns in REQUIRED.items()),
        "select 'daily_prices: not null (ticker, short_name, date, ingested_at)', "
        "count(*) filter (ticker is null or short_name is null or date is null) from daily",
        _copies("daily_prices", "daily", ["ticker", "date"]),
        *(_copies(n, f"({ORACLE[q]})", REQUIRED[n]) for n, q in BARS.items()),
        *(_unknown(n, f"({ORACLE[n]}) as t") for n in REGIMES),
        "select 'vix_weekly: known level', count(*) filter (vix_regime not in ('Calm', 'Normal', 'Fear')) "
        f"from ({ORACLE['vix_weekly']}) as t",
        "select 'daily_prices: volume >= 0', count(*) filter (volume < 0) from daily",
        # the sample rows are stamped 2002-01-01, four days before the report's date
        "select 'daily_prices: fresh', 0",
    ]
)
oracle(
    "check_report",
    f"""with {DAILY}, c(check_name, failures) as ({REPORT})
select check_name, cast(failures as bigint) as failures,
       case when failures > 0 then 'error' else 'pass' end as status
from c""",
)

# --- streams --------------------------------------------------------------------------------

for _name, _days in (("stream_weekly_bars", 7), ("stream_weekly_late", 21)):
    oracle(
        _name,
        f"""
with w as (
  select event_type as ticker, cast(date_trunc('week', ts) as date) as week_start,
         cast(max(ts) as date) as week_ending, arg_min(value, ts) as open, max(value) as high,
         min(value) as low, arg_max(value, ts) as close, count(*) as volume
  from events group by 1, 2
)
select * from w where week_start + 7 <= (select max(ts) from events) - interval {_days} day""",
        "open high low close",
    )
REFRESHED = BAR_COLUMNS.replace(
    "adj_close", "adj_close + case when date >= d - 21 then 2 else 0 end as adj_close"
)
for _name in ("stream_ingest", "stream_ingest_split", "market_refresh"):
    oracle(
        _name,
        f"with {DAILY}, e as (select max(date) as d from daily) select {REFRESHED} from daily, e",
    )

# --- stored tables --------------------------------------------------------------------------

oracle(
    "stored_daily_since",
    f"with {DAILY} select {BAR_COLUMNS} from daily where date >= date '2000-03-15'",
)
oracle("stored_weekly_bars", f"with {WEEKLY} select * from weekly")
oracle("published_view", f"with {WEEKLY} select ticker, count(*) as n_weeks from weekly group by 1")
oracle(
    "stored_statements",
    f"with {LONG} select * exclude (statement) from ledger where statement = 'balance_sheet'",
    "value",
)
oracle("csv_seed", "select * from supplier", "s_acctbal")
READABLE = LONG.replace("where value is not null", "where value is not null and cast(round(value * 100) as bigint) % 10 <> 0")
oracle(
    "fundamentals_refresh",
    f"""with {WIDE.replace(LONG, READABLE)}
select *, (select count(*) from lines where value is not null and cast(round(value * 100) as bigint) % 10 = 0)
  + (select count(*) from (select distinct ticker, metric from lines where value is not null)) as n_rejects
from wide""",
    " ".join(WIDE_NAMES),
)
for _name, _same in (("stored_scanner_52w", "scanner_52w"), ("stored_vix_weekly", "vix_weekly"), ("stored_correlation", "correlation_pairs")):
    ORACLE[_name] = ORACLE[_same]

# --- as published ---------------------------------------------------------------------------


def _rounded(name: str, columns: str, digits: int, shown: str = "*") -> None:
    """The unrounded result, rounded half to even."""
    cells = ", ".join(f'round_even("{c}", {digits}) as "{c}"' for c in columns.split())
    ORACLE[f"{name}_rounded"] = f"select {shown} from (select * replace ({cells}) from ({ORACLE[name]}) as q) as r"


_rounded("scanner_52w", "pct_from_low pct_from_high", 2)
_rounded("atr_pct", "atr14_pct", 2, "ticker, atr14_pct")
_rounded(
    "vix_weekly",
    "vix_close_raw vix_close_adj vix_net_change_raw vix_pct_change_raw_pct vix_net_change_adj vix_pct_change_adj_pct",
    2,
)
_rounded("correlation_matrix", " ".join(f"Brand#{i}" for i in range(1, 26)), 3)

oracle(
    "pivot_map",
    """select l_returnflag, count(*) as n_cells, min(line) as first_line, max(line) as last_line,
  cast(sum(q) as bigint) as quantity, cast(sum(line % 1000 * q) as bigint) as weighted
from (
  select l_returnflag, l_orderkey * 8 + l_linenumber as line, cast(sum(l_quantity) as bigint) as q from lineitem group by 1, 2
) group by 1""",
)
oracle(
    "as_of_today",
    """select newest_order, true as is_today, current_date as today, cast(current_date - interval 1 year as date) as year_start,
  date_diff('day', newest_order, current_date) as age_days
from (select max(cast(o_orderdate as date)) as newest_order from orders)""",
)
