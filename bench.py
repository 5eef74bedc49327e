"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the cores. Each
query runs once to warm up, then three times; the median counts. Every run
plans and computes the whole query from the raw tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.plans.queries import QUERIES  # noqa: E402
from barloom.session import local_session  # noqa: E402

HEADLINE = [
    "daily_bars",
    "weekly_bars",
    "monthly_bars",
    "quarterly_bars",
    "perf_52w",
    "top_movers_1d",
    "volume_surge",
    "gap_scan",
    "momentum",
    "distance_from_sma",
    "breadth",
    "scanner_52w",
    "atr_pct",
    "inside_outside_day",
    "realised_vol_rank",
    "vix_weekly",
    "regime_daily",
    "regime_weekly",
    "regime_monthly",
    "regime_quarterly",
    "return_metrics_weekly",
    "return_metrics_monthly",
    "return_metrics_quarterly",
    "correlation_matrix",
    "fundamentals_wide",
    "key_ratios_long",
    "overlap_reload",
    "normalise_bars",
    "deduplicate",
    "dq_sequential_total",
    "dq_exclusive_ranges",
    "dq_equality",
]
RUNS = 3


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
