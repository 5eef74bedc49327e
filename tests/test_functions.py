"""Column helpers on small literal frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom import functions as fn


def one(spark, expr, **cells):
    row = spark.createDataFrame([tuple(cells.values())], ", ".join(
        f"{k} {'double' if isinstance(v, float) else 'string' if isinstance(v, str) else 'bigint'}"
        for k, v in cells.items()
    ))
    return row.select(expr.alias("x")).first()[0]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def apply(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_ratio_is_null_on_zero_and_null(spark):
    df = spark.createDataFrame([(0, 6.0, 3.0), (1, 6.0, 0.0), (2, None, 2.0), (3, 0.0, 5.0)], "i int, a double, b double")
    assert apply(df, fn.ratio("a", "b")) == [2.0, None, None, 0.0]
    assert apply(df, fn.pct_change("a", "b")) == [100.0, None, None, -100.0]


def test_safe_sums_count_null_as_zero(spark):
    df = spark.createDataFrame([(0, 1, 2, 3), (1, None, 2, 3), (2, None, None, None)], "i int, a int, b int, c int")
    assert apply(df, fn.safe_add(["a", "b", "c"])) == [6, 5, 0]
    assert apply(df, fn.safe_subtract(["a", "b", "c"])) == [-4, -5, 0]


def test_finite(spark):
    df = column(spark, [1.5, float("nan"), float("inf"), float("-inf"), None], "double")
    assert apply(df, fn.finite("c")) == [True, False, False, False, False]


def test_log_outside_domain_is_null(spark):
    df = column(spark, [math.e, 0.0, -1.0, None], "double")
    assert apply(df, fn.ln_positive("c")) == [1.0, None, None, None]


def test_round_half_even(spark):
    df = column(spark, [0.125, 0.375, 2.5], "double")
    assert apply(df, fn.round_half_even("c", 2)) == [0.12, 0.38, 2.5]
    assert apply(df, fn.round_half_even("c", None)) == [0.125, 0.375, 2.5]


def test_width_bucket_edges(spark):
    df = column(spark, [-5.0, 0.0, 199999.0, 200000.0, 400000.0, 599999.0, 800000.0, 900000.0], "double")
    assert apply(df, fn.width_bucket("c", 0, 800000, 4)) == [0, 1, 1, 2, 3, 3, 5, 5]


def test_haversine(spark):
    km = one(spark, fn.haversine("a", "b", "c", "d", "km"), a=0.0, b=0.0, c=0.0, d=180.0)
    assert km == pytest.approx(math.pi * 3961 * 1.60934)
    mi = one(spark, fn.haversine("a", "b", "c", "d"), a=90.0, b=0.0, c=0.0, d=37.0)
    assert mi == pytest.approx(math.pi / 2 * 3961)
    with pytest.raises(ValueError):
        fn.haversine("a", "b", "c", "d", "yd")


def test_surrogate_key(spark):
    df = spark.createDataFrame([(0, "a", "b", "c"), (1, "a", None, "c"), (2, "a", "", "c")], "i int, x string, y string, z string")
    strict = apply(df, fn.surrogate_key(["x", "y", "z"]))
    loose = apply(df, fn.surrogate_key(["x", "y", "z"], nulls_as_empty=True))
    assert strict[0] == loose[0] == "7b193b3d33184464106f41ddf733783b"
    assert len(set(strict)) == 3
    assert loose[1] == loose[2]


def test_urls(spark):
    urls = [
        "www.example.org",
        "http://shop.example.org/a/b?x=1",
        "https://shop.example.org?x=1",
        "android-app://com.example.app/path",
        "https://example.org/?utm_medium=mail&utm_source=",
        None,
    ]
    df = column(spark, urls)
    assert apply(df, fn.url_host("c")) == [
        "www.example.org", "shop.example.org", "shop.example.org", "com.example.app", "example.org", None,
    ]
    assert apply(df, fn.url_path("c"))[1:3] == ["a/b", ""]
    assert apply(df, fn.url_parameter("c", "utm_medium"))[4] == "mail"
    assert apply(df, fn.url_parameter("c", "utm_source"))[4] is None
    assert apply(df, fn.url_parameter("c", "x")) == [None, "1", "1", None, None, None]


def test_normalise_label(spark):
    df = column(spark, ["  Oslo Børs, (main) ", None, "nasdaq-GS"])
    assert apply(df, fn.normalise_label("c")) == ["OSLO B RS MAIN", "", "NASDAQ GS"]


def test_calendar(spark):
    df = column(spark, ["2021-01-03", "2024-02-29", "2020-12-31"]).withColumn("c", F.col("c").cast("date"))
    assert apply(df, fn.iso_year("c")) == [2020, 2024, 2020]
    assert apply(df, fn.iso_week("c")) == [53, 9, 53]
    assert apply(df, fn.period_start("c", "week")) == [dt.date(2020, 12, 28), dt.date(2024, 2, 26), dt.date(2020, 12, 28)]
    assert apply(df, fn.add_years("c", -1))[1] == dt.date(2023, 2, 28)
    assert apply(df, fn.year_month("c")) == ["202101", "202402", "202012"]


def test_trailing_windows(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([2, 4, 9])], "t string, i int, v double")
    w = Window.partitionBy("t").orderBy("i")
    assert apply(df, fn.trailing_mean("v", 2, w)) == [2.0, 3.0, 6.5]
    assert apply(df, fn.trailing_mean("v", 2, w, min_periods=2)) == [None, 3.0, 6.5]
    assert apply(df, fn.trailing_mean("v", 2, w, include_current=False)) == [None, 2.0, 3.0]
    assert apply(df, fn.trailing_std("v", 2, w)) == [0.0, 1.0, 2.5]
    assert apply(df, fn.lag_value("v", 2, w)) == [None, None, 2.0]
    assert apply(df, fn.lag_value("v", 2, w, missing="zero")) == [0.0, 0.0, 2.0]
    with pytest.raises(ValueError):
        fn.lag_value("v", 1, w, missing="none")


def test_recent_numbers_newest_first(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "ticker string, date int")
    rows = {(r.ticker, r.date, r.rn) for r in fn.recent(df, 2).collect()}
    assert rows == {("a", 4, 1), ("a", 3, 2), ("b", 9, 1)}


def test_six_decimals_stay_double(spark):
    from barloom.plans.queries import six

    values = [3.0e13, -3.0e13, float("inf"), float("-inf"), 1e300, 0.1234565, -0.0, 1.5]
    got = [r.v for r in six(spark.createDataFrame([(v,) for v in values], "v double")).collect()]
    assert got == [3.0e13, -3.0e13, float("inf"), float("-inf"), 1e300, 0.123456, -0.0, 1.5]
    assert str(got[6]) == "-0.0"
    nan = six(spark.createDataFrame([(float("nan"),)], "v double")).first().v
    assert nan != nan


def test_url_paths_of_all_kinds(spark):
    df = column(spark, ["a.org", "a.org/x/y?z", "http://a.org/", "a.org?x=/y", "https://a.org/p?q=/r", "", None])
    assert apply(df, fn.url_path("c")) == ["", "x/y", "", "", "p", "", None]
    assert apply(df, fn.url_host("c")) == ["a.org", "a.org", "a.org", "a.org", "a.org", "", None]
