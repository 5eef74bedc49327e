"""Column expressions. Everything here stays inside the JVM; there are no UDFs."""

from .dates import add_years, as_date_col, iso_week, iso_year, newest_date, newest_dates, period_start, since, year_month
from .numeric import (
    finite,
    haversine,
    ln_positive,
    null_blank,
    or_zero,
    pct_change,
    ratio,
    round_half_even,
    safe_add,
    safe_subtract,
    width_bucket,
)
from .text import normalise_label, surrogate_key, url_host, url_parameter, url_path
from .windows import lag_value, recent, trailing_mean, trailing_std

__all__ = [
    "add_years",
    "as_date_col",
    "finite",
    "haversine",
    "iso_week",
    "iso_year",
    "lag_value",
    "ln_positive",
    "newest_date",
    "newest_dates",
    "normalise_label",
    "null_blank",
    "or_zero",
    "pct_change",
    "period_start",
    "ratio",
    "recent",
    "round_half_even",
    "safe_add",
    "safe_subtract",
    "since",
    "surrogate_key",
    "trailing_mean",
    "trailing_std",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
    "year_month",
]
