"""Numeric expressions that hold under ANSI mode (no division-by-zero errors)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MI = 3961
UNIT_FACTORS = {"mi": 1.0, "km": 1.60934}


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: ColumnOrName) -> Column:
    """True for a value that is neither NULL, NaN nor infinite."""
    x = _col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double; NULL when either is NULL or den is 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def pct_change(current: ColumnOrName, base: ColumnOrName) -> Column:
    """100 * (current - base) / base; NULL when base is 0 or NULL."""
    return ratio(F.lit(100) * (_col(current) - _col(base)), base)


def ln_positive(c: ColumnOrName) -> Column:
    """Natural log, NULL outside the domain."""
    x = _col(c)
    return F.when(x > 0, F.ln(x))


def round_half_even(c: ColumnOrName, digits: int | None) -> Column:
    """Half-to-even rounding; ``digits=None`` leaves the value alone."""
    return _col(c) if digits is None else F.bround(_col(c), digits)


def safe_add(cols: list[ColumnOrName]) -> Column:
    """Sum in which a NULL addend counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def safe_subtract(cols: list[ColumnOrName]) -> Column:
    """First value minus the rest; a NULL counts as 0."""
    return reduce(lambda a, b: a - b, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def width_bucket(c: ColumnOrName, low, high, buckets: int) -> Column:
    """1..n inside [low, high), 0 below and n+1 from ``high`` upwards."""
    return F.width_bucket(
        _col(c).cast("double"),
        F.lit(float(low)),
        F.lit(float(high)),
        F.lit(int(buckets)).cast("bigint"),
    )


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in UNIT_FACTORS:
        raise ValueError(f"unit must be one of {sorted(UNIT_FACTORS)}, got {unit!r}")
    half_lat = F.radians(_col(lat2) - _col(lat1)) / 2
    half_lon = F.radians(_col(lon2) - _col(lon1)) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + (
        F.cos(F.radians(_col(lat1)))
        * F.cos(F.radians(_col(lat2)))
        * F.pow(F.sin(half_lon), F.lit(2))
    )
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MI * UNIT_FACTORS[unit])


def null_blank(c: ColumnOrName) -> Column:
    """Empty string to NULL."""
    return F.nullif(_col(c), F.lit(""))


def or_zero(c: ColumnOrName, missing: str) -> Column:
    """The value as it is (``'null'``) or with 0 in place of NULL (``'zero'``)."""
    if missing not in ("null", "zero"):
        raise ValueError("missing must be 'null' or 'zero'")
    return F.coalesce(_col(c), F.lit(0.0)) if missing == "zero" else _col(c)
