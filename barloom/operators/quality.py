"""Data checks. Each returns the failing rows; ``run_check`` turns them into a status.

Checks that compare row by row over an order, or count copies, merge equal rows
first and report how many rows a failing one stands for in ``n_rows``. A value
that fills a third of the table is then one row in the shuffle, and nothing is
left out of the count.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalise_label
from ..session import scratch_cleared
from .neighbours import with_neighbour


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    outside = df.filter(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_rows"))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Distinct values that are in the list."""
    hits = df.filter(F.col(column).isin(list(values)))
    return hits.select(F.col(column).alias("value_field")).distinct()


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1").drop("n")


def freshness(
    df: DataFrame, field: str = "ingested_at", as_of=None, warn_days: int = 8, error_days: int = 15
) -> DataFrame:
    """One row: newest load time, its age in days, pass / warn / error."""
    newest = df.agg(F.max(F.col(field).cast("timestamp")).alias("max_loaded_at"))
    return aged(newest, as_of, warn_days, error_days)


def aged(newest: DataFrame, as_of=None, warn_days: int = 8, error_days: int = 15) -> DataFrame:
    """Age and status beside the newest load time in ``max_loaded_at``."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    age = (F.unix_seconds(now) - F.unix_seconds(F.col("max_loaded_at"))) / F.lit(86400.0)
    status = (
        F.when(F.col("age_days").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_days", age).withColumn("status", status)


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True):
    """Rows outside the bounds; NULL passes."""
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ~((c >= low) if inclusive else (c > low))
    if high is not None:
        bad = bad | ~((c <= high) if inclusive else (c < high))
    return df.filter(bad)


def at_least_one(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups (or the whole table) without a single non-NULL value."""
    counts = df.groupBy(*group_by).agg(F.count(column).alias("n_values"))
    return counts.filter("n_values = 0")


def _difference(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Set difference both ways in one shuffle; copies are merged on the map side."""
    sides = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    only = sides.groupBy(*columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    which = F.when(F.col("_a") == 1, "a_minus_b").otherwise("b_minus_a")
    return only.filter("_a <> _b").select(which.alias("which_diff"), *columns)


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose row count differs between two tables, one row per side that has them."""
    sides = df.select(F.col(column).alias("value"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    sides = sides.unionByName(
        to.select(F.col(field).alias("value"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counts = sides.groupBy("value").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    both = F.array(
        F.struct(F.lit("a_minus_b").alias("which_diff"), F.col("_a").alias("num_rows")),
        F.struct(F.lit("b_minus_a").alias("which_diff"), F.col("_b").alias("num_rows")),
    )
    return (
        counts.filter("_a <> _b")
        .select("value", F.inline(both))
        .filter("num_rows > 0")
        .select("which_diff", "value", "num_rows")
    )


def equality(
    df: DataFrame,
    other: DataFrame,
    compare_columns: list[str] | None = None,
    exclude_columns: list[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Rows in one table and not in the other, tagged by direction.

    Each pair of columns is compared by its types: decimals and whole numbers as decimals,
    digit by digit, also beyond the 15 digits of a double (as text where no decimal
    type holds both); two doubles, or a double and another number, as doubles. ``precision``
    rounds either kind half up to that many digits behind the point. All else is compared as it is.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        wanted = {c.lower() for c in compare_columns}
        columns = [c for c in df.columns if c.lower() in wanted]
    else:
        dropped = {c.lower() for c in exclude_columns or []}
        columns = [c for c in df.columns if c.lower() not in dropped]
        theirs = {c.lower() for c in other.columns} - dropped
        if {c.lower() for c in columns} != theirs:
            raise ValueError("the tables have different columns")

    types = {f.name.lower(): f.dataType for f in other.schema.fields}
    mine = [f for f in df.schema.fields if f.name in columns]
    shapes = [_comparable(f.dataType, types.get(f.name.lower(), f.dataType), precision) for f in mine]
    cells = [shape(F.col(f"`{f.name}`")).alias(f.name) for f, shape in zip(mine, shapes)]
    return _difference(df.select(*cells), other.select(*cells), columns)


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _comparable(mine: T.DataType, theirs: T.DataType, precision: int | None):
    """The form of a column in which equal values of both types are equal, as a function of the column."""
    kinds = (mine, theirs)
    if any(isinstance(t, (T.DoubleType, T.FloatType)) for t in kinds):
        return lambda c: c.cast("double") if precision is None else F.round(c.cast("double"), precision)
    if not any(isinstance(t, T.DecimalType) for t in kinds):
        return lambda c: c
    sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE.get(type(t)), 0) for t in kinds]
    if any(p is None for p, _ in sizes):
        return lambda c: c
    if precision is not None:
        # rounding up may need one more digit before the point
        sizes = [(p, s) if s <= precision else (p - s + 1 + precision, precision) for p, s in sizes]
    scale = max(s for _, s in sizes)
    digits = max(p - s for p, s in sizes) + scale
    rounded = (lambda c: c) if precision is None else (lambda c: F.round(c, precision))
    if digits <= 38:
        return lambda c: rounded(c).cast(f"decimal({digits},{scale})")
    return lambda c: F.regexp_replace(rounded(c).cast("string"), r"\.0*$|(\.[0-9]*?[1-9])0+$", "$1")


def equal_rowcount(df: DataFrame, other: DataFrame, group_by: list[str] = ()) -> DataFrame:
    """Counts of both tables (per group) and their absolute difference."""
    counts = _paired_counts(df, other, list(group_by))
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: list[str] = ()) -> DataFrame:
    """By how many rows the table fails to be strictly smaller (equal counts fail by 1)."""
    counts = _paired_counts(df, other, list(group_by))
    a, b = F.col("count_a"), F.col("count_b")
    delta = F.when(a > b, a - b).when(a == b, F.lit(1)).otherwise(F.lit(0))
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


def _paired_counts(df: DataFrame, other: DataFrame, group: list[str]) -> DataFrame:
    if not group:
        theirs = other.agg(F.count("*")).scalar()
        return df.agg(F.count("*").alias("count_a")).withColumn("count_b", theirs)
    a = df.groupBy(*[F.col(c).alias(f"{c}_a") for c in group]).agg(F.count("*").alias("count_a"))
    b = other.groupBy(*[F.col(c).alias(f"{c}_b") for c in group]).agg(
        F.count("*").alias("count_b")
    )
    match = reduce(lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group])
    return a.join(b, match, "full")


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None):
    """Rows for which the expression is false; NULL passes."""
    if isinstance(expression, str):
        expression = F.expr(f"{column} {expression}" if column else expression)
    return df.filter(~expression)


GAP_RULES = ("allowed", "not_allowed", "required")


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: list[str] = (),
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Ranges that are empty, inverted, or do not fit in front of the next one.

    The last range of a partition has nothing to fit; a NULL bound fails.
    Equal ranges are merged with their count. Of the ranges that start at the
    same point only the longest meets the next start; all others meet that same
    start again, so the search for neighbours runs over distinct starts.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {GAP_RULES}, got {gaps!r}")
    group = list(partition_by)
    bounds = [F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound")]
    rows = df.groupBy(*group, *bounds).agg(F.count("*").alias("n_rows"))
    starts = df.filter(F.col(lower).isNotNull()).groupBy(*group, bounds[0])
    starts = starts.agg(F.max(upper).alias("_longest"))
    starts = with_neighbour(
        starts, "lower_bound", group, following=True, name="_next", ranges=ranges
    )
    keys = starts.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(group)],
        F.col("lower_bound").alias("_k"),
        "_longest",
        F.struct(F.col("_next").alias("value")).alias("_next"),
    )
    # Both bounds are part of the join key, so it is unique on either side: no start is hot.
    match = F.col("lower_bound") == F.col("_k")
    match = match & F.col("upper_bound").eqNullSafe(F.col("_longest"))
    for i, c in enumerate(group):
        match = match & F.col(c).eqNullSafe(F.col(f"_k{i}"))

    # Of n equal longest ranges one meets the next start and n - 1 meet their own.
    longest = F.col("_next").isNotNull()
    once = F.when(longest, 1).otherwise(0).cast("bigint")
    last = F.struct(
        F.col("_next.value").alias("next_lower_bound"),
        F.col("_next.value").isNull().alias("is_last_record"),
        once.alias("n_rows"),
    )
    again = F.struct(
        F.col("lower_bound").alias("next_lower_bound"),
        F.lit(False).alias("is_last_record"),
        (F.col("n_rows") - once).alias("n_rows"),
    )
    met = (
        rows.join(keys, match, "left")
        .select(*group, "lower_bound", "upper_bound", F.inline(F.array(last, again)))
        .filter("n_rows > 0")
    )
    low, high, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    ordered = F.coalesce((low <= high) if zero_length_range_allowed else (low < high), F.lit(False))
    fit = {"allowed": high <= nxt, "not_allowed": high == nxt, "required": high < nxt}[gaps]
    fits = F.coalesce(fit, F.col("is_last_record"))
    columns = [*group, "lower_bound", "upper_bound", "next_lower_bound", "n_rows"]
    return met.filter(~(ordered & fits)).select(*columns)


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: list[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Values that do not follow their predecessor by exactly the interval.

    The first value of a group passes. Equal values are merged: the first of n
    copies is compared with the value before, the other n - 1 with itself.
    """
    group = list(group_by)
    prev = f"previous_{column}"
    values = df.filter(F.col(column).isNotNull()).groupBy(*group, column)
    values = values.agg(F.count("*").alias("n"))
    values = with_neighbour(values, column, group, name="_prev", ranges=ranges)
    head = F.struct(F.col("_prev").alias(prev), F.lit(1).cast("bigint").alias("n_rows"))
    copies = F.struct(F.col(column).alias(prev), (F.col("n") - 1).alias("n_rows"))
    pairs = values.select(*group, column, F.inline(F.array(head, copies)))
    if datepart:
        # A month or year step depends on the calendar, so it is added as an interval.
        due = F.expr(f"timestampadd({datepart}, {int(interval)}, {prev})").cast("timestamp")
        follows = F.col(column).cast("timestamp") == due
    else:
        follows = F.col(column) == F.col(prev) + F.lit(interval)
    return pairs.filter(F.col("n_rows") > 0).filter(~follows)


def not_constant(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups with exactly one distinct non-NULL value.

    min = max says the same as a distinct count of 1 and keeps two values per
    group instead of all of them.
    """
    ends = df.groupBy(*group_by).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return ends.filter("_lo = _hi").select(*group_by, F.lit(1).cast("bigint").alias("n_distinct"))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim else F.col(column)
    return df.withColumn(column, value).filter(F.col(column) == "")


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: list[str] = ()
) -> DataFrame:
    """Groups whose share of non-NULL values is out of bounds."""
    share = F.avg(F.col(column).isNotNull().cast("double")).alias("not_null_proportion")
    p = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(share).filter((p < at_least) | (p > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of=None,
    ignore_time: bool = False,
    group_by: list[str] = (),
) -> DataFrame:
    """Groups whose newest value is older than the threshold."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    kind = "date" if ignore_time else "timestamp"
    newest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    due = newest.withColumn("_now", now)
    back = F.expr(f"timestampadd({datepart}, {-int(interval)}, _now)").cast(kind)
    return due.withColumn("threshold", back).drop("_now").filter("most_recent < threshold")


def relationships(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | Column | None = None,
    to_condition: str | Column | None = None,
) -> DataFrame:
    """Keys without a parent, with their row counts.

    Both sides are reduced to distinct keys before they meet.
    """
    child = df if from_condition is None else df.filter(from_condition)
    parent = to if to_condition is None else to.filter(to_condition)
    child = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("id"))
    child = child.agg(F.count("*").alias("n_rows"))
    parent = parent.select(F.col(field).alias("id")).distinct()
    return child.join(parent, "id", "left_anti")


def values_differ(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows in which two columns differ; a NULL on either side passes."""
    return df.filter(F.col(actual) != F.col(expected))


def exchange_mismatches(
    listings: DataFrame,
    vendor: DataFrame,
    keywords: dict[str, list[str]],
    exceptions: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Tickers whose vendor exchange contains no keyword of their listed group.

    ``listings`` has (ticker, exchange), ``vendor`` (ticker, full_exchange_name,
    exchange_code). ``exceptions`` maps a ticker to (group, text): a vendor name
    holding that text is accepted for that group. The keyword map becomes one
    CASE expression, so only the two tables are joined.
    """
    label = F.when(F.col("full_exchange_name") != "", F.col("full_exchange_name"))
    actual = normalise_label(F.coalesce(label, "exchange_code")).alias("actual")
    listed = listings.select("ticker", F.col("exchange").alias("expected"))
    rows = listed.join(vendor.select("ticker", actual), "ticker", "left")
    rows = rows.withColumn("actual", F.coalesce("actual", F.lit("")))

    matches = F.lit(False)
    for group, words in keywords.items():
        hits = [F.contains("actual", F.lit(w)) for w in words]
        hit = reduce(lambda a, b: a | b, hits, F.lit(False))
        matches = matches | ((F.col("expected") == group) & hit)
    for ticker, (group, text) in (exceptions or {}).items():
        matches = matches | (
            (F.col("ticker") == ticker)
            & (F.col("expected") == group)
            & F.contains("actual", F.lit(text))
        )
    return rows.filter(~matches).select("ticker", "expected", "actual")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for each table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def run_check(
    name: str,
    failing: DataFrame,
    warn_if: str = "> 0",
    error_if: str = "> 0",
    where: str | Column | None = None,
    fail_calc: str | Column | None = None,
) -> DataFrame:
    """(check_name, failures, status) from failing rows.

    Failures are the row count, the sum of ``n_rows`` where the check merges
    rows, or ``fail_calc``. Conditions are texts such as ``'> 0'`` or ``'< 1'``.
    """
    rows = failing if where is None else failing.filter(where)
    if fail_calc is None:
        fail_calc = F.sum("n_rows") if "n_rows" in failing.columns else F.count("*")
    elif isinstance(fail_calc, str):
        fail_calc = F.expr(fail_calc)
    out = rows.agg(F.coalesce(fail_calc, F.lit(0)).cast("bigint").alias("failures"))
    status = (
        F.when(F.expr(f"failures {error_if}"), "error")
        .when(F.expr(f"failures {warn_if}"), "warn")
        .otherwise("pass")
    )
    return out.select(F.lit(name).alias("check_name"), "failures", status.alias("status"))


def run_checks(checks: dict[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame:
    """One report over many checks; with functions that make the failing rows, a finished one.

    Frames give a lazy report. Functions are called and counted here, and what they wrote to
    the shared folder is removed again: the report has one row a check and reads nothing.
    """
    if not any(callable(make) for make in checks.values()):
        return reduce(DataFrame.unionByName, [run_check(n, df) for n, df in checks.items()])
    spark = SparkSession.active()
    with scratch_cleared(spark):
        made = {n: make() if callable(make) else make for n, make in checks.items()}
        return finished(run_checks(made))


def finished(report: DataFrame) -> DataFrame:
    """A report of one row a check as a local frame, computed now."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
