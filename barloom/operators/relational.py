"""General table helpers: star, pivot, unpivot, union, dedupe, spines."""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_date_col, null_blank
from ..functions.numeric import ColumnOrName, _col


def star(
    df: DataFrame,
    exclude: list[str] = (),
    prefix: str = "",
    suffix: str = "",
    alias: str | None = None,
) -> list[Column]:
    """All columns but some (case-insensitive), renamed with a prefix and suffix.

    ``alias`` qualifies them where the frame was aliased for a join.
    """
    dropped = {c.lower() for c in exclude}
    kept = [c for c in df.columns if c.lower() not in dropped]
    of = f"{alias}." if alias else ""
    return [F.col(f"{of}`{c}`").alias(f"{prefix}{c}{suffix}") for c in kept]


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select(
        *[
            null_blank(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list) -> DataFrame:
    """First row per key in the given order.

    ``row_number = 1`` becomes a group limit below the exchange: a key with any
    number of copies sends one row per task.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def ordered_distinct(df: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct values with the position of their first occurrence."""
    return df.groupBy(value).agg(F.min(position).alias(position))


def column_values(
    df: DataFrame | None,
    column: str,
    order_by: list | None = None,
    max_records: int | None = None,
    default: list | None = None,
    where: str | Column | None = None,
) -> DataFrame | list:
    """Distinct values, most frequent first (ties by value), as a DataFrame.

    ``df=None`` stands for a missing table: the default is returned, or an
    error raised when there is none.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    rows = df if where is None else df.filter(where)
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    out = counts.orderBy(*(order_by or [F.col("n").desc(), F.col("value").asc_nulls_last()]))
    return out if max_records is None else out.limit(max_records)


def pivot_values(df: DataFrame, column: str) -> list:
    """All values of a column as a list, for use as pivot columns: one column each.

    For columns with many values use ``pivot_map``, which needs no list.
    """
    return [r.value for r in column_values(df, column).collect()]


def pivot_map(
    df: DataFrame, keys: list[str], column: str, cell: Column, cells: str = "cells", most: int = 10_000
) -> DataFrame:
    """One map from value to aggregate per key, for columns whose values are not known or too many.

    ``cell`` is any aggregate, taken by key and value of ``column``; NULL is the key of no
    cell and left out, as in a pivot. No list of values reaches the driver. A key with over
    ``most`` values gets several rows, numbered in ``part``, each with at most about ``most``
    cells, so that a hot key is no single row: a look-up takes the part that has the value.
    """
    found = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_value")).agg(cell.alias("_cell"))
    sizes = found.groupBy(*keys).agg(F.ceil(F.count("*") / most).alias("_parts")).filter("_parts > 1")
    sizes = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_parts")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    part = F.coalesce(F.pmod(F.xxhash64("_value"), F.col("_parts")), F.lit(0)).cast("int")
    entry = F.struct(F.col("_value"), F.col("_cell"))
    return (
        found.join(sizes, same, "left")
        .groupBy(*keys, part.alias("part"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias(cells))
    )


# The comparisons a pivot cell may use.
COMPARISONS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def pivot_cells(
    column: ColumnOrName,
    values: list,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for ``groupBy(...).agg(*cells)``.

    Any comparison and any aggregate will do, and either branch may be a
    column, which ``GroupedData.pivot`` does not offer.
    """
    test = COMPARISONS[cmp]
    then_value = then_value if isinstance(then_value, Column) else F.lit(then_value)
    else_value = else_value if isinstance(else_value, Column) else F.lit(else_value)
    cells = []
    for value in values:
        cell = F.when(test(_col(column), F.lit(value)), then_value).otherwise(else_value)
        if distinct:
            made = F.call_function(agg, cell) if agg in ("min", "max") else _distinct(agg, cell)
        else:
            made = F.call_function(agg, cell)
        cells.append(made.alias(f"{prefix}{value}{suffix}"))
    return cells


def _distinct(agg: str, cell: Column) -> Column:
    if agg == "count":
        return F.count_distinct(cell)
    if agg == "sum":
        return F.sum_distinct(cell)
    raise ValueError(f"distinct is offered for count, sum, min and max, not for {agg}")


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: list[str] = (),
    remove: list[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows: ``exclude`` is kept on each row, ``remove`` is dropped."""
    out = {c.lower() for c in (*exclude, *remove)}
    measures = [c for c in df.columns if c.lower() not in out]
    cast = df.select(*exclude, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in measures])
    return cast.unpivot(list(exclude), measures, field_name, value_name)


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: list[str] = (),
    exclude: list[str] = (),
    source_column: str | None = "source_relation",
    where: str | Column | None = None,
) -> DataFrame:
    """Union of tables with different columns: superset, NULL where absent, source tag."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}
    wanted = {c.lower() for c in include}
    unwanted = {c.lower() for c in exclude}

    types: dict[str, str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            low = f.name.lower()
            if low in unwanted or (wanted and low not in wanted):
                continue
            types.setdefault(f.name, override.get(f.name, f.dataType.simpleString()))
    if not types:
        raise ValueError("no columns left to union")

    parts = []
    for name, df in relations.items():
        rows = df if where is None else df.filter(where)
        cells = [
            (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in types.items()
        ]
        tag = [F.lit(name).alias(source_column)] if source_column else []
        parts.append(rows.select(*tag, *cells))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..upper_bound, made in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


#: Units a spine may have.
STEPS = ("hour", "day", "week", "month", "quarter", "year")


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """Consecutive periods from start up to, but not including, end.

    start and end may be dates, ISO texts or scalar subqueries over a table.
    """
    if datepart not in STEPS:
        raise ValueError(f"datepart must be one of {tuple(STEPS)}, got {datepart!r}")
    kind = "timestamp" if datepart == "hour" else "date"
    first, last = _bound(start, kind), _bound(end, kind)
    ends = spark.range(1).select(first.alias("a"), last.alias("b"))
    # The two bounds are all the driver needs to make the steps in parallel.
    a, b = ends.first()
    steps = 0
    if a is not None and b is not None and a < b:
        between = F.expr(f"timestampdiff({datepart}, a, b)")
        steps = ends.select(between).first()[0] + 1
    made = F.timestamp_add(datepart.upper(), F.col("id").cast("int"), F.lit(a).cast("timestamp"))
    name = f"date_{datepart}"
    return (
        spark.range(steps)
        .select(made.cast(kind).alias(name))
        .filter(F.col(name) < F.lit(b).cast(kind))
    )


def _bound(value, kind: str) -> Column:
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, dt.datetime) or kind == "timestamp":
        return F.lit(str(value)).cast(kind)
    return as_date_col(value)
