"""Previous and next value in an order, without one task holding the whole order.

``lag`` over an unpartitioned window sorts everything in a single task, and a
window by group does the same to a hot group. Here the rows are dealt out by
ranges of (group, value), so a hot group spans as many ranges as its size
needs. Each range is its own window, and the value at each border is carried
over by a small second step that sees one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def with_neighbour(
    df: DataFrame,
    column: str,
    group_by: list[str] = (),
    following: bool = False,
    name: str = "neighbour",
    ranges: int | None = None,
) -> DataFrame:
    """Adds the previous (or following) value of ``column`` within the group.

    ``column`` must be distinct within the group and not NULL; any type with an
    order will do. The rows are written to the shared folder with the number of
    their range (``ranges`` of them, by default as many as a shuffle makes), so
    every later step, and every retry of a lost task, sees the same ranges.
    """
    group = list(group_by)
    spark = df.sparkSession
    path = scratch_path(spark, "values")
    order = [*group, column]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *order)
    dealt.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)

    key = F.struct(*order)
    step = F.lead if following else F.lag
    inside = Window.partitionBy("_range").orderBy(*order)
    borders = rows.groupBy("_range").agg((F.min(key) if following else F.max(key)).alias("_edge"))
    across = Window.partitionBy().orderBy("_range")  # one row per range
    carried = borders.select(F.col("_range").alias("_r"), step("_edge").over(across).alias("_carry"))
    near = F.coalesce(F.col("_near"), F.col("_carry"))
    same = F.lit(True)
    for c in group:
        same = same & near[c].eqNullSafe(F.col(c))
    return (
        rows.withColumn("_near", step(key).over(inside))
        .join(carried, F.col("_range") == F.col("_r"))
        .withColumn(name, F.when(same, near[column]))
        .select(*df.columns, name)
    )
