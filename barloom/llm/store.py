"""Written intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` written once, in folders ``by``, and read back: later plans start here, whatever is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
