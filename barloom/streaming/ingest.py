"""Drop-folder ingest: each micro-batch is merged into the daily table by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.ingest import DEFAULT_SOURCE, normalise_bars
from ..sources.tables import merge_daily


def start_ingest(
    spark: SparkSession,
    landing: str,
    schema: StructType | str,
    table: str,
    checkpoint: str,
    source: str = DEFAULT_SOURCE,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process what has landed, then stop (``availableNow``).

    Rows replace stored rows of the same (ticker, date) if their file is newer, so the
    table ends up the same however the files are cut into batches, and when a
    batch runs again after a failure.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, batch_id: int) -> None:
        new = normalise_bars(batch, f"stream-{batch_id}", source, landed="_landed")
        merge_daily(batch.sparkSession, table, new)

    landed = F.col("_metadata.file_modification_time").alias("_landed")
    return (
        reader.parquet(landing)
        .select("*", landed)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
