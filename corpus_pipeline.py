"""The corpus pipeline: five stages over documents, each written and read again.

Run as ``run(spark, sf_dir)``; it needs the folder ``barloom/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.pipeline import (
    benchmark_decontamination,
    byte_bpe,
    near_duplicates,
    repeated_passages,
    toxicity_filter,
)
from barloom.llm.store import stored

#: In this order; all but the last return the columns of documents.
STAGES = [
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: A trained network decides in the first stage, which SQL cannot express; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage makes of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
