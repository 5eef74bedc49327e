"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, neardup, repeats, toxicity


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``toxicity.REJECT`` or more go; fitted on those of ``docs`` that have labels."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return neardup.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that stand in several places are cut out of all of them."""
    return repeats.remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
