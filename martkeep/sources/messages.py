"""Change messages from files, for replays, backfills and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_text(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of text files with one JSON document per line."""
    return _stream(spark, max_files_per_trigger).format("text").load(path)


def stream_parquet(
    spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet files; ``schema`` must be given."""
    return _stream(spark, max_files_per_trigger).schema(schema).format("parquet").load(path)


def _stream(spark: SparkSession, max_files_per_trigger: int | None):
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader
