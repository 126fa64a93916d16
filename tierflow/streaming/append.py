"""Stateless streams: append to a file sink, and incremental row-local views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.streaming.ingest import ANY_AGE


def stream_files(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    max_files: int | None = None,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """Parquet folder as a stream; an explicit schema makes an empty folder legal.

    Files of any age are taken, so a late or backfilled file with an old date is not lost.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is new and append it; the sink's commit log makes it exactly-once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def incremental_view(
    stream: DataFrame, project: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> None:
    """Keep a row-local view up to date by projecting only the rows that arrived."""
    append_stream(project(stream), path, checkpoint)
