"""Tables read as streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_table(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files of a Parquet table, a single file or a folder, as a stream of about so many micro-batches."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    folder, name = path.rstrip("/").rsplit("/", 1)
    # a stream takes a single file only by a pattern
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
    return reader.parquet(f"{folder}/{{{name}}}")
