"""Message streams. Each yields a text column ``value``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                   options: Mapping[str, str] | None = None) -> DataFrame:
    """A Kafka topic; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **(options or {})}
    )
    return stream.load().select(F.col("value").cast("string").alias("value"))


def text_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed message files, one JSON object per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def table_stream(spark: SparkSession, path: str, schema: StructType | str,
                 files_per_batch: int | None = None) -> DataFrame:
    """A growing Parquet table as a stream of its new files."""
    reader = spark.readStream.format("parquet").schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
