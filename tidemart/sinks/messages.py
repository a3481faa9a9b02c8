"""Rows as JSON messages, and appends to databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row: decimals as plain numbers, times in ISO form."""
    columns = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ]
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return df.select(F.to_json(F.struct(*columns), options).alias("value"))


def message_sink(df: DataFrame, checkpoint: str, fmt: str = "kafka",
                 options: Mapping[str, str] | None = None) -> DataStreamWriter:
    """A stream of rows as JSON messages in any sink format that takes ``value``."""
    return as_messages(df).writeStream.format(fmt).options(**(options or {})).option("checkpointLocation", checkpoint)


def publish(df: DataFrame, fmt: str = "kafka", options: Mapping[str, str] | None = None) -> None:
    """Rows of a table as JSON messages, in one batch."""
    as_messages(df).write.format(fmt).options(**(options or {})).mode("append").save()


def console_sink(df: DataFrame, name: str, fmt: str = "console") -> DataStreamWriter:
    """Changed rows of each micro-batch, for looking at."""
    writer = df.writeStream.outputMode("update").format(fmt).queryName(name)
    return writer.option("truncate", False) if fmt == "console" else writer


def jdbc_append(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Append to a database table, created on first use."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def table_append(df: DataFrame, path: str) -> None:
    """Append to a Parquet table, where no database is at hand."""
    df.write.mode("append").parquet(path)
