"""Tumbling windows over ticks and trades; the same for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, length: str, *measures: Column) -> DataFrame:
    """Measures per symbol and window, with the window's bounds as columns."""
    windows = df.groupBy("symbol", F.window("timestamp", length).alias("_w")).agg(*measures)
    bounds = [F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")]
    return windows.select("symbol", *bounds, *windows.columns[2:])


def _levels(column: str, avg: str, low: str, high: str) -> list[Column]:
    return [F.avg(column).alias(avg), F.min(column).alias(low), F.max(column).alias(high)]


def minute_prices(ticks: DataFrame) -> DataFrame:
    levels = _levels("price", "avg_price", "min_price", "max_price")
    return tumbling(ticks, "1 minute", *levels, F.count(F.lit(1)).alias("tick_count"))


def hourly_prices(ticks: DataFrame) -> DataFrame:
    """As by minute, with the sample deviation (null for a single tick)."""
    levels = _levels("price", "avg_price", "min_price", "max_price")
    spread = F.stddev_samp("price").alias("price_stddev")
    return tumbling(ticks, "1 hour", *levels, spread, F.count(F.lit(1)).alias("tick_count"))


def trade_volume(trades: DataFrame) -> DataFrame:
    volume = F.sum(F.col("price") * F.col("quantity")).alias("total_volume_usd")
    levels = _levels("price", "avg_trade_price", "min_trade_price", "max_trade_price")
    return tumbling(
        trades, "5 minutes", volume, F.sum("quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("trade_count"), *levels,
    )
