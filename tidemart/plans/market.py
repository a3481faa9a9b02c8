"""Market results on tables: volatility, anomalies, latest prices, reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.rolling import SPAN, rolling_volatility
from tidemart.schemas import CONTRACTS
from tidemart.session import pin
from tidemart.sinks.keyed import of_symbols, recent

_VOLATILITY = CONTRACTS["volatility_metrics"].schema.names


def volatility(ticks: DataFrame, span: int = SPAN) -> DataFrame:
    """Each tick with the mean, deviation and volatility of its last hour, or of ``span`` seconds."""
    return rolling_volatility(ticks, span).select(*_VOLATILITY)


def anomalies(volatility_rows: DataFrame, k: float = 3.0) -> DataFrame:
    """Ticks more than ``k`` deviations away from their rolling mean."""
    z = F.try_divide(F.col("price") - F.col("rolling_avg"), F.col("rolling_stddev"))
    return volatility_rows.withColumn("z_score", z).filter(F.abs("z_score") > k).select(
        "symbol", "timestamp", "price", F.col("rolling_avg").alias("avg_price"),
        F.col("rolling_stddev").alias("stddev_price"), "z_score",
    )


def latest_prices(volatility_rows: DataFrame) -> DataFrame:
    """The newest tick per symbol with its rolling mean and volatility."""
    row = F.struct("timestamp", "price", "rolling_avg", "volatility_pct")
    newest = volatility_rows.groupBy("symbol").agg(F.max(row).alias("_t"))
    return newest.select(
        "symbol", "_t.price", "_t.timestamp", F.col("_t.rolling_avg").alias("avg_price"), "_t.volatility_pct"
    )


def latest_of_ticks(ticks: DataFrame) -> DataFrame:
    """``latest_prices`` straight from ticks: only each symbol's last hour is rolled."""
    newest = pin(ticks.groupBy("symbol").agg(F.max("timestamp").alias("_newest")))
    last = ticks.join(newest, "symbol").filter(
        F.col("timestamp") >= F.col("_newest") - F.make_dt_interval(secs=F.lit(SPAN + 1))
    )
    return latest_prices(volatility(last.drop("_newest")))


# Reads of the stored tables, with their usual lengths.


def read_latest_prices(table: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    return of_symbols(table, symbols)


def read_minute_averages(table: DataFrame, symbol: str, limit: int = 60) -> DataFrame:
    return recent(table, CONTRACTS["minute_price_avg"], limit, symbol)


def read_hourly_averages(table: DataFrame, symbol: str, limit: int = 24) -> DataFrame:
    return recent(table, CONTRACTS["hourly_price_avg"], limit, symbol)


def read_volatility(table: DataFrame, symbol: str, limit: int = 100) -> DataFrame:
    """Oldest first: the table clusters by ascending time."""
    return recent(table, CONTRACTS["volatility_metrics"], limit, symbol)


def read_trade_volume(table: DataFrame, symbol: str, limit: int = 12) -> DataFrame:
    return recent(table, CONTRACTS["trade_volume"], limit, symbol)


def read_anomalies(table: DataFrame, symbol: str | None = None, limit: int = 50) -> DataFrame:
    return recent(table, CONTRACTS["anomalies"], limit, symbol)
