"""Nested API documents to flat tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import millis_to_timestamp
from tidemart.operators.quality import lower_names


def _stamp(at: dt.datetime | None) -> Column:
    """The time of ingestion: given, or now."""
    return F.current_timestamp() if at is None else F.lit(at)


def price_ticks(docs: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    return docs.select("symbol", F.col("price").try_cast("double").alias("price"), _stamp(at).alias("timestamp"))


def klines(docs: DataFrame) -> DataFrame:
    """Positional bars to named columns; amounts stay exact decimals."""
    bar = docs.select("symbol", "interval", F.explode("klines").alias("k"))

    def amount(i: int, name: str) -> Column:
        return F.get("k", i).try_cast("decimal(38,18)").alias(name)

    return bar.select(
        "symbol", "interval", millis_to_timestamp(F.get("k", 0)).alias("open_time"),
        *(amount(i, name) for i, name in enumerate(("open", "high", "low", "close", "volume"), start=1)),
        millis_to_timestamp(F.get("k", 6)).alias("close_time"),
    )


def recent_trades(docs: DataFrame) -> DataFrame:
    return docs.select("symbol", F.explode("trades").alias("t")).select(
        "symbol",
        F.col("t.id").alias("trade_id"),
        F.col("t.price").try_cast("decimal(38,18)").alias("price"),
        F.col("t.qty").try_cast("decimal(38,18)").alias("quantity"),
        millis_to_timestamp("t.time").alias("trade_time"),
    )


def coin_tickers(docs: DataFrame) -> DataFrame:
    """US dollar quotes beside the coin; a coin without quotes keeps nulls."""
    return docs.select("id", "name", "symbol", "rank", "quotes.USD.*", "last_updated")


# Short names the bars use.
BAR_NAMES = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}


def stock_bars(docs: DataFrame) -> DataFrame:
    """Bars with readable names, their middle price and change.

    Fields beyond the named ones pass through; a ticker without bars gives none.
    """
    rows = docs.select("ticker", F.explode("results").alias("bar")).select("bar.*", "ticker")
    return rows.withColumn("timestamp", millis_to_timestamp("t")).withColumnsRenamed(BAR_NAMES).withColumns(
        {
            "avg_price": (F.col("high") + F.col("low")) / 2,
            "price_change": F.col("close") - F.col("open"),
        }
    )


def gas_prices(docs: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """State and city rows in one table, tagged with their level.

    A part that is missing, or is not the object or list it should be, parses
    to null and gives no row.
    """
    states = docs.filter(F.col("result.state").isNotNull()).select(
        "result.state.*", "state_code", F.lit("state").alias("level")
    )
    cities = (
        docs.select("state_code", F.explode("result.cities").alias("city"))
        .filter(F.col("city").isNotNull())
        .select("city.*", "state_code", F.lit("city").alias("level"))
    )
    both = states.unionByName(cities, allowMissingColumns=True)
    return lower_names(both).withColumn("ingestion_time", _stamp(at))


def weather(docs: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    return docs.select(
        F.col("location.name").alias("city"),
        "location.region",
        "location.country",
        F.col("current.temp_c").alias("temperature_c"),
        "current.humidity",
        "current.wind_kph",
        F.col("current.condition.text").alias("condition"),
        F.try_to_timestamp("current.last_updated").alias("last_updated"),
        _stamp(at).alias("extracted_at"),
    )
