"""Market ticks, trades and API documents over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.marts import SCHEMAS, table
from tidemart.sources.streams import table_stream

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as price ticks: the event type is the symbol."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _quantity().alias("quantity"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _message(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns, F.date_format("ts", _ISO).alias("timestamp"))).alias("value")


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A stream takes a folder or a glob; this glob matches just the table, be it a file or a folder.
    return table_stream(spark, f"{folder}/events.parque[t]", SCHEMAS["events"])


def price_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of price messages."""
    return _event_stream(spark, folder).select(_message(F.col("event_type").alias("symbol"), F.col("value").alias("price")))


def trade_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _event_stream(spark, folder).select(
        _message(F.col("event_type").alias("symbol"), F.col("value").alias("price"), _quantity().alias("quantity"))
    )


#: Message files land in so many steps; every ``LATE``-th tick comes one step late.
STEPS, LATE = 4, 50


def landing_steps(spark: SparkSession, folder: str) -> list[DataFrame]:
    """All price messages in the steps in which they land: equal parts of the time, some ticks a step late."""
    events = table(spark, folder, "events")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    if low is None:
        return []
    step = F.floor((at - low) / ((high - low) // STEPS + 1)) + F.when(F.col("event_id") % LATE == 0, 1).otherwise(0)
    message = _message(F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    return [events.filter(F.least(step, F.lit(STEPS - 1)) == k).select(message) for k in range(STEPS)]


def key_steps(rows: DataFrame, key: str = "id") -> list[DataFrame]:
    """``rows`` in the steps in which their table grows: equal parts of the keys."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return [rows]
    step = F.floor((F.col(key) - low) / ((high - low) // STEPS + 1))
    return [rows.filter(step == k) for k in range(STEPS)]


# --- API documents, as JSON text ----------------------------------------------


def _document(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def price_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One tick a document; every 50th is cut short and so no JSON."""
    docs = table(spark, folder, "events").select(
        "event_id",
        F.to_json(F.struct(F.col("event_type").alias("symbol"), F.col("value").cast("string").alias("price"))).alias("d"),
    )
    cut = F.expr("left(d, length(d) - 1)")
    return docs.select(F.when(F.col("event_id") % 50 == 0, cut).otherwise(F.col("d")).alias("value"))


def kline_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars, a day (at most 24 bars) per document."""
    events = table(spark, folder, "events")
    first, last = F.min_by("value", "ts"), F.max_by("value", "ts")
    bars = events.groupBy("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).agg(
        first.alias("o"), F.max("value").alias("hi"), F.min("value").alias("lo"), last.alias("c"),
        F.count(F.lit(1)).alias("v"),
    )
    opened = F.unix_millis("h")
    bar = F.array(opened.cast("string"), *(F.col(c).cast("string") for c in ("o", "hi", "lo", "c", "v")),
                  (opened + 3_599_999).cast("string"))
    days = bars.groupBy("event_type", F.to_date("h").alias("d")).agg(F.collect_list(bar).alias("klines"))
    return _document(days, F.col("event_type").alias("symbol"), F.lit("1h").alias("interval"), "klines")


def trade_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Trades in pages of at most 100 per symbol."""
    one = F.struct(
        F.col("event_id").alias("id"), F.col("value").cast("string").alias("price"),
        _quantity().cast("string").alias("qty"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
    )
    pages = table(spark, folder, "events").groupBy("event_type", F.floor(F.col("event_id") / 100).alias("p")).agg(
        F.collect_list(one).alias("trades")
    )
    return _document(pages, F.col("event_type").alias("symbol"), "trades")


def coin_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One coin per part; every tenth has no quotes."""
    key = F.col("p_partkey")
    usd = F.struct(
        F.col("p_retailprice").alias("price"), (F.col("p_size") * 1000.0).alias("volume_24h"),
        (F.col("p_retailprice") * F.col("p_size")).alias("market_cap"), ((key % 21) - 10.0).alias("percent_change_24h"),
    )
    quotes = F.when(key % 10 != 0, F.struct(usd.alias("USD"))).alias("quotes")
    return _document(
        table(spark, folder, "part"), F.concat(F.lit("coin-"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("symbol"), F.col("p_size").alias("rank"),
        F.lit("2024-01-30T00:00:00Z").alias("last_updated"), quotes,
    )


def stock_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars of a symbol and day; documents of the 7th of a month lack ``results``."""
    events = table(spark, folder, "events").select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    bars = events.groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(
        F.min_by("value", "ts").alias("o"), F.max("value").alias("h_"), F.min("value").alias("l"),
        F.max_by("value", "ts").alias("c"), F.count(F.lit(1)).alias("n"),
    )
    bar = F.struct(F.unix_millis("h").alias("t"), "o", F.col("h_").alias("h"), "l", "c",
                   F.col("n").cast("double").alias("v"), F.col("c").alias("vw"), "n")
    days = bars.groupBy("event_type", F.to_date("h").alias("d")).agg(F.collect_list(bar).alias("bars"))
    kept = F.when(F.dayofmonth("d") != 7, F.col("bars")).alias("results")
    return _document(days, F.col("event_type").alias("ticker"), kept)


def gas_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as cities in pages of at most 50 of one nation, each page under its state."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")

    def place(name: Column, price: Column) -> Column:
        text = F.format_number(price, 3)
        return F.struct(
            F.lit("usd").alias("currency"), name.alias("name"), F.lower(name).alias("lowerName"),
            text.alias("gasoline"), text.alias("midGrade"), text.alias("premium"), text.alias("diesel"),
        )

    key = F.col("s_suppkey")
    city = place(F.col("s_name"), 3 + (key % 100) / 100)
    pages = table(spark, folder, "supplier").join(nation, "s_nationkey").groupBy(
        "s_nationkey", "n_name", F.floor(key / 50).alias("page")
    ).agg(F.collect_list(city).alias("cities"))
    state = F.when(F.col("s_nationkey") % 5 != 0, place(F.col("n_name"), 3 + F.col("page") % 10 / 10)).alias("state")
    return _document(
        pages, F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("state_code"),
        F.struct(state, "cities").alias("result"),
    )


def weather_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One report per customer, its nation the country."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    location = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("region"), F.col("n_name").alias("country"))
    current = F.struct(
        (key % 40 - 5.0).alias("temp_c"), (key % 101).cast("int").alias("humidity"), (key % 60 / 2).alias("wind_kph"),
        F.struct(F.when(key % 2 == 0, F.lit("Sunny")).otherwise(F.lit("Cloudy")).alias("text")).alias("condition"),
        F.lit("2024-01-30 12:45").alias("last_updated"),
    )
    return _document(
        table(spark, folder, "customer").join(nation, "c_nationkey"), location.alias("location"), current.alias("current")
    )
