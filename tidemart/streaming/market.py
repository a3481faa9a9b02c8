"""The market streams: parse, watermark, aggregate, store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemart.operators.bars import hourly_prices, minute_prices, trade_volume
from tidemart.operators.rolling import SPAN
from tidemart.plans.market import anomalies, latest_prices, volatility
from tidemart.schemas import CONTRACTS, PRICE_MESSAGE, TRADE_MESSAGE
from tidemart.session import children, delete
from tidemart.sinks.keyed import KeyedTable

LATENESS = dt.timedelta(minutes=10)


def _timed(messages: DataFrame, schema: StructType) -> DataFrame:
    rows = messages.withColumn("m", F.from_json(F.col("value").cast("string"), schema))
    return rows.withColumn("_at", F.try_to_timestamp("m.timestamp"))


def parse_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """JSON messages as rows with an event time.

    A message that is not JSON, or has no readable time, could belong to no
    window and must not stop the stream; ``rejected_messages`` has those.
    """
    timed = _timed(messages, schema).filter(F.col("_at").isNotNull())
    fields = [n for n in schema.names if n != "timestamp"]
    return timed.select(*(F.col(f"m.{n}").alias(n) for n in fields), F.col("_at").alias("timestamp")).select(*schema.names)


def rejected_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """The messages that ``parse_messages`` leaves out, as they came; on tables and streams."""
    return _timed(messages, schema).filter(F.col("_at").isNull()).select(*messages.columns)


def rejects_writer(messages: DataFrame, schema: StructType, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer that keeps rejected messages as Parquet; the caller starts it."""
    rejected = rejected_messages(messages, schema).writeStream.format("parquet").outputMode("append")
    return rejected.option("path", path).option("checkpointLocation", checkpoint)


def with_lateness(rows: DataFrame) -> DataFrame:
    return rows.withWatermark("timestamp", f"{int(LATENESS.total_seconds())} seconds")


def price_stream(messages: DataFrame) -> DataFrame:
    return with_lateness(parse_messages(messages, PRICE_MESSAGE))


def trade_stream(messages: DataFrame) -> DataFrame:
    return with_lateness(parse_messages(messages, TRADE_MESSAGE))


class RollingVolatility:
    """Rolling volatility of a stream of ticks, batch by batch, corrected by late ones.

    Each micro-batch is stored in a tick log. The batch's ticks change the
    result of ticks up to one span after them, and those need one more span
    before; exactly that range of the log is read back, run through the table
    operator, and upserted by key. So every tick has a result at once, and a
    late one corrects it; ``streaming.rolling`` gives final results only.

    The log's first folder level is the day, the second the batch, replaced
    when it is replayed. Days that no batch to come, and no replay, can reach
    are dropped, so what is stored and listed does not grow with time.

    Ticks older than the newest earlier tick less the allowed lateness are set
    aside in a folder of their own, as a watermark would drop them.
    """

    def __init__(self, spark: SparkSession, folder: str, span: int = SPAN) -> None:
        if dt.timedelta(seconds=span) < LATENESS:
            raise ValueError("the span must be at least the allowed lateness")
        self.spark, self.span, self.reach = spark, span, dt.timedelta(seconds=span + 1)
        self._log, self._marks, self._late = (f"{folder}/{name}" for name in ("tick_log", "tick_marks", "late_ticks"))
        self.results = KeyedTable(spark, f"{folder}/volatility_metrics", CONTRACTS["volatility_metrics"])
        self.latest = KeyedTable(spark, f"{folder}/latest_prices", CONTRACTS["latest_prices"])

    def anomalies(self, k: float = 3.0) -> DataFrame:
        """Derived on reading, since a late tick may make or unmake one."""
        return anomalies(self.results.read(), k)

    def late(self) -> DataFrame:
        """The ticks that came too late to count."""
        shape = "symbol STRING, price DOUBLE, timestamp TIMESTAMP"
        if not children(self.spark, self._late):
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(self._late)

    def days(self) -> list[str]:
        """The days in the log."""
        return [c.split("=")[1] for c in children(self.spark, self._log) if c.startswith("day=")]

    def _newest_before(self, batch_id: int) -> dt.datetime | None:
        """Newest tick of earlier batches; each batch leaves the newest so far, and the last two are kept."""
        marks = sorted(int(c.split("=")[1]) for c in children(self.spark, self._marks))
        earlier = [m for m in marks if m < batch_id]
        for old in earlier[:-2]:
            delete(self.spark, f"{self._marks}/batch_id={old}")
        if not earlier:
            return None
        return self.spark.read.schema("high TIMESTAMP").parquet(f"{self._marks}/batch_id={earlier[-1]}").first()[0]

    def _ticks(self, batch_id: int, start: dt.datetime, end: dt.datetime) -> DataFrame:
        """Stored ticks of a time range, for the batch's symbols; only the range's days are listed."""
        days = [d for d in self.days() if str(start.date()) <= d <= str(end.date())]
        log = self.spark.read.schema(
            "symbol STRING, price DOUBLE, timestamp TIMESTAMP, day DATE, batch_id BIGINT"
        ).option("basePath", self._log).parquet(*(f"{self._log}/day={d}" for d in days))
        near = log.filter((F.col("batch_id") <= batch_id) & F.col("timestamp").between(start, end))
        symbols = log.filter(F.col("batch_id") == batch_id).select(F.col("symbol").alias("_symbol")).distinct()
        return near.select("symbol", "price", "timestamp").join(symbols, F.col("symbol").eqNullSafe(F.col("_symbol")), "left_semi")

    def _drop_days(self, newest: dt.datetime) -> None:
        """Ticks still to come, or to be replayed, are at most the lateness behind ``newest`` and look back a span."""
        reached = str((newest - LATENESS - self.reach).date())
        for day in self.days():
            if day < reached:
                delete(self.spark, f"{self._log}/day={day}")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        ticks = batch.select("symbol", "price", "timestamp")
        newest = self._newest_before(batch_id)
        if newest is not None:
            late = F.col("timestamp") < F.lit(newest - LATENESS)
            ticks.filter(late).write.mode("overwrite").parquet(f"{self._late}/batch_id={batch_id}")
            ticks = ticks.filter(~late)
            self._drop_days(newest)
        seen = Observation()
        placed = ticks.withColumns({"day": F.to_date("timestamp"), "batch_id": F.lit(batch_id)}).observe(
            seen, F.min("timestamp").alias("low"), F.max("timestamp").alias("high")
        )
        # A replay writes the same days again, and only this batch's folders in them.
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(self._log)
        low, high = seen.get["low"], seen.get["high"]
        if low is None:
            return
        nearby = self._ticks(batch_id, low - self.reach, high + self.reach)
        changed = volatility(nearby, self.span).filter(F.col("timestamp").between(low, high + self.reach))
        self.results.upsert(changed, batch_id)
        self.latest.upsert(latest_prices(self.results.stored_batch(batch_id)), batch_id)
        mark = self.spark.createDataFrame([(high if newest is None else max(high, newest),)], "high TIMESTAMP")
        mark.write.mode("overwrite").parquet(f"{self._marks}/batch_id={batch_id}")

    def writer(self, ticks: DataFrame, checkpoint: str) -> DataStreamWriter:
        return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)


def start_all(spark: SparkSession, prices: DataFrame, trades: DataFrame, folder: str, checkpoints: str,
              trigger: Mapping[str, object]) -> dict[str, StreamingQuery]:
    """The four market queries over price and trade messages, and the writers of what they cannot read.

    Each has its own checkpoint; ``supervised.await_all`` watches them.
    """
    ticks, deals = price_stream(prices), trade_stream(trades)
    bars = {
        "minute_price_avg": minute_prices(ticks),
        "hourly_price_avg": hourly_prices(ticks),
        "trade_volume": trade_volume(deals),
    }
    writers = {
        name: KeyedTable(spark, f"{folder}/{name}", CONTRACTS[name]).sink(rows, f"{checkpoints}/{name}")
        for name, rows in bars.items()
    }
    writers["volatility_metrics"] = RollingVolatility(spark, folder).writer(ticks, f"{checkpoints}/volatility_metrics")
    for name, messages, schema in (("rejected_prices", prices, PRICE_MESSAGE), ("rejected_trades", trades, TRADE_MESSAGE)):
        writers[name] = rejects_writer(messages, schema, f"{folder}/{name}", f"{checkpoints}/{name}")
    return {name: writer.queryName(name).trigger(**trigger).start() for name, writer in writers.items()}
