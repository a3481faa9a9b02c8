import datetime as dt
import json
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemart.operators.bars import hourly_prices, minute_prices, trade_volume
from tidemart.plans.market import volatility
from tidemart.plans.registry import STREAMS
from tidemart.schemas import CONTRACTS
from tidemart.session import ROCKSDB, STATE_STORE
from tidemart.sinks.keyed import KeyedTable
from tidemart.sinks.messages import console_sink, message_sink
from tidemart.sources.streams import text_messages
from tidemart.streaming import supervised
from tidemart.streaming.market import RollingVolatility, price_stream, start_all, trade_stream
from tidemart.streaming.rolling import joined_volatility, released_volatility

START = dt.datetime(2024, 1, 1)


def price(symbol, value, minute, second=0):
    at = START + dt.timedelta(minutes=minute, seconds=second)
    return {"symbol": symbol, "price": value, "quantity": 2.0, "timestamp": at.isoformat()}


class Topic:
    """A folder of message files, one file per micro-batch."""

    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir()

    def land(self, *messages):
        path = self.folder / f"{self.files:04d}.json"
        path.write_text("".join((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self, spark):
        return text_messages(spark, str(self.folder), files_per_batch=1)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def minute_table(spark, topic, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/minutes", CONTRACTS["minute_price_avg"])
    return table, lambda: run(table.sink(minute_prices(price_stream(topic.stream(spark))), f"{tmp_path}/check"))


def test_closed_windows_late_rows_and_restart(spark, rows, topic, tmp_path):
    table, step = minute_table(spark, topic, tmp_path)
    topic.land(price("a", 1.0, 0), price("a", 3.0, 0, 30), "not json", price("a", 5.0, 30))
    topic.land(price("a", 5.0, 30))  # Spark applies a watermark to late rows one batch later
    topic.land(price("a", 100.0, 0, 40), price("a", 7.0, 25))  # minute 0 is over, minute 25 is not
    step()
    columns = ["symbol", F.minute("window_start"), "avg_price", "tick_count"]
    assert rows(table.read(), *columns) == [("a", 0, 2.0, 2)]
    step()  # nothing new: a restart from the checkpoint adds nothing
    assert rows(table.read(), *columns) == [("a", 0, 2.0, 2)]
    topic.land(price("a", 9.0, 60))
    step()
    assert rows(table.read(), *columns) == [("a", 0, 2.0, 2), ("a", 25, 7.0, 1), ("a", 30, 5.0, 2)]


def test_rolling_volatility_equals_the_table_result(spark, rows, topic, tmp_path):
    minutes = [0, 10, 30, 59, 61, 75, 130, 131, 200, 260]
    messages = [price(s, 100.0 + (i * 7) % 5, m, i) for i, m in enumerate(minutes) for s in "ab"]
    for i in range(0, len(messages), 5):
        topic.land(*messages[i:i + 5])
    # a little late: within ten minutes of the newest tick, so it changes results already written
    topic.land(price("a", 150.0, 255))
    # too late
    topic.land(price("a", 500.0, 200))
    rolling = RollingVolatility(spark, f"{tmp_path}/rolling")
    run(rolling.writer(price_stream(topic.stream(spark)), f"{tmp_path}/check"))
    kept = [m for m in messages] + [price("a", 150.0, 255)]
    data = [(m["symbol"], m["price"], dt.datetime.fromisoformat(m["timestamp"])) for m in kept]
    whole = volatility(spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP"))
    columns = ["symbol", "timestamp", "price"] + [F.round(c, 9) for c in ("rolling_avg", "rolling_stddev", "volatility_pct")]
    assert rows(rolling.results.read(), *columns) == rows(whole, *columns)
    newest = {r["symbol"]: r["timestamp"] for r in rolling.latest.read().collect()}
    assert newest == {s: max(d[2] for d in data if d[0] == s) for s in "ab"}
    assert rolling.anomalies(0.5).count() > 0


def test_replayed_batch_changes_nothing(spark, rows, tmp_path):
    rolling = RollingVolatility(spark, f"{tmp_path}/rolling")
    data = [("a", float(i), START + dt.timedelta(minutes=i)) for i in range(5)]
    batch = spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP")
    rolling.process(batch, 0)
    once = rows(rolling.results.read())
    rolling.process(batch, 0)
    assert rows(rolling.results.read()) == once and len(once) == 5
    rolling.process(batch.limit(0), 1)
    assert rows(rolling.results.read()) == once


def test_four_streams(spark, rows, topic, tmp_path):
    topic.land(*[price("a", float(i), i * 3) for i in range(60)])
    running = start_all(spark, topic.stream(spark), topic.stream(spark), f"{tmp_path}/out", f"{tmp_path}/check", {"availableNow": True})
    assert sorted(running) == [
        "hourly_price_avg", "minute_price_avg", "rejected_prices", "rejected_trades", "trade_volume", "volatility_metrics"
    ]
    for query in running.values():
        query.awaitTermination()
    data = [("a", float(i), 2.0, START + dt.timedelta(minutes=i * 3)) for i in range(60)]
    table = spark.createDataFrame(data, "symbol STRING, price DOUBLE, quantity DOUBLE, timestamp TIMESTAMP")
    closed = F.col("window_end") <= F.lit(START + dt.timedelta(minutes=59 * 3 - 10))
    for name, whole in {
        "minute_price_avg": minute_prices(table), "hourly_price_avg": hourly_prices(table), "trade_volume": trade_volume(table)
    }.items():
        stored = KeyedTable(spark, f"{tmp_path}/out/{name}", CONTRACTS[name]).read()
        expected = whole.filter(closed)
        assert expected.count() > 0 and rows(stored) == rows(expected.select(*stored.columns))
    assert KeyedTable(spark, f"{tmp_path}/out/volatility_metrics", CONTRACTS["volatility_metrics"]).read().count() == 60


def test_message_sink_and_update_mode(spark, topic, tmp_path):
    topic.land(price("a", 1.0, 0), price("a", 2.0, 0, 5))
    topic.land(price("a", 6.0, 0, 10))
    run(message_sink(trade_stream(topic.stream(spark)), f"{tmp_path}/c1", "text", {"path": f"{tmp_path}/m"}))
    sent = [json.loads(r[0]) for r in spark.read.text(f"{tmp_path}/m").collect()]
    assert sorted(m["price"] for m in sent) == [1.0, 2.0, 6.0] and sent[0]["quantity"] == 2.0
    run(console_sink(minute_prices(price_stream(topic.stream(spark))), "changes", "memory"))
    assert sorted(r["avg_price"] for r in spark.table("changes").collect()) == [1.5, 3.0]


@pytest.mark.parametrize("shape, reads", [(joined_volatility, 2), (released_volatility, 1)])
def test_final_statistics_inside_the_stream(spark, rows, topic, tmp_path, shape, reads):
    rng = random.Random(7)
    moments = sorted(rng.sample(range(0, 6 * 3600), 200))
    sent = [price(rng.choice("ab"), 100 + rng.random(), 0, at) for at in moments] + [price("a", None, 100), price(None, 5.0, 101)]
    near = sorted(sent, key=lambda m: dt.datetime.fromisoformat(m["timestamp"]) + dt.timedelta(seconds=rng.random() * 500))
    for i in range(0, len(near), 40):
        topic.land(*near[i:i + 40])
    topic.land(price("b", 1.0, 6 * 60 + 200))  # moves the watermark on
    topic.land(price("a", 777.0, 10))  # far too late
    table = KeyedTable(spark, f"{tmp_path}/out", CONTRACTS["volatility_metrics"])
    query = run(table.sink(shape(price_stream(topic.stream(spark))), f"{tmp_path}/check"))
    data = [(m["symbol"], m["price"], dt.datetime.fromisoformat(m["timestamp"])) for m in sent]
    whole = volatility(spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP"))
    columns = ["symbol", "timestamp", "price"] + [F.round(c, 7) for c in ("rolling_avg", "rolling_stddev", "volatility_pct")]
    assert rows(table.read(), *columns) == rows(whole, *columns) and len(sent) == 202
    assert supervised.rows_seen(query.recentProgress) == reads * 204 and supervised.rows_late(query.recentProgress) >= 1
    # What is remembered is bounded by the span, not by what went by.
    assert query.recentProgress[-1].stateOperators[-1].numRowsTotal <= 8


def test_log_and_tables_do_not_grow_with_batches(spark, rows, tmp_path):
    rolling = RollingVolatility(spark, f"{tmp_path}/rolling", span=600)
    every, listed = [], []
    for k in range(50):
        at = START + dt.timedelta(hours=8 * k)
        data = [("a", float(k), at), ("b", float(k % 7), at + dt.timedelta(seconds=k))]
        every += data
        rolling.process(spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP"), k)
        listed.append(len(rolling.days()))
    assert max(listed) <= 3 and len(os.listdir(f"{tmp_path}/rolling/tick_marks")) <= 3
    assert len(rolling.results.folders()) <= 2 * 8
    late = spark.createDataFrame([("a", 9.0, START)], "symbol STRING, price DOUBLE, timestamp TIMESTAMP")
    rolling.process(late, 50)
    assert rows(rolling.late()) == [("a", 9.0, START)]
    whole = volatility(spark.createDataFrame(every, "symbol STRING, price DOUBLE, timestamp TIMESTAMP"), 600)
    assert rows(rolling.results.read(), "symbol", "timestamp", "rolling_avg") == rows(whole, "symbol", "timestamp", "rolling_avg")


def test_a_crash_between_write_and_commit(spark, rows, topic, tmp_path):
    for i in range(4):
        topic.land(*[price("a", float(i * 10 + k), i * 30 + k) for k in range(10)])
    rolling = RollingVolatility(spark, f"{tmp_path}/rolling")
    crashes = [1, 3]

    def process(batch, batch_id):
        rolling.process(batch, batch_id)
        if crashes and batch_id == crashes[0]:
            crashes.pop(0)
            raise RuntimeError("lost before the commit")

    writer = price_stream(topic.stream(spark)).writeStream.option("checkpointLocation", f"{tmp_path}/check").foreachBatch(process)
    failures = 0
    for _ in range(3):
        try:
            run(writer)
        except StreamingQueryException:
            failures += 1
    assert failures == 2 and not crashes
    data = [("a", float(i * 10 + k), START + dt.timedelta(minutes=i * 30 + k)) for i in range(4) for k in range(10)]
    whole = volatility(spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP"))
    columns = ["timestamp", F.round("rolling_avg", 9), F.round("rolling_stddev", 9)]
    assert rows(rolling.results.read(), *columns) == rows(whole, *columns)


def test_a_failed_stream_stops_the_others(spark, topic, tmp_path):
    topic.land(price("a", 1.0, 0))

    def fail(batch, batch_id):
        raise RuntimeError("broken sink")

    ticks = price_stream(topic.stream(spark))
    good = ticks.writeStream.option("checkpointLocation", f"{tmp_path}/c1").format("noop").queryName("good").start()
    bad = ticks.writeStream.option("checkpointLocation", f"{tmp_path}/c2").foreachBatch(fail).queryName("bad").start()
    with pytest.raises(RuntimeError, match="stream bad failed"):
        supervised.await_all({"good": good, "bad": bad})
    assert not good.isActive and not bad.isActive


def test_supervision_counts_rows_and_rejects_are_kept(spark, topic, tmp_path):
    topic.land(price("a", 1.0, 0), price("a", 2.0, 1), "not json")
    running = start_all(spark, topic.stream(spark), topic.stream(spark), f"{tmp_path}/out", f"{tmp_path}/check", {"availableNow": True})
    supervised.await_all(running)
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/out/rejected_prices").collect()] == ["not json"]
    assert spark.read.parquet(f"{tmp_path}/out/rejected_trades").count() == 1


@pytest.fixture
def events(spark, tmp_path):
    """A folder with an events table: two symbols, a tick every 40 seconds over five hours."""
    data = [(k, START + dt.timedelta(seconds=40 * k), 1, "ab"[k % 2], float(k * 7 % 31), "{}") for k in range(450)]
    shape = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(data, shape).write.parquet(f"{tmp_path}/data/events.parquet")
    return f"{tmp_path}/data"


def test_keyed_state_needs_no_session_of_its_own(spark, events):
    heap = ROCKSDB.replace("RocksDBStateStoreProvider", "HDFSBackedStateStoreProvider")
    spark.conf.set(STATE_STORE, heap)  # what a session has that sets nothing
    try:
        released = STREAMS["stream_released_volatility"](spark, events)
        counts = STREAMS["stream_late_counts"](spark, events).first()
        assert spark.conf.get(STATE_STORE) == heap
    finally:
        spark.conf.set(STATE_STORE, ROCKSDB)
    assert counts.input_rows == 450 and counts.late_rows > 0
    assert released.count() == counts.released_rows > 400


def test_joined_statistics_of_short_spans_and_dense_ticks(spark, rows, topic, tmp_path):
    rng = random.Random(3)
    sent = [price("ab"[k % 5 == 0], 100 + rng.random(), 0, k / 3) for k in range(2400)]
    topic.land(*sent[:1000])
    topic.land(*sent[1000:])
    topic.land(price("b", 1.0, 60))  # moves the watermark on
    data = [(m["symbol"], m["price"], dt.datetime.fromisoformat(m["timestamp"])) for m in sent]
    ticks = spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP")
    # A second is compared with two blocks of its symbol, not with all of it.
    assert "past_block" in joined_volatility(ticks)._jdf.queryExecution().optimizedPlan().toString()
    columns = ["symbol", "timestamp", "price"] + [F.round(c, 7) for c in ("rolling_avg", "rolling_stddev")]
    for span in (130, 1):
        table = KeyedTable(spark, f"{tmp_path}/out{span}", CONTRACTS["volatility_metrics"])
        run(table.sink(joined_volatility(price_stream(topic.stream(spark)), span), f"{tmp_path}/check{span}"))
        assert rows(table.read(), *columns) == rows(volatility(ticks, span), *columns)
