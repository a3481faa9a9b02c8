import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemart.operators.rolling import rolling_volatility
from tidemart.plans.market import anomalies, latest_of_ticks, latest_prices, volatility

START = dt.datetime(2024, 1, 1, 0, 0, 0)


def ticks(seed, n=400):
    """One symbol holds most ticks; several share a second; prices are large."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        symbol = "hot" if i % 3 else rng.choice("ab")
        at = START + dt.timedelta(seconds=rng.randint(0, 5000), microseconds=rng.choice([0, 250000]))
        out.append((symbol, 1_000_000 + rng.random() * 5, at))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "symbol STRING, price DOUBLE, timestamp TIMESTAMP")


def expected(data, tick, span):
    second = int((tick[2] - START).total_seconds())
    near = [
        d[1] for d in data
        if d[0] == tick[0] and second - span <= int((d[2] - START).total_seconds()) <= second
    ]
    return statistics.fmean(near), statistics.stdev(near) if len(near) > 1 else None


@pytest.mark.parametrize("span", [1, 60, 900, 100_000])
def test_against_brute_force(spark, span):
    data = ticks(1)
    got = rolling_volatility(frame(spark, data), span).collect()
    assert len(got) == len(data)
    for r in got:
        mean, spread = expected(data, (r["symbol"], r["price"], r["timestamp"]), span)
        assert r["rolling_avg"] == pytest.approx(mean, rel=1e-12)
        if spread is None:
            assert r["rolling_stddev"] is None and r["volatility_pct"] is None
        else:
            assert r["rolling_stddev"] == pytest.approx(spread, rel=1e-6, abs=1e-7)
            assert r["volatility_pct"] == pytest.approx(spread / mean * 100, rel=1e-6, abs=1e-12)


def test_equal_prices_have_no_deviation(spark):
    data = [("a", 1e6 + 0.1, START + dt.timedelta(seconds=7 * i)) for i in range(300)]
    got = rolling_volatility(frame(spark, data), 60).collect()
    assert {r["rolling_avg"] for r in got} == {1e6 + 0.1}
    assert {r["rolling_stddev"] for r in got} == {None, 0.0}


def test_ticks_without_time_or_price(spark):
    data = [("a", 1.0, START), ("a", None, START), ("a", 2.0, None), ("a", 3.0, START + dt.timedelta(seconds=5))]
    got = {(r["price"], r["rolling_avg"]) for r in volatility(frame(spark, data)).collect()}
    assert got == {(1.0, 1.0), (None, 1.0), (3.0, 2.0)}


def test_anomalies(spark):
    data = [("a", 10.0 + i % 2, START + dt.timedelta(seconds=i)) for i in range(30)]
    data.append(("a", 50.0, START + dt.timedelta(seconds=40)))
    found = anomalies(volatility(frame(spark, data)), 3.0).collect()
    assert [r["price"] for r in found] == [50.0]
    assert found[0]["z_score"] > 3
    flat = [("b", 5.0, START + dt.timedelta(seconds=i)) for i in range(4)]
    assert anomalies(volatility(frame(spark, flat)), 0.1).count() == 0


def test_latest(spark, rows):
    df = frame(spark, ticks(2))
    direct, derived = latest_of_ticks(df), latest_prices(volatility(df))
    round_all = [F.col("symbol"), F.col("price"), F.col("timestamp"), F.round("avg_price", 5), F.round("volatility_pct", 8)]
    assert rows(direct, *round_all) == rows(derived, *round_all)
    newest = {s: max(t[2] for t in ticks(2) if t[0] == s) for s in ("hot", "a", "b")}
    assert {r["symbol"]: r["timestamp"] for r in direct.collect()} == newest
