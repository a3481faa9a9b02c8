import datetime as dt
import json
from decimal import Decimal

from tidemart.operators import reshape
from tidemart.schemas import (
    COIN_DOC, GAS_DOC, KLINE_DOC, PRICE_TICK_DOC, STOCK_DOC, TRADE_DOC, WEATHER_DOC,
)
from tidemart.sources.documents import parse_documents, read_documents

AT = dt.datetime(2024, 5, 1, 12, 0)


def parsed(spark, schema, *docs):
    text = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    return parse_documents(spark.createDataFrame(text, "value STRING"), schema)


def test_broken_record_costs_only_itself(spark, rows):
    split = parsed(spark, PRICE_TICK_DOC, {"symbol": "A", "price": "1.5"}, "{oops", {"symbol": "B", "price": "x"})
    assert rows(reshape.price_ticks(split.kept, AT)) == [("A", 1.5, AT), ("B", None, AT)]
    assert rows(split.rejected) == [("{oops",)]


def test_files(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('{"symbol": "A", "price": "2"}\nnot json\n')
    split = read_documents(spark, str(tmp_path), PRICE_TICK_DOC)
    assert rows(split.kept) == [("A", "2")] and rows(split.rejected) == [("not json",)]


def test_klines(spark):
    doc = {"symbol": "A", "interval": "1m", "klines": [[1704067200000, "0.01", "0.03", "0.005", "0.02", "148976.5", 1704067259999, "x"]]}
    row = reshape.klines(parsed(spark, KLINE_DOC, doc, {"symbol": "B", "interval": "1m"}).kept).collect()
    assert len(row) == 1
    assert row[0]["open_time"] == dt.datetime(2024, 1, 1) and row[0]["close_time"] == dt.datetime(2024, 1, 1, 0, 0, 59, 999000)
    assert row[0]["open"] == Decimal("0.01") and row[0]["volume"] == Decimal("148976.5")


def test_trades(spark):
    doc = {"symbol": "A", "trades": [{"id": 7, "price": "4.10", "qty": "2", "time": 1704067200500}, {"id": 8, "price": "bad", "qty": "1", "time": 0}]}
    got = reshape.recent_trades(parsed(spark, TRADE_DOC, doc).kept).orderBy("trade_id").collect()
    assert (got[0]["trade_id"], got[0]["price"], got[0]["quantity"]) == (7, Decimal("4.10"), Decimal("2"))
    assert got[0]["trade_time"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000) and got[1]["price"] is None


def test_coins(spark):
    usd = {"price": 1.5, "volume_24h": 2.0, "market_cap": 3.0, "percent_change_24h": -4.0}
    docs = [{"id": "x", "name": "X", "symbol": "XX", "rank": 1, "last_updated": "t", "quotes": {"USD": usd}}, {"id": "y", "quotes": {}}, {"id": "z"}]
    got = reshape.coin_tickers(parsed(spark, COIN_DOC, *docs).kept).orderBy("id").collect()
    assert got[0].asDict() == {"id": "x", "name": "X", "symbol": "XX", "rank": 1, **usd, "last_updated": "t"}
    assert got[1]["price"] is None and got[2]["price"] is None


def test_stock_bars(spark):
    docs = [{"ticker": "A", "results": [{"t": 1704067200000, "o": 1.0, "h": 4.0, "l": 2.0, "c": 3.5, "v": 9.0, "n": 5}]}, {"ticker": "B"}]
    got = reshape.stock_bars(parsed(spark, STOCK_DOC, *docs).kept).collect()
    assert len(got) == 1
    r = got[0].asDict()
    assert (r["ticker"], r["avg_price"], r["price_change"], r["volume"], r["n"], r["vw"]) == ("A", 3.0, 2.5, 9.0, 5, None)
    assert r["timestamp"] == dt.datetime(2024, 1, 1) and r["t"] == 1704067200000


def test_gas_prices(spark, rows):
    docs = [
        {"state_code": "CA", "result": {"state": {"name": "California", "lowerName": "california", "midGrade": "5"}, "cities": [{"name": "Chico"}, None]}},
        {"state_code": "TX", "result": {"cities": []}},
        {"state_code": "FL"},
    ]
    got = reshape.gas_prices(parsed(spark, GAS_DOC, *docs).kept, AT)
    assert got.columns == ["currency", "name", "lowername", "gasoline", "midgrade", "premium", "diesel", "state_code", "level", "ingestion_time"]
    assert rows(got, "name", "level", "state_code", "midgrade") == [("California", "state", "CA", "5"), ("Chico", "city", "CA", None)]


def test_weather(spark):
    doc = {"location": {"name": "Nairobi", "region": "R", "country": "Kenya"}, "current": {"temp_c": 21.5, "humidity": 60, "wind_kph": 9.0, "condition": {"text": "Sunny"}, "last_updated": "2024-05-01 11:45"}}
    r = reshape.weather(parsed(spark, WEATHER_DOC, doc, {"location": {"name": "Nowhere"}}).kept, AT).orderBy("city").first()
    assert tuple(r) == ("Nairobi", "R", "Kenya", 21.5, 60, 9.0, "Sunny", dt.datetime(2024, 5, 1, 11, 45), AT)
