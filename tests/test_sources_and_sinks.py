import datetime as dt
import json
import os
from decimal import Decimal
from pathlib import Path

import pytest

from tidemart.schemas import COMMERCE, CONTRACTS, RETAIL, STRING, schema
from tidemart.session import clear_work, fresh_path, pin, shared_folder
from tidemart.sinks.files import write_csv, write_partitioned, write_rejects, write_summaries, write_table
from tidemart.sinks.keyed import KeyedTable, of_symbols, recent
from tidemart.sinks.messages import as_messages, publish, table_append
from tidemart.sources.csv_tables import land, read_commerce_folder, read_csv
from tidemart.sources.keyset import BEFORE, KeysetSource, keyset_stream
from tidemart.sources.relational import (
    KeysetReader, after_mark, jdbc_table, literal_table, register, replay, retail_from_parquet,
)
from tidemart.sources.streams import kafka_messages

CUSTOMERS = "customer_id,signup_date,country,customer_tier,email\nC1,2024-01-02,KE,Gold,a@x\n,2024-01-02,KE,Gold,\nC2,02/01/2024,UG,,\n"
ORDERS = "order_id,customer_id,order_date,status,total_amount,discount_pct\nO1,C1,2024-01-03,paid,12.5,10\nO2,C1,2024-01-03,paid,twelve,\n"


def commerce_folder(tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    (tmp_path / "orders.csv").write_text(ORDERS)
    (tmp_path / "order_items.csv").write_text("item_id,order_id,product_id,category,quantity,unit_price\nI1,O1,P1,toys,2,6.25\n")
    (tmp_path / "returns.csv").write_text("return_id,order_id,return_date,reason,refund_amount\nR1,O1,2024-02-01,late,\n")
    return str(tmp_path)


def test_csv_by_header_name(spark, rows, tmp_path):
    folder = commerce_folder(tmp_path)
    df = read_csv(spark, f"{folder}/customers.csv", COMMERCE["customers"])
    assert df.columns == COMMERCE["customers"].names
    assert rows(df)[1] == ("C1", "a@x", "KE", "Gold", "2024-01-02")
    orders = read_csv(spark, f"{folder}/orders.csv", COMMERCE["orders"])
    assert rows(orders, "order_id", "total_amount", "discount_pct") == [("O1", 12.5, 10.0), ("O2", None, None)]


def test_commerce_folder(spark, rows, tmp_path):
    intake = read_commerce_folder(spark, commerce_folder(tmp_path))
    assert rows(intake.rejects()) == [("customers", 3, 1), ("order_items", 1, 0), ("orders", 2, 0), ("returns", 1, 0)]
    assert intake.kept["customers"].count() == 2 and intake.rejected["customers"].count() == 1


def test_literal_rows_views_and_folders(spark, rows, tmp_path):
    product = (1, "Laptop", "Electronics", Decimal("999.99"), "S", 5)
    tables = {
        "customers": [(1, "A", "B", "e", "p", dt.date(2024, 1, 1), "Gold")],
        "products": [product],
        "sales": [(1, 1, 1, 2, dt.date(2024, 1, 2), Decimal("1999.98"))],
        "inventory": [(1, 5)],
    }
    frames = {n: literal_table(spark, n, r) for n, r in tables.items()}
    register(frames, "shop_")
    assert spark.sql("SELECT price FROM shop_products").first()[0] == Decimal("999.99")
    for name, df in frames.items():
        write_table(df, f"{tmp_path}/{name}")
    retail = retail_from_parquet(spark, str(tmp_path))
    assert rows(retail.products) == [product] and retail.lines is retail.sales
    assert retail.sales.schema == RETAIL["sales"]


def test_writes_replace(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 2023, 1), (2, 2024, 2), (3, 2024, 2)], "a INT, y INT, m INT")
    for _ in range(2):
        write_partitioned(df, f"{tmp_path}/p", "y", "m")
        write_csv(df, f"{tmp_path}/c", single_file=True)
    assert rows(spark.read.parquet(f"{tmp_path}/p"), "a", "y", "m") == rows(df)
    assert (tmp_path / "p" / "y=2024" / "m=2").is_dir()
    assert len(list((tmp_path / "c").glob("part-*.csv"))) == 1
    assert rows(read_csv(spark, f"{tmp_path}/c", df.schema)) == rows(df)
    write_summaries({"x": df}, str(tmp_path))
    assert (tmp_path / "summary_x" / "_SUCCESS").exists()


def test_rejects_only_where_any(spark, rows, tmp_path):
    intake = read_commerce_folder(spark, commerce_folder(tmp_path))
    assert set(intake.rejected) == {"customers"}
    write_rejects(intake.rejected, str(tmp_path))
    assert (tmp_path / "rejected" / "customers").exists() and not (tmp_path / "rejected" / "orders").exists()


def test_text_is_parsed_once(spark, rows, tmp_path):
    """After landing, neither rows nor counts need the CSV file; an empty table lands too."""
    folder = commerce_folder(tmp_path)
    intake = read_commerce_folder(spark, folder)
    for name in COMMERCE:
        (tmp_path / f"{name}.csv").write_text("gone\n")
    assert rows(intake.rejects())[0] == ("customers", 3, 1)
    assert rows(intake.kept["customers"], "customer_id") == [("C1",), ("C2",)]
    assert rows(intake.rejected["customers"], "customer_tier") == [("Gold",)]
    plan = intake.rejected["customers"]._jdf.queryExecution().toString()
    assert "IsNull(customer_id)" in plan and "csv" not in plan.lower().replace("csv-customers", "")
    nothing = land(spark.createDataFrame([], COMMERCE["orders"]), "order_id", "nothing")
    assert (nothing.row_count, nothing.rejected_count, nothing.kept.count()) == (0, 0, 0)


LATEST = CONTRACTS["latest_prices"]


def prices(spark, *data):
    return spark.createDataFrame([(s, p, dt.datetime(2024, 1, 1), None, None) for s, p in data], LATEST.schema)


def test_upsert_and_replay(spark, rows, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", LATEST)
    table.upsert(prices(spark, ("a", 1.0), ("b", 2.0)), 0)
    table.upsert(prices(spark, ("a", 3.0), ("c", 4.0)), 1)
    expected = [("a", 3.0), ("b", 2.0), ("c", 4.0)]
    assert rows(table.read(), "symbol", "price") == expected
    table.upsert(prices(spark, ("a", 3.0), ("c", 4.0)), 1)  # the same batch again
    assert rows(table.read(), "symbol", "price") == expected
    fresh = table.rewritten(f"{tmp_path}/t2", 1)
    fresh.upsert(prices(spark, ("b", 9.0)), 2)
    assert rows(fresh.read(), "symbol", "price") == [("a", 3.0), ("b", 9.0), ("c", 4.0)]
    assert rows(of_symbols(table.read(), ["a", "z"]), "symbol") == [("a",)]
    assert rows(recent(table.read(), LATEST, 2), "symbol") == [("a",), ("b",)]


@pytest.mark.parametrize("name,expected", [("minute_price_avg", [3, 2]), ("volatility_metrics", [0, 1])])
def test_reads_in_table_order(spark, name, expected):
    contract = CONTRACTS[name]
    data = [tuple(["s", dt.datetime(2024, 1, 1, 0, i)] + [None] * (len(contract.schema) - 2)) for i in range(4)]
    got = recent(spark.createDataFrame(data, contract.schema), contract, 2, "s").collect()
    assert [r[contract.order].minute for r in got] == expected


def test_weather_table(spark, rows, tmp_path):
    contract = CONTRACTS["weather_data"]
    table = KeyedTable(spark, f"{tmp_path}/w", contract)
    day = dt.datetime(2024, 1, 1)
    table.upsert(spark.createDataFrame([("x", day, 1.0, 2, 3.0, "Sunny")], contract.schema), 0)
    table.upsert(spark.createDataFrame([("x", day, 9.0, 2, 3.0, "Rain"), ("y", day, 1.0, 2, 3.0, "Fog")], contract.schema), 1)
    assert rows(table.read(), "city", "temperature_c") == [("x", 9.0), ("y", 1.0)]


def test_keyed_tables_merge_their_batches(spark, rows, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", LATEST)
    expected, most = {}, 0
    for k in range(30):
        new = {f"s{k % 5}": float(k), f"t{k}": 1.0}
        expected |= new
        table.upsert(prices(spark, *new.items()), k)
        if k % 9 == 0:
            table.upsert(prices(spark, *new.items()), k)  # replayed
        most = max(most, len(table.folders()))
    assert most <= 8 + 3 and rows(table.read(), "symbol", "price") == sorted(expected.items())
    # One upsert later the folders that a merged one covers are gone, and a replay of those is refused.
    assert len(os.listdir(f"{tmp_path}/t")) <= 8 + 8 + 3
    with pytest.raises(ValueError, match="merged"):
        table.upsert(prices(spark, ("a", 1.0)), 2)
    # A merge that was cut off half way is as if it had not been.
    (tmp_path / "t" / "batches=0-29").mkdir()
    assert rows(table.read(), "symbol", "price") == sorted(expected.items())


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([("a", Decimal("1.50"), dt.datetime(2024, 1, 1, 1, 2, 3))], "symbol STRING, price DECIMAL(10,2), timestamp TIMESTAMP")
    assert json.loads(as_messages(df).first()[0]) == {"symbol": "a", "price": 1.5, "timestamp": "2024-01-01T01:02:03.000000"}
    publish(df, "text", {"path": f"{tmp_path}/m"})
    assert spark.read.text(f"{tmp_path}/m").count() == 1
    table_append(df, f"{tmp_path}/t")
    table_append(df, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_keyset_reader(spark, rows, tmp_path):
    df = spark.range(1, 26).toDF("id")
    assert rows(after_mark(df, "id", 20, 3)) == [(21,), (22,), (23,)]
    reader, published = KeysetReader(df, "id", f"{tmp_path}/state"), []
    assert reader.mark() == 0
    assert replay(reader, lambda page: published.append([r[0] for r in page.collect()]), limit=10) == 3
    assert [i for page in published for i in page] == list(range(1, 26))
    later = KeysetReader(spark.range(1, 28).toDF("id"), "id", f"{tmp_path}/state")
    assert rows(later.poll(10)) == [(26,), (27,)]


def test_connectors_need_their_jars(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:1", "t")
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_table(spark, {"url": "jdbc:postgresql://localhost:1/x"}, "t")


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    df = spark.range(3)
    assert pin(df).inputFiles() and pin(df).count() == 3


def test_clearing_work_leaves_other_files(spark):
    pinned = pin(spark.range(3)).inputFiles()
    other = f"{shared_folder(spark)}/other"
    spark.range(1).write.mode("overwrite").parquet(other)
    clear_work(spark)
    assert not any(Path(f.removeprefix("file://")).exists() for f in pinned)
    assert spark.read.parquet(other).count() == 1


def test_csv_folder_with_columns_in_different_orders(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,email,country\nC1,a@x,DE\nC3,,FR\n")
    (tmp_path / "b.csv").write_text("country,customer_id,email\nBE,C2,b@x\n")
    (tmp_path / "c.csv").write_text("email,customer_id\nd@x,C4\n")
    got = read_csv(spark, str(tmp_path), schema(customer_id=STRING, email=STRING))
    assert rows(got) == [("C1", "a@x"), ("C2", "b@x"), ("C3", None), ("C4", "d@x")]


def keyed(spark, *ids):
    return spark.createDataFrame([(i, f"v{i}", dt.datetime(2024, 1, 1)) for i in ids], "id LONG, v STRING, at TIMESTAMP")


def test_keyset_ranges(spark, tmp_path):
    """Offsets follow the largest key; a range is cut by row groups and read whole."""
    path = f"{tmp_path}/t"
    schema = keyed(spark).schema

    def reader(**options):
        return KeysetSource({"path": path, "key": "id", **options}).streamReader(schema)

    assert reader().latestOffset() == reader().initialOffset() == {"key": BEFORE}
    assert reader().partitions({"key": BEFORE}, {"key": BEFORE}) == []
    keyed(spark, *range(40), None).repartition(4).write.parquet(path)
    (tmp_path / "t" / "_temporary").mkdir()
    (tmp_path / "t" / "_temporary" / "half.parquet").write_text("not yet")
    first = reader(rows_per_task="1")
    assert first.latestOffset() == {"key": 39}
    parts = first.partitions({"key": 5}, {"key": 39})
    assert len(parts) == 4
    got = [r["id"] for part in parts for batch in first.read(part) for r in batch.to_pylist()]
    assert sorted(got) == list(range(6, 40))
    assert len(reader().partitions({"key": 5}, {"key": 39})) == 1
    with pytest.raises(ValueError, match="again"):
        first.partitions({"key": 50}, {"key": 39})
    with pytest.raises(ValueError, match="whole number"):
        KeysetSource({"path": path, "key": "v"}).streamReader(schema)


def test_keyset_stream_goes_on_from_its_checkpoint(spark, rows, tmp_path):
    path, out = f"{tmp_path}/t", f"{tmp_path}/out"

    def run(**options):
        stream = keyset_stream(spark, path, keyed(spark).schema, "id", **options).select("id", "v")
        writer = stream.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
        writer.format("parquet").start(out).awaitTermination()
        return [r[0] for r in rows(spark.read.schema("id LONG, v STRING").parquet(out), "id")]

    keyed(spark, -3, 1, 2, 7).write.parquet(path)
    assert run(after=-3) == [1, 2, 7]
    assert run() == [1, 2, 7]
    keyed(spark, 8, 9, None).write.mode("append").parquet(path)
    assert run() == [1, 2, 7, 8, 9]
