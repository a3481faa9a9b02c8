import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.plans import commerce, registry
from tidemart.plans.marts import SCHEMAS
from tidemart.schemas import COMMERCE
from tidemart.session import CLEANUP, children, shuffles_deleted, shuffles_of, work_folder
from tidemart.sources.csv_tables import read_csv

D = dt.date


def make(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture
def shop(spark):
    orders = make(
        spark, "order_id STRING, customer_id STRING, order_date DATE, total_amount DOUBLE, discount_pct DOUBLE",
        ("o1", "c1", D(2024, 1, 1), 100.0, 10.0),
        ("o2", "c1", D(2024, 1, 2), 50.0, 0.0),
        ("o3", "c2", D(2024, 1, 20), None, 0.0),
        ("o4", "c9", D(2024, 1, 3), 10.0, 0.0),   # unknown customer
        ("o5", "c1", D(2024, 1, 20), 20.0, 50.0),
    )
    customers = make(
        spark, "customer_id STRING, country STRING, customer_tier STRING",
        ("c1", "KE", "gold"), ("c2", "KE", "silver"), ("c3", "UG", "gold"),
    )
    items = make(
        spark, "item_id STRING, order_id STRING, category STRING",
        ("i2", "o1", "toys"), ("i1", "o1", "books"), ("i3", "o2", "toys"), ("i4", "o4", "toys"), ("i5", "oX", "toys"), ("i6", None, "toys"),
    )
    returns = make(
        spark, "return_id STRING, order_id STRING, refund_amount DOUBLE",
        ("r1", "o1", 95.0), ("r2", "o2", None), ("r3", "o2", 10.0), ("r4", "oX", 5.0),
    )
    return {"orders": orders, "customers": customers, "items": items, "returns": returns,
            "enriched": commerce.enrich(orders, customers, items)}


def test_enrich(shop, rows):
    got = rows(shop["enriched"], "order_id", "item_id", "net_amount", "order_year", "order_month")
    assert got == [
        ("o1", "i1", 90.0, 2024, 1), ("o1", "i2", 90.0, 2024, 1), ("o2", "i3", 50.0, 2024, 1),
        ("o3", None, None, 2024, 1), ("o5", None, 10.0, 2024, 1),
    ]
    assert rows(commerce.orphans(shop["items"], "order_id", shop["orders"]), "item_id") == [("i5",), ("i6",)]


def test_summaries(shop, rows):
    enriched = shop["enriched"]
    # the two items of o1 count its amount twice, as stated
    assert rows(commerce.spend_rank(enriched)) == [("c1", "KE", 240.0, 1), ("c2", "KE", None, 2)]
    assert rows(commerce.spend_rank(commerce.per_order(enriched)), "customer_id", "total_spent") == [("c1", 150.0), ("c2", None)]
    assert rows(commerce.revenue_share(enriched), "category", "total_revenue", F.round("revenue_share", 4)) == [
        (None, 10.0, 0.0417), ("books", 90.0, 0.375), ("toys", 140.0, 0.5833)
    ]
    assert rows(commerce.per_order(enriched), "order_id", "category") == [
        ("o1", "books"), ("o2", "toys"), ("o3", None), ("o5", None)
    ]


def test_rolling(shop, rows):
    by_rows = rows(commerce.rolling_orders(shop["enriched"]).filter("customer_id = 'c1'"), "order_date", "rolling_7d_orders")
    by_days = rows(commerce.rolling_orders(shop["enriched"], by_calendar=True).filter("customer_id = 'c1'"), "order_date", "rolling_7d_orders")
    assert by_rows == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 20), 3)]
    assert by_days == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 20), 1)]


def test_returns(shop, rows):
    once = commerce.per_order(shop["enriched"])
    back = commerce.enrich_returns(shop["returns"], once)
    assert rows(back, "return_id", "customer_id", "refund_exceeds_order") == [
        ("r1", "c1", True), ("r2", "c1", None), ("r3", "c1", False), ("r4", None, None)
    ]
    assert rows(commerce.returns_by(back, "category")) == [(None, 1), ("books", 1), ("toys", 1)]
    assert rows(commerce.returns_by(back, "customer_tier")) == [(None, 1), ("gold", 2)]
    assert rows(commerce.top_refunds(back)) == [(None, 5.0), ("c1", 105.0)]
    assert rows(commerce.return_rate_by(back, once, "customer_tier"), "customer_tier", "total_orders", "total_returns", "return_rate") == [
        ("gold", 3, 2, 2 / 3), ("silver", 1, 0, 0.0)
    ]


def untidy_folder(tmp_path, seed=11):
    """CSV files with every flaw the job knows."""
    rng = random.Random(seed)
    tiers = ["Gold", "GOLD", "gold", "Silver", "SILVER ".strip(), "bronze"]

    def day():
        d = D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 200))
        return d.strftime(rng.choice(["%Y-%m-%d", "%d/%m/%Y"]))

    def lines(n, build):
        out = [build(i) for i in range(n)]
        return out + rng.sample(out, n // 10)  # exact copies

    tables = {
        "customers": ("customer_id,signup_date,country,customer_tier,email", lines(60, lambda i: f"C{i},{day()},N{i % 5},{rng.choice(tiers)},{'' if i % 9 == 0 else f'c{i}@x'}")),
        "orders": ("order_id,customer_id,order_date,status,total_amount,discount_pct", lines(300, lambda i: f"{'' if i % 50 == 3 else f'O{i}'},{'' if i % 40 == 7 else f'C{rng.randint(0, 64)}'},{day()},paid,{round(rng.uniform(-20, 500), 2)},{rng.choice([0, 5, 12.5])}")),
        "order_items": ("item_id,order_id,product_id,category,quantity,unit_price", lines(500, lambda i: f"{'' if i % 60 == 1 else f'I{i}'},O{rng.randint(0, 310)},P{i % 20},{rng.choice(['toys', 'books', 'home'])},{rng.randint(1, 4)},9.5")),
        "returns": ("return_id,order_id,return_date,reason,refund_amount", lines(80, lambda i: f"R{i},O{rng.randint(0, 330)},{day()},late,{'' if i % 11 == 0 else round(rng.uniform(-10, 300), 2)}")),
    }
    for name, (header, body) in tables.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *body]) + "\n")
    return str(tmp_path)


def test_whole_batch(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    source, target = untidy_folder(tmp_path / "in"), str(tmp_path / "out")
    first = None
    for _ in range(2):  # the second run replaces the first
        rejects = {r["table_name"]: r["rejected_count"] for r in commerce.run_batch(spark, source, target).collect()}
        assert rejects["orders"] >= 6 and rejects["order_items"] >= 8 and rejects["customers"] == 0
        summary = rows(spark.read.csv(f"{target}/summary_category_revenue_share", header=True))
        assert first in (None, summary)
        first = summary
    enriched = spark.read.parquet(f"{target}/enriched")
    assert {"order_year", "order_month"} <= set(enriched.columns)
    rank = spark.read.csv(f"{target}/summary_customer_spend_rank", header=True, inferSchema=True)
    share = spark.read.csv(f"{target}/summary_category_revenue_share", header=True, inferSchema=True)
    total = enriched.agg(F.sum("net_amount")).first()[0]
    assert rank.agg(F.sum("total_spent")).first()[0] == pytest.approx(total)
    assert share.agg(F.sum("total_revenue"), F.sum("revenue_share")).first() == pytest.approx((total, 1.0))
    for country in {r["country"] for r in rank.collect()}:
        mine = sorted((r for r in rank.collect() if r["country"] == country), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        spent = [r["total_spent"] for r in mine if r["total_spent"] is not None]
        assert spent == sorted(spent, reverse=True)
        assert all(r["total_spent"] is None for r in mine[len(spent):])
    returned = spark.read.parquet(f"{target}/returns_enriched")
    orders = returned.select("order_id").distinct().count()
    for name in ("category", "tier"):
        counts = spark.read.csv(f"{target}/summary_return_by_{name}", header=True, inferSchema=True)
        assert counts.agg(F.sum("total_returns")).first()[0] == orders
    top = spark.read.csv(f"{target}/summary_top_refund_customers", header=True, inferSchema=True).collect()
    assert len(top) == 10
    assert (tmp_path / "out" / "rejected" / "rejected_orders").exists()
    assert read_csv(spark, f"{target}/rejected/rejected_orders", COMMERCE["orders"]).count() == rejects["orders"]
    assert not (tmp_path / "out" / "rejected" / "rejected_customers").exists()


def test_passes_change_no_result_and_leave_no_intermediate_tables(spark, rows, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    source = untidy_folder(tmp_path / "in")
    with open(f"{source}/order_items.csv", "a") as items, open(f"{source}/returns.csv", "a") as returns:
        items.write("I9998,,P1,toys,1,9.5\nI9999,,P1,toys,1,9.5\n")  # of no order at all
        returns.write("R9999,,2024-01-01,late,5.0\n")
    found = {}
    for per_pass in (10_000, 100):  # one pass, and six
        monkeypatch.setattr(commerce, "ITEMS_PER_PASS", per_pass)
        target, before = str(tmp_path / f"out-{per_pass}"), set(children(spark, work_folder(spark)))
        commerce.run_batch(spark, source, target)
        left = {name.rpartition("-")[0] for name in set(children(spark, work_folder(spark))) - before}
        assert "csv-customers" in left and not left & {"csv-orders", "csv-order_items", "orders", "order_items"}
        found[per_pass] = [rows(spark.read.parquet(f"{target}/{name}")) for name in ("enriched", "orphaned_items", "returns_enriched")]
        found[per_pass] += [rows(spark.read.csv(f"{target}/{name}", header=True)) for name in sorted(children(spark, target)) if name.startswith("summary_")]
    assert found[100] == found[10_000] and all(found[100]) and len(found[100]) == 9
    lost = spark.read.parquet(f"{tmp_path}/out-100/orphaned_items")
    assert {"I9998", "I9999"} <= {r.item_id for r in lost.collect()}


def test_the_batch_deletes_shuffle_files_of_a_job_that_ended(spark):
    with shuffles_deleted(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) != "true"


def test_the_batch_over_the_test_tables_deletes_its_csv_files(spark, lines):
    at = dt.datetime(1997, 1, 1)
    spark.createDataFrame([(c, "n", c % 3, 1.0, "AUTO") for c in range(1, 39)], SCHEMAS["customer"]).write.parquet(f"{lines}/customer.parquet")
    spark.createDataFrame([(n, f"N{n}", 1) for n in range(3)], SCHEMAS["nation"]).write.parquet(f"{lines}/nation.parquet")
    back = [(o, 1, 1, 9, 1.0, 10.0, 0.0, 0.0, "R", "O", at) for o in range(1, 20)]
    spark.createDataFrame(back, SCHEMAS["lineitem"]).write.mode("append").parquet(f"{lines}/lineitem.parquet")
    before = set(children(spark, work_folder(spark)))
    shop = registry.Shop(spark, lines)
    assert registry.COMMERCE["batch_enriched_orders"](shop).count() > 30
    left = {name.rpartition("-")[0] for name in set(children(spark, work_folder(spark))) - before}
    assert "shop-out" in left and not any(name.startswith("shop-in") for name in left)
    assert registry.COMMERCE["batch_returns_enriched"](shop).count() > 10


@pytest.fixture
def lines(spark, tmp_path):
    """A folder with lines, parts and orders: forty orders of five lines."""
    at = dt.datetime(1997, 1, 1)
    rows = [(o, (o * 5 + n) % 30 + 1, 1, n, 2.0, 10.0, 0.0, 0.0, "N", "O", at) for o in range(1, 41) for n in range(5)]
    spark.createDataFrame(rows, SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(p, "n", "b", f"t{p % 3}", 1, 900.0) for p in range(1, 31)]
    spark.createDataFrame(parts, SCHEMAS["part"]).write.parquet(f"{tmp_path}/part.parquet")
    orders = [(o, o, "F", 100.0, at, "1") for o in range(1, 39)]
    spark.createDataFrame(orders, SCHEMAS["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_items_are_dealt_out_by_their_number(spark, lines, monkeypatch):
    monkeypatch.setattr("tidemart.session.ROWS_PER_TASK", 10)
    shop = registry.Shop(spark, lines)
    items, lost = shop.clean("order_items"), registry.COMMERCE["orphaned_items"](shop)
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" in plan and "20), REPARTITION_BY_NUM" in plan  # 200 lines
    # Sums and parts share one shuffle; copies and the join by order another.
    assert plan.count("hashpartitioning(l_partkey") == 1 and "hashpartitioning(l_orderkey" not in plan
    kept = {r.item_id: r.order_id for r in items.collect()}
    assert len(kept) == sum((o + p) % 89 != 0 for o, p in {(o, (o * 5 + n) % 30 + 1) for o in range(1, 41) for n in range(5)})
    assert {r.order_id for r in lost.collect()} == {"O39", "O40"}


def test_the_batch_shuffles_into_partitions_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr("tidemart.session.ROWS_PER_TASK", 10)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffles_of(spark, 95):
        assert spark.conf.get(key) == "10"
    with shuffles_of(spark, 5):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before


def test_order_rows_are_sorted_after_their_shuffle_only(spark):
    shape = "order_id STRING, item_id STRING, customer_id STRING, country STRING, customer_tier STRING, category STRING, net_amount DOUBLE"
    data = [("o1", "i2", "c", "x", "t", "late", 5.0), ("o1", "i1", "c", "x", "t", "first", 5.0), ("o2", None, "c", "x", "t", None, 1.0)]
    once = commerce.per_order(spark.createDataFrame(data, shape))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("SortAggregate") < plan.index("Exchange")  # from the result down: sorted after the only shuffle
    assert sorted((r.order_id, r.category) for r in once.collect()) == [("o1", "first"), ("o2", None)]
