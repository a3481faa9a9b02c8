import pytest

from tidemart.operators.quality import (
    RULES, Rule, clean, key_violations, lower_names, orphans, reference_violations, reject_counts, split_on_key, too_long,
)
from tidemart.schemas import RETAIL_REFERENCES


def test_split_on_key(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k STRING, v INT")
    kept, rejected = split_on_key(df, "k")
    assert rows(kept) == [("a", 1)] and rows(rejected) == [(None, 2)]


def test_clean_orders(spark):
    data = [
        ("o1", "c1", "2024-02-03", -5.0),
        ("o1", "c1", "2024-02-03", -5.0),   # an exact copy goes
        ("o1", "c1", "03/02/2024", -5.0),   # equal only once the date is read: stays
        ("o2", "c1", "31/31/2024", None),   # unreadable date, missing amount
        ("o3", None, "2024-02-03", 1.0),    # no customer
        ("o4", "c2", None, 0.0),
    ]
    df = spark.createDataFrame(data, "order_id STRING, customer_id STRING, order_date STRING, total_amount DOUBLE")
    got = sorted((r["order_id"], str(r["order_date"]), r["negative_amount_flag"]) for r in clean(df, RULES["orders"]).collect())
    assert got == [
        ("o1", "2024-02-03", True), ("o1", "2024-02-03", True), ("o2", "None", False), ("o4", "None", False)
    ]


def test_clean_customers_lowers_tier(spark, rows):
    df = spark.createDataFrame([("c1", "GOLD", "01/12/2023"), ("c2", "Gold", "x")], "customer_id STRING, customer_tier STRING, signup_date STRING")
    assert [(r[0], r[1], str(r[2])) for r in rows(clean(df, RULES["customers"]))] == [
        ("c1", "gold", "2023-12-01"), ("c2", "gold", "None")
    ]


def test_clean_without_rule(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a INT")
    assert rows(clean(df, Rule())) == [(None,), (1,)]


def test_keys_and_references(spark, rows):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id INT")
    assert rows(key_violations(parent, ["id"])) == [(None, 1), (2, 2)]
    child = spark.createDataFrame([(1, 10), (3, 11), (None, 12)], "id INT, x INT")
    assert rows(reference_violations(child, "id", parent, "id")) == [(3, 11)]
    assert rows(orphans(child, "id", parent)) == [(None, 12), (3, 11)]
    assert ("sales", "customer_id", "customers") in RETAIL_REFERENCES


def test_too_long(spark, rows):
    df = spark.createDataFrame([("abc", "x"), (None, "xyz"), ("abcd", "xyzw")], "a STRING, b STRING")
    assert rows(too_long(df, {"a": 2, "b": 3})) == [("a", 2), ("b", 1)]


def test_reject_counts(spark, rows):
    a = spark.createDataFrame([(1,), (None,)], "k INT")
    b = spark.createDataFrame([(1,)], "k INT")
    assert rows(reject_counts({"a": (a, "k"), "b": (b, "k")})) == [("a", 2, 1), ("b", 1, 0)]


def test_lower_names(spark):
    df = spark.createDataFrame([(1, 2)], "lowerName INT, B INT")
    assert lower_names(df).columns == ["lowername", "b"]
    with pytest.raises(ValueError):
        lower_names(spark.createDataFrame([(1, 2)], ["a", "x"]).toDF("a", "A"))
