"""Commerce inputs over the star-schema test tables, as untidy as real files.

Every flaw follows from a key, so the clean answer can be stated in SQL too:
missing keys, two date spellings and unreadable dates, exact copies, negative
and missing amounts, mixed-case tiers, items and returns of unknown orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.marts import table
from tidemart.session import tasks_for


def _every(key: Column, n: int, rest: int = 0) -> Column:
    return key % n == rest


def _mixed_text(key: Column, date: Column) -> Column:
    """Mostly ISO dates, every third day-first, some unreadable."""
    return (
        F.when(_every(key, 50, 7), F.lit("soon"))
        .when(_every(key, 3), F.date_format(date, "dd/MM/yyyy"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def _with_copies(df: DataFrame, key: str, n: int) -> DataFrame:
    """Every ``n``-th row twice, in one scan."""
    times = F.when(_every(F.col(key), n), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(times)).drop("_copy", key)


def _label(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        key.alias("_key"),
        F.when(~_every(key, 101), _label("O", key)).alias("order_id"),
        F.when(~_every(key, 97), _label("C", F.col("o_custkey"))).alias("customer_id"),
        _mixed_text(key, F.col("o_orderdate")).alias("order_date"),
        F.lower("o_orderstatus").alias("status"),
        F.when(_every(key, 41), -F.col("o_totalprice")).when(~_every(key, 59), F.col("o_totalprice")).alias("total_amount"),
        (key % 20).cast("double").alias("discount_pct"),
    )
    return _with_copies(rows, "_key", 13)


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    """One item per part in an order.

    Lines are dealt out by part once: their sums and the join with the parts both stay in that partition.
    """
    lines = table(spark, folder, "lineitem")
    lines = lines.repartition(tasks_for(spark, lines.count()), "l_partkey")
    sums = lines.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").cast("int").alias("quantity"))
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )
    order, item = F.col("l_orderkey"), F.col("l_partkey")
    return sums.join(part, "l_partkey").select(
        F.when(~_every(order + item, 89), F.concat(_label("O", order), _label("-P", item))).alias("item_id"),
        F.when(_every(item, 53), _label("O_MISSING_", order)).otherwise(_label("O", order)).alias("order_id"),
        _label("P", item).alias("product_id"),
        "category",
        "quantity",
        "unit_price",
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    key, tier = F.col("c_custkey"), F.lower("c_mktsegment")
    joined = F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    rows = table(spark, folder, "customer").join(nation, "c_nationkey").select(
        key.alias("_key"),
        _label("C", key).alias("customer_id"),
        F.when(~_every(key, 43), F.concat(_label("customer", key), F.lit("@example.com"))).alias("email"),
        "country",
        F.when(_every(key, 4, 1), F.upper(tier)).when(_every(key, 4, 2), F.initcap(tier)).otherwise(tier).alias("customer_tier"),
        _mixed_text(key, joined).alias("signup_date"),
    )
    return _with_copies(rows, "_key", 11)


def raw_returns(spark: SparkSession, folder: str) -> DataFrame:
    """One return per order with returned lines."""
    back = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    refund = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    sums = back.groupBy("l_orderkey").agg(
        F.sum(refund).cast("double").alias("_refund"), F.max("l_shipdate").alias("_date")
    )
    key = F.col("l_orderkey")
    rows = sums.select(
        key.alias("_key"),
        F.when(~_every(key, 103), _label("R", key)).alias("return_id"),
        F.when(_every(key, 29), _label("O_MISSING_", key)).otherwise(_label("O", key)).alias("order_id"),
        _mixed_text(key, F.col("_date")).alias("return_date"),
        F.when(_every(key, 37), -F.col("_refund")).when(~_every(key, 31), F.col("_refund")).alias("refund_amount"),
        F.element_at(F.array(*map(F.lit, ("damaged", "late", "wrong item"))), (key % 3 + 1).cast("int")).alias("reason"),
    )
    return _with_copies(rows, "_key", 17)


RAW = {"orders": raw_orders, "order_items": raw_items, "customers": raw_customers, "returns": raw_returns}
