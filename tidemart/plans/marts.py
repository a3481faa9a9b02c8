"""Domain tables over the star-schema test tables."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



# Stated, so that opening a table reads no file footers first.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    name = F.split("c_name", "#")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.get(name, F.lit(0)).alias("first_name"),
        F.get(name, F.lit(1)).alias("last_name"),
        F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("registration_date"),
        F.lower("c_mktsegment").alias("membership_status"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_brand").alias("supplier"),
        F.col("p_size").alias("stock_quantity"),
    )


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


class StarRetail:
    """The views of ``Retail`` over the star schema, each built when first asked for.

    A sale is one part in one order: lines carry no unique key, so ``sales``
    sums the lines of a part in an order. Plain sums need not wait for that.
    They start from one row per product (``product_lines``) or per order
    (``customer_lines``), and the order table is joined only where customer or
    date is asked for. Amounts are summed as whole cents, which is exact and
    several times faster than decimals, and become decimals after.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def _table(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self._spark, self._folder)

    @cached_property
    def products(self) -> DataFrame:
        return products(self._spark, self._folder)

    @cached_property
    def inventory(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_size").alias("stock_quantity")
        )

    @cached_property
    def _raw(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity_sold"),
            F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        )

    @cached_property
    def _heads(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
        )

    def _summed(self, *keys: str) -> DataFrame:
        return self._raw.groupBy(*keys).agg(
            F.sum("quantity_sold").alias("quantity_sold"), _money(F.sum("cents")).alias("total_amount")
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self._summed("order_id", "product_id").join(self._heads, "order_id", "left").select(
            F.concat_ws("-", "order_id", "product_id").alias("sale_id"),
            "customer_id", "product_id", F.col("quantity_sold").cast("int").alias("quantity_sold"), "sale_date",
            "total_amount",
        )

    @cached_property
    def product_sales(self) -> DataFrame:
        return self._summed("order_id", "product_id").drop("order_id")

    @cached_property
    def lines(self) -> DataFrame:
        lines = self._raw.withColumn("total_amount", _money(F.col("cents"))).drop("cents")
        return lines.join(self._heads, "order_id", "left").drop("order_id")

    @cached_property
    def product_lines(self) -> DataFrame:
        return self._summed("product_id")

    @cached_property
    def customer_lines(self) -> DataFrame:
        return self._summed("order_id").join(self._heads, "order_id", "left").drop("order_id")


def retail(spark: SparkSession, folder: str) -> StarRetail:
    return StarRetail(spark, folder)
