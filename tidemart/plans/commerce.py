"""The commerce batch job: clean, enrich, summarise, write."""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.operators.ordered import numbered
from tidemart.operators.quality import RULES, clean, orphans
from tidemart.session import SMALLEST, pin, shuffles_deleted, shuffles_of, unpin
from tidemart.sinks.files import write_partitioned, write_rejects, write_summaries, write_table
from tidemart.sources.csv_tables import Intake, read_commerce_folder


def exact_sum(column: str) -> Column:
    """Sum of a double amount as decimal, whatever order the rows arrive in."""
    return F.sum(F.col(column).cast("decimal(22,6)"))


def money_sum(column: str) -> Column:
    return exact_sum(column).cast("double")


def clean_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean(df, RULES[name]) for name, df in tables.items()}


def net_amount() -> Column:
    return F.col("total_amount") * (1 - F.col("discount_pct") / 100)


def known_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers, with their net amount and month."""
    return orders.join(customers, "customer_id").withColumns(
        {"net_amount": net_amount(), "order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )


def enrich(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders of known customers with their items, if any.

    An order's amounts repeat on each of its items.
    """
    return known_orders(orders, customers).join(items, "order_id", "left")


def spend_rank(enriched: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Customers numbered by net spending inside their country, nothing spent last."""
    spend = enriched.groupBy("customer_id", "country").agg(money_sum("net_amount").alias("total_spent"))
    return _numbered_by_spend(spend, rows_per_slice)


def spend_rank_by_counts(known: DataFrame, items: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """``spend_rank`` of enriched orders without joining the items: an order counts once per item, or once."""
    counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"))
    times = F.greatest(F.coalesce("_items", F.lit(0)), F.lit(1))
    each = known.join(counts, "order_id", "left").withColumn("_net", F.col("net_amount").cast("decimal(22,6)") * times)
    spend = each.groupBy("customer_id", "country").agg(F.sum("_net").cast("double").alias("total_spent"))
    return _numbered_by_spend(spend, rows_per_slice)


def _numbered_by_spend(spend: DataFrame, rows_per_slice: int | None) -> DataFrame:
    return numbered(spend, by=-F.col("total_spent"), tie="customer_id", within=["country"], out="rank",
                    rows_per_slice=rows_per_slice)


def daily_orders(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("customer_id", "order_date").agg(F.count_distinct("order_id").alias("daily_orders"))


def rolling_orders(enriched: DataFrame, by_calendar: bool = False) -> DataFrame:
    """Orders per customer and day, and over the last seven.

    The seven are the customer's last seven days with an order;
    ``by_calendar`` takes the last seven calendar days instead. A customer has
    one row per day here, so the calendar bounds a window group however many
    orders there are.
    """
    each = Window.partitionBy("customer_id")
    if by_calendar:
        frame = each.orderBy(F.unix_date("order_date")).rangeBetween(-6, 0)
    else:
        frame = each.orderBy("order_date").rowsBetween(-6, 0)
    return daily_orders(enriched).withColumn("rolling_7d_orders", F.sum("daily_orders").over(frame))


def revenue_share(enriched: DataFrame) -> DataFrame:
    """Net revenue per category and its part of the whole."""
    revenue = pin(enriched.groupBy("category").agg(exact_sum("net_amount").alias("_exact")))
    whole = revenue.agg(F.sum("_exact").cast("double")).scalar()
    total = F.col("_exact").cast("double")
    return revenue.select(
        "category", total.alias("total_revenue"), F.try_divide(total, whole).alias("revenue_share")
    )


def per_order(enriched: DataFrame) -> DataFrame:
    """One row per order, with the category of its lowest item."""
    carried = ["item_id", "customer_id", "country", "customer_tier", "category", "net_amount"]
    # The least struct is found by sorting. Rows are dealt out first, so that the sort takes a share of a
    # shuffle and not what a split of a compressed file unpacks to.
    dealt = enriched.select("order_id", *carried).repartition("order_id")
    first = dealt.groupBy("order_id").agg(F.min(F.struct(*carried)).alias("_first"))
    return first.select("order_id", *(F.col(f"_first.{c}") for c in carried[1:]))


def order_rows(known: DataFrame, items: DataFrame) -> DataFrame:
    """``per_order`` of enriched orders, items reduced before they are joined.

    Spark leaves the items out where only columns of the customer are used.
    """
    lowest = items.groupBy("order_id").agg(F.min(F.struct("item_id", "category"))["category"].alias("category"))
    carried = ["customer_id", "country", "customer_tier", "net_amount"]
    first = known.groupBy("order_id").agg(F.min(F.struct(*carried)).alias("_first"))
    orders = first.select("order_id", *(F.col(f"_first.{c}") for c in carried))
    return orders.join(lowest, "order_id", "left").select("order_id", *carried[:3], "category", "net_amount")


def enrich_returns(returns: DataFrame, order_rows: DataFrame) -> DataFrame:
    """Returns with their order; ``refund_exceeds_order`` is null if a side is."""
    return returns.join(order_rows, "order_id", "left").withColumn(
        "refund_exceeds_order", F.col("refund_amount") > F.col("net_amount")
    )


def returns_by(returns: DataFrame, column: str) -> DataFrame:
    """Returned orders per value of ``column``; unknown orders count under null."""
    return returns.groupBy(column).agg(F.count_distinct("order_id").alias("total_returns"))


def return_rate_by(returns: DataFrame, order_rows: DataFrame, column: str) -> DataFrame:
    """Orders, returned orders and their ratio per value of ``column``."""
    ordered = order_rows.groupBy(column).agg(F.count_distinct("order_id").alias("total_orders"))
    back = returns_by(returns, column).withColumnRenamed(column, "_value")
    return ordered.join(back, ordered[column].eqNullSafe(back["_value"]), "left").select(
        column,
        "total_orders",
        F.coalesce("total_returns", F.lit(0)).alias("total_returns"),
        F.try_divide(F.coalesce("total_returns", F.lit(0)), F.col("total_orders")).alias("return_rate"),
    )


def top_refunds(returns: DataFrame, k: int = 10) -> DataFrame:
    """Customers with the largest refunds; returns of unknown orders compete as one."""
    return (
        returns.groupBy("customer_id").agg(money_sum("refund_amount").alias("total_refund"))
        .orderBy(F.desc_nulls_last("total_refund"), F.asc_nulls_first("customer_id"))
        .limit(k)
    )


# Summaries whose size a category list, a tier list or k bounds.
SMALL = frozenset({"category_revenue_share", "return_by_category", "return_by_tier", "top_refund_customers"})


class Summaries(NamedTuple):
    """The six summary tables, named as they are written."""

    customer_spend_rank: DataFrame
    rolling_order_count: DataFrame
    category_revenue_share: DataFrame
    return_by_category: DataFrame
    return_by_tier: DataFrame
    top_refund_customers: DataFrame


def summarise(enriched: DataFrame, returns: DataFrame) -> Summaries:
    """Summaries from enriched orders and enriched returns."""
    return Summaries(
        spend_rank(enriched),
        rolling_orders(enriched),
        revenue_share(enriched),
        returns_by(returns, "category"),
        returns_by(returns, "customer_tier"),
        top_refunds(returns),
    )


#: Items that are joined at a time, on average: what a pass shuffles does not grow with the tables.
ITEMS_PER_PASS = 25_000_000


def run_batch(spark: SparkSession, data_dir: str, output_dir: str) -> DataFrame:
    """The whole job from CSV folder to output folder; returns the reject counts.

    Each CSV file is parsed once, by the pass that writes it as Parquet and
    counts its rows and rejects; ``run_intake`` does the rest.
    """
    return run_intake(read_commerce_folder(spark, data_dir), output_dir)


def run_intake(intake: Intake, output_dir: str) -> DataFrame:
    """The job from landed tables to output folder; returns the reject counts.

    Orders are cleaned once, enriched orders and returns written once, and
    every summary reads those back, so the joins run one time and each summary
    scans only its columns. Rejected orders and items are written where their
    counts are above zero. Shuffles have as many partitions as the counted rows
    need, so a task sorts and hashes in memory.

    For the disk, orders are joined to their items and returns in passes by a
    hash of the order, a job's shuffle files go when it ends, and landed orders
    and items as soon as nothing needs them: the intake is used up.
    """
    spark, rows = intake.spark, sum(table.row_count for table in intake.tables.values())
    with shuffles_of(spark, rows), shuffles_deleted(spark):
        _write_batch(spark, intake, output_dir)
    return intake.rejects()


def _write_batch(spark: SparkSession, intake: Intake, output_dir: str) -> None:
    written = ("orders", "order_items")
    write_rejects({f"rejected_{n}": df for n, df in intake.rejected.items() if n in written}, output_dir)
    tables = clean_tables(intake.kept)
    tables["orders"] = pin(tables["orders"], "orders", SMALLEST)  # feeds two outputs
    intake.tables["orders"].drop()

    passes = max(1, math.ceil(intake.tables["order_items"].row_count / ITEMS_PER_PASS))

    def part(df: DataFrame, number: int) -> DataFrame:
        """What belongs to a pass; rows without an order do too."""
        return df.filter(F.pmod(F.xxhash64("order_id"), F.lit(passes)) == number) if passes > 1 else df

    def path(name: str) -> str:
        return f"{output_dir}/{name}"

    for number in range(passes):
        mode = "append" if number else "overwrite"
        # Copies of an item have its order: the shuffle that brings them together serves the join too.
        dealt = part(intake.kept["order_items"], number).repartition("order_id")
        items, orders = clean(dealt, RULES["order_items"]), part(tables["orders"], number)
        enriched = enrich(orders, tables["customers"], items)
        write_partitioned(enriched, path("enriched"), "order_year", "order_month", mode=mode, codec=SMALLEST)
        write_table(orphans(items, "order_id", orders), path("orphaned_items"), mode, SMALLEST)
    unpin(tables["orders"])
    intake.tables["order_items"].drop()

    enriched = spark.read.schema(enriched.schema).parquet(path("enriched"))
    for number in range(passes):
        returns = enrich_returns(part(tables["returns"], number), per_order(part(enriched, number)))
        write_table(returns, path("returns_enriched"), "append" if number else "overwrite", SMALLEST)
    returns = spark.read.schema(returns.schema).parquet(path("returns_enriched"))

    write_summaries(summarise(enriched, returns)._asdict(), output_dir, SMALL)


def main(argv: list[str] | None = None) -> None:
    import argparse

    from tidemart.session import build_session, clear_work

    parser = argparse.ArgumentParser(description="Commerce batch job: CSV folder to Parquet and summaries.")
    parser.add_argument("--data_dir", default="data")
    parser.add_argument("--output_dir", default="output")
    args = parser.parse_args(argv)
    spark = build_session("commerce")
    run_batch(spark, args.data_dir, args.output_dir).filter("rejected_count > 0").show()
    clear_work(spark)


if __name__ == "__main__":
    main()
