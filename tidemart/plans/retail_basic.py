"""Questions 1-50: projections, filters, joins, aggregates, top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import full_name, in_month, in_year, within_days
from tidemart.operators.joins import exists_in, not_in
from tidemart.operators.ordered import numbered
from tidemart.plans.retail import (
    Retail, amount, per_attribute, per_customer, per_product, quantity, question, sale_count,
)
from tidemart.session import pin


@question("q001")
def all_customers(r: Retail) -> DataFrame:
    return r.customers


@question("q002")
def product_count(r: Retail) -> DataFrame:
    return r.products.agg(F.count(F.lit(1)).alias("total_products"))


@question("q003")
def products_above_price(r: Retail, floor: float = 500) -> DataFrame:
    return r.products.filter(F.col("price") > floor).select("product_name", "price")


@question("q004")
def average_price(r: Retail) -> DataFrame:
    return r.products.agg(F.avg("price").alias("average_price"))


@question("q005")
def total_sales_amount(r: Retail) -> DataFrame:
    return r.product_lines.agg(amount().alias("total_sales_amount"))


@question("q006")
def membership_statuses(r: Retail) -> DataFrame:
    return r.customers.select("membership_status").distinct()


@question("q007")
def customer_full_names(r: Retail) -> DataFrame:
    return r.customers.select(full_name("first_name", "last_name").alias("full_name"))


@question("q008")
def products_of_category(r: Retail, category: str = "Electronics") -> DataFrame:
    return r.products.filter(F.col("category") == category)


@question("q009")
def highest_price(r: Retail) -> DataFrame:
    return r.products.agg(F.max("price").alias("highest_price"))


@question("q010")
def sales_count_by_product(r: Retail) -> DataFrame:
    return r.product_sales.groupBy("product_id").agg(sale_count().alias("number_of_sales"))


@question("q011")
def quantity_by_product(r: Retail) -> DataFrame:
    return r.product_lines.groupBy("product_id").agg(quantity().alias("total_quantity_sold"))


@question("q012")
def lowest_price(r: Retail) -> DataFrame:
    return r.products.agg(F.min("price").alias("lowest_price"))


def _buyers_of(r: Retail, products: DataFrame, *names: str) -> DataFrame:
    """Customers with at least one sale of the given products, once each."""
    bought = r.lines.join(products.select("product_id"), "product_id", "left_semi")
    return exists_in(r.customers.select("customer_id", *names), "customer_id", bought)


@question("q013")
def buyers_above_price(r: Retail, floor: float = 1000) -> DataFrame:
    return _buyers_of(r, r.products.filter(F.col("price") > floor), "first_name", "last_name")


@question("q014", "q022")
def amount_by_product_name(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_lines, ("product_name",), total_sales_amount=amount())


@question("q015")
def amount_by_customer(r: Retail) -> DataFrame:
    return per_customer(r, r.customer_lines, ("first_name", "last_name"), total_spent=amount())


@question("q016")
def sales_with_names(r: Retail) -> DataFrame:
    return (
        r.sales.join(r.products.select("product_id", "product_name"), "product_id")
        .join(r.customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .select("first_name", "last_name", "product_name", "quantity_sold")
    )


@question("q017")
def same_status_pairs(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    """Customer pairs of equal status, in linear form.

    The pair list itself grows with the square of a status group. Each customer
    gets a position by id within the status; the pairs a customer leads are
    exactly the later positions of the same status, ``pair_count`` of them.
    ``pairs_led_by`` lists them for one customer.
    """
    known = r.customers.filter(F.col("membership_status").isNotNull())
    sizes = pin(known.groupBy("membership_status").agg(F.count(F.lit(1)).alias("_size")))
    placed = numbered(
        known.select("customer_id", "first_name", "membership_status"),
        by=F.col("customer_id"), tie="customer_id", within=["membership_status"], out="position",
        rows_per_slice=rows_per_slice,
    )
    return placed.join(sizes, "membership_status").select(
        F.col("customer_id").alias("customer_1_id"),
        F.col("first_name").alias("customer_1_first"),
        "membership_status",
        "position",
        (F.col("_size") - F.col("position")).alias("pair_count"),
    )


def pairs_led_by(pairs: DataFrame, customer_id: int) -> DataFrame:
    """The pairs whose first customer is ``customer_id``, from their linear form."""
    leader = pairs.filter(F.col("customer_1_id") == customer_id).limit(1)
    status = leader.select("membership_status").scalar()
    position = leader.select("position").scalar()
    first = leader.select("customer_1_first").scalar()
    return pairs.filter((F.col("membership_status") == status) & (F.col("position") > position)).select(
        F.lit(customer_id).alias("customer_1_id"),
        first.alias("customer_1_first"),
        F.col("customer_1_id").alias("customer_2_id"),
        F.col("customer_1_first").alias("customer_2_first"),
        "membership_status",
    )


@question("q018")
def sales_count_by_product_name(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_sales, ("product_name",), total_sales_count=sale_count())


@question("q019")
def low_stock_products(r: Retail, below: int = 10) -> DataFrame:
    return r.products.filter(F.col("stock_quantity") < below)


@question("q020")
def well_sold_product_names(r: Retail, above: int = 5) -> DataFrame:
    return per_attribute(r, r.product_lines, ("product_name",), total_sold=quantity()).filter(
        F.col("total_sold") > above
    )


@question("q021")
def buyers_of_categories(r: Retail, categories: tuple[str, ...] = ("Electronics", "Appliances")) -> DataFrame:
    return _buyers_of(r, r.products.filter(F.col("category").isin(*categories)), "first_name")


@question("q023")
def buyers_in_year(r: Retail, year: int = 2023) -> DataFrame:
    sold = r.sales.filter(in_year("sale_date", year)).select("customer_id")
    return r.customers.select("customer_id", "first_name").join(sold, "customer_id")


@question("q024")
def top_customer_of_year(r: Retail, year: int = 2023, name: str = "total_sales") -> DataFrame:
    return (
        per_customer(r, r.customer_lines.filter(in_year("sale_date", year)), ("first_name",), **{name: amount()})
        .orderBy(F.col(name).desc_nulls_last(), "customer_id")
        .limit(1)
    )


@question("q025")
def dearest_product_sold(r: Retail) -> DataFrame:
    return (
        exists_in(r.products.select("product_id", "product_name", "price"), "product_id", r.product_lines)
        .orderBy(F.col("price").desc_nulls_last(), "product_id")
        .limit(1)
        .select("product_name", "price")
    )


@question("q026")
def sales_above_price(r: Retail, floor: float = 500) -> DataFrame:
    priced = r.products.filter(F.col("price") > floor).select("product_id")
    sold = r.sales.groupBy("customer_id", "product_id").agg(sale_count().alias("n")).join(priced, "product_id", "left_semi")
    return sold.join(r.customers.select("customer_id"), "customer_id", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("customer_count")
    )


@question("q026_intent")
def buyer_count_above_price(r: Retail, floor: float = 500) -> DataFrame:
    return _buyers_of(r, r.products.filter(F.col("price") > floor)).agg(F.count(F.lit(1)).alias("customer_count"))


@question("q027")
def sales_by_status_members(r: Retail, status: str = "Gold") -> DataFrame:
    members = r.customers.filter(F.col("membership_status") == status).select("customer_id")
    sold = r.sales.join(members, "customer_id", "left_semi").join(r.products.select("product_id"), "product_id", "left_semi")
    return sold.agg(sale_count().alias("total_sales_gold_members"))


@question("q028")
def low_inventory(r: Retail, below: int = 10) -> DataFrame:
    short = r.inventory.filter(F.col("stock_quantity") < below)
    return r.products.select("product_id", "product_name").join(short, "product_id").select(
        "product_name", "stock_quantity"
    )


@question("q029")
def customers_above_quantity(r: Retail, above: int = 5) -> DataFrame:
    return per_customer(r, r.customer_lines, ("first_name", "last_name"), total_quantity=quantity()).filter(
        F.col("total_quantity") > above
    )


@question("q030")
def average_quantity_by_product(r: Retail) -> DataFrame:
    return r.product_sales.groupBy("product_id").agg(F.avg("quantity_sold").alias("avg_quantity_sold"))


@question("q031")
def sales_in_month(r: Retail, year: int = 2023, month: int = 12) -> DataFrame:
    return r.sales.filter(in_month("sale_date", year, month)).agg(sale_count().alias("sales_in_dec_2023"))


@question("q032")
def customer_spend_of_year(r: Retail, year: int = 2023) -> DataFrame:
    return per_customer(
        r, r.customer_lines.filter(in_year("sale_date", year)), ("first_name",), total_spent=amount()
    ).orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")


@question("q033")
def sold_and_nearly_out(r: Retail, below: int = 5) -> DataFrame:
    short = low_inventory_rows(r, below)
    return exists_in(short, "product_id", r.product_lines).select("product_name", "stock_quantity")


def low_inventory_rows(r: Retail, below: int) -> DataFrame:
    short = r.inventory.filter(F.col("stock_quantity") < below)
    return r.products.select("product_id", "product_name").join(short, "product_id")


@question("q034")
def product_names_by_amount(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_lines, ("product_name",), total_sales=amount()).orderBy(
        F.col("total_sales").desc_nulls_last(), "product_name"
    )


def early_sales(r: Retail, sales: DataFrame, days: int) -> DataFrame:
    """Sales made on the registration date or up to ``days`` days later."""
    return r.customers.select("customer_id", "first_name", "registration_date").join(
        sales.select("customer_id", "sale_date"), "customer_id"
    ).filter(within_days("sale_date", "registration_date", days))


@question("q035")
def early_buyers(r: Retail, days: int = 7) -> DataFrame:
    return early_sales(r, r.customer_lines, days).distinct()


@question("q036")
def sales_in_price_band(r: Retail, low: float = 100, high: float = 500) -> DataFrame:
    band = r.products.filter(F.col("price").between(low, high)).select("product_id", "product_name", "price")
    return r.product_sales.join(band, "product_id").select("product_name", "price", "quantity_sold", "total_amount")


@question("q037")
def most_frequent_customer(r: Retail) -> DataFrame:
    return (
        per_customer(r, r.sales, ("first_name",), purchase_count=sale_count())
        .orderBy(F.desc("purchase_count"), "customer_id")
        .limit(1)
    )


@question("q038")
def quantity_by_customer(r: Retail) -> DataFrame:
    return per_customer(r, r.customer_lines, ("first_name",), total_quantity_sold=quantity())


@question("q039")
def stock_extremes(r: Retail) -> DataFrame:
    """Products with the highest and with the lowest stock, in one result."""
    ends = r.products.select("product_id", "product_name", "stock_quantity")
    top = ends.agg(F.max("stock_quantity")).scalar()
    bottom = ends.agg(F.min("stock_quantity")).scalar()
    highest = ends.filter(F.col("stock_quantity") == top).withColumn("stock_level", F.lit("highest"))
    lowest = ends.filter(F.col("stock_quantity") == bottom).withColumn("stock_level", F.lit("lowest"))
    return highest.unionByName(lowest)


@question("q040")
def amount_by_matching_name(r: Retail, pattern: str = "%Phone%") -> DataFrame:
    named = r.products.filter(F.col("product_name").like(pattern)).select("product_id", "product_name")
    totals = r.product_lines.groupBy("product_id").agg(amount().alias("total_sales"))
    return named.join(totals, "product_id", "left").groupBy("product_name").agg(
        F.sum("total_sales").alias("total_sales")
    )


@question("q041")
def amount_by_member_and_product(r: Retail, status: str = "Gold") -> DataFrame:
    members = r.customers.filter(F.col("membership_status") == status).select(
        "customer_id", "first_name", "membership_status"
    )
    totals = r.lines.groupBy("customer_id", "product_id").agg(amount().alias("_amount"))
    return (
        totals.join(members, "customer_id")
        .join(r.products.select("product_id", "product_name"), "product_id")
        .groupBy("customer_id", "first_name", "membership_status", "product_name")
        .agg(F.sum("_amount").alias("total_sales_amount"))
        .drop("customer_id")
    )


@question("q042")
def amount_by_category(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_lines, ("category",), total_sales=amount())


@question("q043")
def amount_by_product_name_and_month(r: Retail) -> DataFrame:
    monthly = r.lines.groupBy(
        "product_id", F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month")
    ).agg(amount().alias("_amount"))
    return (
        monthly.join(r.products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name", "sale_year", "sale_month")
        .agg(F.sum("_amount").alias("total_sales"))
        .orderBy("sale_year", "sale_month", "product_name")
    )


@question("q044")
def sold_with_stock_left(r: Retail) -> DataFrame:
    stocked = r.inventory.filter(F.col("stock_quantity") > 0)
    left = exists_in(stocked, "product_id", r.product_lines)
    return left.join(r.products.select("product_id", "product_name"), "product_id").select(
        "product_name", F.col("stock_quantity").alias("remaining_stock")
    ).distinct()


@question("q045")
def top_customers(r: Retail, k: int = 5) -> DataFrame:
    return (
        per_customer(r, r.customer_lines, ("first_name",), total_purchases=amount())
        .orderBy(F.col("total_purchases").desc_nulls_last(), "customer_id")
        .limit(k)
    )


@question("q046")
def products_sold_in_year(r: Retail, year: int = 2023) -> DataFrame:
    return r.lines.filter(in_year("sale_date", year)).agg(
        F.count_distinct("product_id").alias("unique_products_sold_2023")
    )


@question("q047")
def products_without_recent_sale(r: Retail, as_of: dt.date | None = None, months: int = 6) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of)
    recent = r.lines.filter(F.col("sale_date") >= F.add_months(today, -months))
    return not_in(r.products.select("product_id", "product_name"), "product_id", recent).select("product_name")


@question("q048")
def quantity_in_price_band(r: Retail, low: float = 200, high: float = 800) -> DataFrame:
    band = r.products.filter(F.col("price").between(low, high))
    return per_attribute(r, r.product_lines, ("product_name", "price"), band, total_quantity_sold=quantity())


@question("q049")
def top_spender_of_year(r: Retail, year: int = 2023) -> DataFrame:
    return top_customer_of_year(r, year, "total_spent")


@question("q050")
def much_sold_dear_products(r: Retail, above: int = 100, floor: float = 200) -> DataFrame:
    dear = r.products.filter(F.col("price") > floor)
    return per_attribute(r, r.product_lines, ("product_name", "price"), dear, total_sold_products=quantity()).filter(
        F.col("total_sold_products") > above
    )
