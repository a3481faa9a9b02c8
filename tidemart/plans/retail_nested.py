"""Questions 51-70: subqueries and chained intermediate results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import in_year, mean_day
from tidemart.operators.joins import not_in
from tidemart.plans.retail import (
    Retail, amount, per_attribute, per_customer, per_product, quantity, question, sale_count,
)
from tidemart.session import pin


def _sales_of_customers(r: Retail, condition: Column, *names: str) -> DataFrame:
    """Customer columns beside the amount of each sale that meets ``condition``."""
    kept = r.sales.filter(condition).select("customer_id", "total_amount")
    return r.customers.select("customer_id", *names).join(kept, "customer_id")


def mean_sale(r: Retail) -> Column:
    return r.product_sales.agg(F.avg("total_amount")).scalar()


@question("q051")
def sales_above_mean_sale(r: Retail) -> DataFrame:
    return _sales_of_customers(r, F.col("total_amount") > mean_sale(r), "first_name")


@question("q051_intent")
def customers_above_mean_spend(r: Retail) -> DataFrame:
    spend = per_customer(r, r.customer_lines, ("first_name",), total_spent=amount())
    return spend.filter(F.col("total_spent") > spend.agg(F.avg("total_spent")).scalar())


@question("q052")
def products_above_mean_price(r: Retail) -> DataFrame:
    return r.products.select("product_id", "product_name", "price").filter(
        F.col("price") > r.products.agg(F.avg("price")).scalar()
    )


@question("q053")
def customers_without_sale(r: Retail, year: int | None = None) -> DataFrame:
    """Never bought; with ``year``, did not buy in that year."""
    sales = r.lines if year is None else r.lines.filter(in_year("sale_date", year))
    return not_in(r.customers.select("customer_id", "first_name"), "customer_id", sales)


@question("q054")
def products_without_sale(r: Retail, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Never sold; with ``since`` and ``until``, not sold between those days."""
    sales = r.product_lines if since is None else r.lines.filter(F.col("sale_date").between(since, until))
    return not_in(r.products.select("product_id", "product_name"), "product_id", sales)


@question("q055")
def largest_sale(r: Retail) -> DataFrame:
    return _sales_of_customers(r, F.col("total_amount") == r.product_sales.agg(F.max("total_amount")).scalar(), "first_name")


@question("q056")
def product_sales_above_mean_sale(r: Retail) -> DataFrame:
    kept = r.product_sales.filter(F.col("total_amount") > mean_sale(r)).select("product_id", "total_amount")
    return r.products.select("product_id", "product_name").join(kept, "product_id")


@question("q056_intent")
def products_above_mean_total(r: Retail) -> DataFrame:
    totals = per_product(r, r.product_lines, ("product_name",), total_amount=amount())
    return totals.filter(F.col("total_amount") > totals.agg(F.avg("total_amount")).scalar())


@question("q057")
def registered_before_mean(r: Retail) -> DataFrame:
    mean = r.customers.agg(mean_day("registration_date")).scalar()
    return r.customers.select("customer_id", "first_name", "registration_date").filter(
        F.unix_date("registration_date") < mean
    )


@question("q058")
def products_above_category_mean(r: Retail) -> DataFrame:
    means = pin(r.products.groupBy("category").agg(F.avg("price").alias("_mean")))
    return r.products.join(means, "category").filter(F.col("price") > F.col("_mean")).select(
        "product_id", "product_name", "category", "price"
    )


@question("q059")
def sales_above_customers_sale(r: Retail, customer_id: int = 10) -> DataFrame:
    """Sales above the sale of one customer; of several, the lowest sale id."""
    theirs = r.sales.filter(F.col("customer_id") == customer_id).orderBy("sale_id").limit(1)
    return _sales_of_customers(r, F.col("total_amount") > theirs.select("total_amount").scalar(), "first_name")


@question("q059_intent")
def customers_above_customer(r: Retail, customer_id: int = 10) -> DataFrame:
    theirs = r.customer_lines.filter(F.col("customer_id") == customer_id).agg(amount()).scalar()
    spend = per_customer(r, r.customer_lines, ("first_name",), total_spent=amount())
    return spend.filter(F.col("total_spent") > theirs)


@question("q060")
def product_sales_above_mean_quantity(r: Retail) -> DataFrame:
    mean = r.product_sales.agg(F.avg("quantity_sold")).scalar()
    kept = r.product_sales.filter(F.col("quantity_sold") > mean).select("product_id", "quantity_sold")
    return r.products.select("product_id", "product_name").join(kept, "product_id")


@question("q060_intent")
def products_above_mean_quantity(r: Retail) -> DataFrame:
    totals = per_product(r, r.product_lines, ("product_name",), quantity_sold=quantity())
    return totals.filter(F.col("quantity_sold") > totals.agg(F.avg("quantity_sold")).scalar())


@question("q061")
def top_spenders(r: Retail, k: int = 5) -> DataFrame:
    return (
        per_customer(r, r.customer_lines, ("first_name",), total_spent=amount())
        .orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")
        .limit(k)
    )


@question("q062")
def most_sold_products(r: Retail, k: int = 3) -> DataFrame:
    return (
        per_product(r, r.product_lines, ("product_name",), total_quantity=quantity())
        .orderBy(F.col("total_quantity").desc_nulls_last(), "product_id")
        .limit(k)
    )


@question("q063")
def top_category(r: Retail) -> DataFrame:
    return (
        per_attribute(r, r.product_lines, ("category",), total_revenue=amount())
        .orderBy(F.col("total_revenue").desc_nulls_last(), "category")
        .limit(1)
    )


@question("q064", "q064_intent")
def repeat_customers(r: Retail, above: int = 1) -> DataFrame:
    return per_customer(r, r.sales, ("first_name",), purchase_count=sale_count()).filter(F.col("purchase_count") > above)


@question("q065")
def products_above_mean_sale_quantity(r: Retail) -> DataFrame:
    mean = r.product_sales.agg(F.avg("quantity_sold")).scalar()
    return per_product(r, r.product_lines, (), total_quantity_sold=quantity()).filter(
        F.col("total_quantity_sold") > mean
    )


@question("q065_intent")
def products_above_mean_total_quantity(r: Retail) -> DataFrame:
    totals = per_product(r, r.product_lines, (), total_quantity_sold=quantity())
    return totals.filter(F.col("total_quantity_sold") > totals.agg(F.avg("total_quantity_sold")).scalar())


@question("q066")
def spenders_above_mean(r: Retail) -> DataFrame:
    spend = per_customer(r, r.customer_lines, ("first_name", "last_name"), total_spent=amount())
    return spend.filter(F.col("total_spent") > spend.agg(F.avg("total_spent")).scalar())


@question("q067")
def product_names_by_revenue(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_lines, ("product_name",), total_revenue=amount()).orderBy(
        F.col("total_revenue").desc_nulls_last(), "product_name"
    )


@question("q068")
def best_month(r: Retail) -> DataFrame:
    return (
        r.customer_lines.groupBy(F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month"))
        .agg(amount().alias("monthly_revenue"))
        .orderBy(F.col("monthly_revenue").desc_nulls_last(), "sale_year", "sale_month")
        .limit(1)
    )


@question("q069")
def widely_bought_products(r: Retail, above: int = 3) -> DataFrame:
    return per_product(
        r, r.lines, ("product_name",), unique_customers=F.count_distinct("customer_id")
    ).filter(F.col("unique_customers") > above)


@question("q070")
def products_below_mean_quantity(r: Retail) -> DataFrame:
    totals = per_product(r, r.product_lines, ("product_name",), total_quantity=quantity())
    return totals.filter(F.col("total_quantity") < totals.agg(F.avg("total_quantity")).scalar())
