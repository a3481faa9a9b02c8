"""Questions 71-100: rankings, running totals, neighbours, shares, division."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import share_pct
from tidemart.operators.joins import exists_in
from tidemart.operators.ordered import neighbour, ranked, strictly_before, tiles, top_ranks
from tidemart.plans.retail import (
    Retail, amount, per_attribute, per_customer, per_product, quantity, question, sale_count,
)
from tidemart.plans.retail_basic import early_sales
from tidemart.plans.retail_nested import mean_sale
from tidemart.session import pin


def _customer_amounts(r: Retail) -> DataFrame:
    """Distinct (customer, sale amount)."""
    amounts = r.sales.select("customer_id", "total_amount").distinct()
    return r.customers.select("customer_id", "first_name").join(amounts, "customer_id")


def _customer_spend(r: Retail, *names: str) -> DataFrame:
    return per_customer(r, r.customer_lines, ("first_name", *names), total_spent=amount())


@question("q071")
def customers_ranked_by_sale(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    return ranked(_customer_amounts(r), by=-F.col("total_amount"), tie="customer_id", out="customer_rank",
                  rows_per_slice=rows_per_slice)


@question("q071_intent")
def customers_ranked_by_spend(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    return ranked(_customer_spend(r), by=-F.col("total_spent"), tie="customer_id", out="customer_rank",
                  rows_per_slice=rows_per_slice)


@question("q072")
def products_ranked_by_sale_quantity(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    quantities = r.product_sales.select("product_id", "quantity_sold").distinct()
    rows = r.products.select("product_id", "product_name").join(quantities, "product_id")
    return ranked(rows, by=-F.col("quantity_sold"), tie="product_id", out="rank_quantity_sold",
                  rows_per_slice=rows_per_slice)


@question("q072_intent")
def products_ranked_by_quantity(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    rows = per_product(r, r.product_lines, ("product_name",), total_quantity=quantity())
    return ranked(rows, by=-F.col("total_quantity"), tie="product_id", out="rank_quantity_sold",
                  rows_per_slice=rows_per_slice)


@question("q073")
def customers_at_rank_by_sale(r: Retail, rank: int = 3) -> DataFrame:
    return top_ranks(_customer_amounts(r), by="total_amount", lowest=rank, highest=rank, out="customer_rank")


@question("q073_intent")
def customers_at_rank_by_spend(r: Retail, rank: int = 3) -> DataFrame:
    return top_ranks(_customer_spend(r), by="total_spent", lowest=rank, highest=rank, out="customer_rank")


@question("q074")
def products_at_price_rank(r: Retail, rank: int = 2) -> DataFrame:
    rows = r.products.select("product_id", "product_name", "price")
    return top_ranks(rows, by="price", lowest=rank, highest=rank, out="price_rank")


@question("q075")
def products_ranked_in_category(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    rows = r.products.select("product_id", "product_name", "category", "price")
    return ranked(rows, by=-F.col("price"), tie="product_id", within=["category"], out="price_category_rank",
                  rows_per_slice=rows_per_slice)


@question("q076")
def customers_ranked_by_purchases(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    rows = per_customer(r, r.sales, ("first_name",), purchase_count=sale_count())
    return ranked(rows, by=-F.col("purchase_count"), tie="customer_id", out="purchase_rank",
                  rows_per_slice=rows_per_slice)


def _running_by_date(r: Retail, newest_first: bool) -> DataFrame:
    """Running total over dates, given to each sale of the date.

    Sales of one date are peers, so the total depends on the date alone: amounts
    are summed per date first, and the one-task window sees one row per date.
    The calendar bounds that table, so Spark broadcasts it by its size.
    """
    daily = r.customer_lines.groupBy("sale_date").agg(amount().alias("_day"))
    order = F.col("sale_date").desc_nulls_first() if newest_first else F.col("sale_date").asc_nulls_last()
    totals = daily.select(
        F.col("sale_date").alias("_date"), F.sum("_day").over(Window.orderBy(order)).alias("running_total")
    )
    sales = r.sales.select("sale_id", "sale_date")
    return sales.join(totals, sales["sale_date"].eqNullSafe(totals["_date"]), "left").drop("_date")


@question("q077")
def running_total_newest_first(r: Retail) -> DataFrame:
    return _running_by_date(r, newest_first=True)


@question("q077_intent")
def running_total(r: Retail) -> DataFrame:
    return _running_by_date(r, newest_first=False)


@question("q078")
def previous_sale_amount(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    return neighbour(r.sales.select("sale_id", "sale_date", "total_amount"), by="sale_date", tie="sale_id",
                     value="total_amount", out="previous_amount", step=-1, rows_per_slice=rows_per_slice)


@question("q079")
def next_sale_amount(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    return neighbour(r.sales.select("sale_id", "sale_date", "total_amount"), by="sale_date", tie="sale_id",
                     value="total_amount", out="next_amount", step=1, rows_per_slice=rows_per_slice)


@question("q080")
def spending_quartiles(r: Retail, groups: int = 4, rows_per_slice: int | None = None) -> DataFrame:
    return tiles(_customer_spend(r, "last_name"), by=-F.col("total_spent"), tie="customer_id", buckets=groups,
                 out="spending_group", rows_per_slice=rows_per_slice)


def _customer_categories(r: Retail) -> DataFrame:
    """Distinct (customer, category) with a known customer."""
    bought = r.lines.select("customer_id", "product_id").distinct()
    return bought.join(r.products.select("product_id", "category"), "product_id").select(
        "customer_id", "category"
    ).distinct()


@question("q081")
def customer_category_counts(r: Retail) -> DataFrame:
    """As written the category is a group key too, so no count exceeds one."""
    pairs = _customer_categories(r).join(r.customers.select("customer_id", "first_name"), "customer_id")
    counted = pairs.groupBy("customer_id", "first_name", "category").agg(
        F.count("category").alias("category_count")
    )
    return counted.filter(F.col("category_count") > 1)


@question("q081_intent")
def customers_of_several_categories(r: Retail, above: int = 1) -> DataFrame:
    counts = _customer_categories(r).groupBy("customer_id").agg(F.count("category").alias("category_count"))
    return r.customers.select("customer_id", "first_name").join(
        counts.filter(F.col("category_count") > above), "customer_id"
    )


@question("q082")
def early_purchases(r: Retail, days: int = 7) -> DataFrame:
    return early_sales(r, r.sales, days)


@question("q083")
def stock_below_mean(r: Retail) -> DataFrame:
    mean = r.inventory.agg(F.avg("stock_quantity")).scalar()
    short = r.inventory.filter(F.col("stock_quantity") < mean)
    return r.products.select("product_id", "product_name").join(short, "product_id")


@question("q084")
def repeated_products(r: Retail, above: int = 1) -> DataFrame:
    counts = r.sales.groupBy("customer_id", "product_id").agg(sale_count().alias("_n"))
    named = counts.join(r.products.select("product_id", "product_name"), "product_id")
    repeated = named.groupBy("customer_id", "product_name").agg(F.sum("_n").alias("times_purchased")).filter(
        F.col("times_purchased") > above
    )
    return r.customers.select("customer_id", "first_name", "last_name").join(repeated, "customer_id")


@question("q085")
def categories_by_revenue(r: Retail) -> DataFrame:
    return per_attribute(r, r.product_lines, ("category",), total_revenue=amount()).orderBy(
        F.col("total_revenue").desc_nulls_last(), "category"
    )


@question("q086")
def leading_product_names(r: Retail, k: int = 3) -> DataFrame:
    rows = per_attribute(r, r.product_lines, ("product_name",), total_qty_sold=quantity())
    return top_ranks(rows, by="total_qty_sold", highest=k, out="qty_rank").drop("qty_rank")


@question("q087")
def buyers_of_dearest(r: Retail) -> DataFrame:
    dearest = r.products.filter(F.col("price") == r.products.agg(F.max("price")).scalar()).select("product_id")
    bought = r.lines.join(dearest, "product_id", "left_semi")
    return exists_in(r.customers.select("customer_id", "first_name", "last_name"), "customer_id", bought)


@question("q088")
def product_names_by_customers(r: Retail) -> DataFrame:
    """Distinct buyers per name; buyers of same-named products count once."""
    bought = r.lines.select("product_id", "customer_id").distinct()
    return (
        bought.join(r.products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(F.count_distinct("customer_id").alias("unique_customers"))
        .orderBy(F.desc("unique_customers"), "product_name")
    )


@question("q089")
def distinct_sales_above_mean(r: Retail) -> DataFrame:
    kept = r.sales.filter(F.col("total_amount") > mean_sale(r)).select("customer_id", "total_amount").distinct()
    return r.customers.select("customer_id", "first_name", "last_name").join(kept, "customer_id")


@question("q090")
def customers_above_mean_quantity(r: Retail) -> DataFrame:
    per_buyer = r.customer_lines.groupBy("customer_id").agg(quantity().alias("q"))
    totals = per_customer(r, r.customer_lines, ("first_name", "last_name"), total_qty=quantity())
    return totals.filter(F.col("total_qty") > per_buyer.agg(F.avg("q")).scalar())


@question("q091")
def top_tenth_of_spenders(r: Retail, rows_per_slice: int | None = None) -> DataFrame:
    """The first of ten groups by spending."""
    placed = tiles(_customer_spend(r, "last_name"), by=-F.col("total_spent"), tie="customer_id", buckets=10,
                   out="tenth", rows_per_slice=rows_per_slice)
    return placed.filter(F.col("tenth") == 1).drop("tenth")


@question("q092")
def products_of_half_the_revenue(r: Retail, share: float = 0.5, rows_per_slice: int | None = None) -> DataFrame:
    """Names from the top down until ``share`` of revenue is passed.

    The total down to a name, its peers included, is the grand total less
    everything strictly smaller.
    """
    revenue = pin(per_attribute(r, r.product_lines, ("product_name",), total_revenue=amount()))
    grand = revenue.agg(F.sum("total_revenue")).scalar()
    smaller = strictly_before(revenue, by=F.col("total_revenue"), tie="product_name",
                              measures={"_smaller": F.col("total_revenue")}, pinned=True,
                              rows_per_slice=rows_per_slice)
    running = grand - F.col("_smaller")
    return smaller.filter(running - F.col("total_revenue") < grand * F.lit(Decimal(str(share)))).select(
        "product_name", "total_revenue"
    )


@question("q093")
def consecutive_month_buyers(r: Retail) -> DataFrame:
    """Bought in two months in a row.

    Months are numbered through, so December to January needs no case; a buyer
    has one row per month, which bounds the window however many sales there are.
    """
    number = F.year("sale_date") * 12 + F.month("sale_date")
    months = r.customer_lines.select("customer_id", number.alias("m")).distinct()
    before = F.lag("m").over(Window.partitionBy("customer_id").orderBy("m"))
    streak = months.withColumn("gap", F.col("m") - before).filter(F.col("gap") == 1)
    return exists_in(r.customers.select("customer_id", "first_name", "last_name"), "customer_id", streak)


@question("q094")
def stock_less_sold(r: Retail) -> DataFrame:
    sold = r.product_lines.groupBy("product_id").agg(quantity().alias("_sold"))
    totals = (
        r.products.select("product_id", "product_name", "stock_quantity").join(sold, "product_id", "left")
        .groupBy("product_name", "stock_quantity")
        .agg(F.coalesce(F.sum("_sold"), F.lit(0)).alias("total_sold"))
    )
    return totals.withColumn("stock_difference", F.col("stock_quantity") - F.col("total_sold")).orderBy(
        F.abs("stock_difference").desc_nulls_last(), "product_name", "stock_quantity"
    )


@question("q095")
def spenders_above_status_mean(r: Retail) -> DataFrame:
    """Spending above the mean over the buyers of the same membership status."""
    spend = pin(_customer_spend(r, "last_name", "membership_status"))
    means = pin(spend.groupBy("membership_status").agg(F.avg("total_spent").alias("tier_average")))
    return spend.join(means, "membership_status").filter(F.col("total_spent") > F.col("tier_average")).select(
        "customer_id", "first_name", "last_name", "membership_status", "total_spent", "tier_average"
    )


def _category_means(r: Retail, per_sale: bool) -> DataFrame:
    """Mean sale per category, or mean product total per category."""
    sums = per_product(r, r.product_sales, ("category",), _amount=amount(), _n=F.count("total_amount"))
    weight = F.sum("_n") if per_sale else F.count("_amount")
    mean = F.sum("_amount").cast("double") / weight
    return pin(sums.groupBy("category").agg(mean.alias("avg_category_sales")))


def _products_above(r: Retail, means: DataFrame) -> DataFrame:
    totals = per_product(r, r.product_lines, ("product_name", "category"), total_sales=amount())
    return totals.join(means, "category").filter(F.col("total_sales") > F.col("avg_category_sales")).select(
        "product_name", "category", "total_sales", "avg_category_sales"
    )


@question("q096")
def products_above_category_mean_sale(r: Retail) -> DataFrame:
    return _products_above(r, _category_means(r, per_sale=True))


@question("q096_intent")
def products_above_category_mean_total(r: Retail) -> DataFrame:
    return _products_above(r, _category_means(r, per_sale=False))


@question("q097")
def largest_share_in_one_sale(r: Retail) -> DataFrame:
    """One sale with the largest share of its customer's spending.

    Only a customer's largest sale can win, so sales shrink to one row per
    customer before names are joined.
    """
    best = r.sales.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max("total_amount").alias("single_purchase"), amount().alias("total_spent")
    )
    share = best.withColumn("pct_of_total", share_pct(F.col("single_purchase"), F.col("total_spent")))
    return (
        r.customers.select("customer_id", "first_name", "last_name")
        .join(share, "customer_id")
        .orderBy(F.col("pct_of_total").desc_nulls_last(), "customer_id")
        .limit(1)
    )


@question("q098")
def leading_names_in_category(r: Retail, k: int = 3) -> DataFrame:
    rows = per_attribute(r, r.product_lines, ("product_name", "category"), total_qty_sold=quantity())
    return top_ranks(rows, by="total_qty_sold", within=["category"], highest=k, out="qty_rank")


@question("q099")
def tied_top_spenders(r: Retail) -> DataFrame:
    return top_ranks(_customer_spend(r, "last_name"), by="total_spent", highest=1, out="_rank").drop("_rank")


@question("q100")
def products_sold_every_year(r: Retail) -> DataFrame:
    years = r.lines.select("product_id", F.year("sale_date").alias("y")).distinct()
    all_years = r.customer_lines.agg(F.count_distinct(F.year("sale_date"))).scalar()
    constant = years.groupBy("product_id").agg(F.count("y").alias("n")).filter(F.col("n") == all_years)
    return r.products.select("product_id", "product_name").join(constant, "product_id", "left_semi").select(
        "product_name"
    )
