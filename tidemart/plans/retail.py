"""The retail tables and the building blocks the questions share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Retail:
    """Customers, products, sales and inventory.

    ``sales`` holds one row per sale. The other views may be cheaper to build
    and default to it. ``product_sales`` also holds one row per sale, but
    promises only the product. The rest hold the same quantities and amounts at
    another grain, for questions that only add them up or ask whether a row
    exists:

    * ``lines``: any grain that keeps customer, product and date.
    * ``product_lines``: any grain that keeps the product.
    * ``customer_lines``: any grain that keeps customer and date.
    """

    customers: DataFrame
    products: DataFrame
    sales: DataFrame
    inventory: DataFrame
    product_sales: DataFrame | None = None
    lines: DataFrame | None = None
    product_lines: DataFrame | None = None
    customer_lines: DataFrame | None = None

    def __post_init__(self) -> None:
        for view in ("product_sales", "lines", "product_lines", "customer_lines"):
            if getattr(self, view) is None:
                object.__setattr__(self, view, self.sales)


QUESTIONS: dict[str, Callable[..., DataFrame]] = {}


def question(*names: str) -> Callable:
    """Register a function ``Retail, **parameters -> DataFrame`` under its keys."""

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        for name in names:
            QUESTIONS[name] = fn
        return fn

    return register


def quantity() -> Column:
    return F.sum("quantity_sold")


def amount() -> Column:
    return F.sum("total_amount")


def sale_count() -> Column:
    return F.count(F.lit(1))


def per_customer(r: Retail, lines: DataFrame, names: tuple[str, ...], **measures: Column) -> DataFrame:
    """Measures per buying customer: summed first, names joined after."""
    totals = lines.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *(m.alias(n) for n, m in measures.items())
    )
    return r.customers.select("customer_id", *names).join(totals, "customer_id")


def per_product(r: Retail, lines: DataFrame, attributes: tuple[str, ...], products: DataFrame | None = None,
                **measures: Column) -> DataFrame:
    """Measures per sold product: summed first, attributes joined after."""
    totals = lines.groupBy("product_id").agg(*(m.alias(n) for n, m in measures.items()))
    side = r.products if products is None else products
    return side.select("product_id", *attributes).join(totals, "product_id")


def per_attribute(r: Retail, lines: DataFrame, attributes: tuple[str, ...], products: DataFrame | None = None,
                  **measures: Column) -> DataFrame:
    """Sums per product attribute (name, category): by product, then by attribute."""
    by_product = per_product(r, lines, attributes, products, **measures)
    return by_product.groupBy(*attributes).agg(*(F.sum(n).alias(n) for n in measures))
