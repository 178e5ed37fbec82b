"""Order revenue: items reduced to their order, then joined to grouped orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import line_revenue


def order_item_totals(items: DataFrame) -> DataFrame:
    """Per order: revenue, freight and number of distinct products."""
    return items.groupBy("order_id").agg(
        F.sum(line_revenue()).cast("decimal(28,2)").alias("gross_revenue"),
        F.sum("freight_value").cast("decimal(28,2)").alias("total_freight"),
        F.countDistinct("product_id").alias("distinct_products"),
    )


def order_revenue(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.sum(line_revenue()).cast("decimal(28,2)").alias("order_revenue")
    )


def orders_and_revenue(orders: DataFrame, items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group: total_orders (distinct order_id), gross_revenue and priced_orders.

    `orders` needs order_id and the group columns.  Both sides are reduced to one row
    per order before they meet: items to their revenue, orders to (order_id, group)
    with the number of copies.  So the join is one to few whatever share of the rows
    an order holds, distinct orders are a plain count afterwards, and revenue counts
    once per copy, as a join of the raw rows would.  priced_orders counts the order
    rows that have revenue, the denominator of the mean order value.
    """
    copies = orders.groupBy("order_id", *by).agg(F.count(F.lit(1)).alias("copies"))
    priced = copies.join(order_revenue(items), "order_id", "left")
    return priced.groupBy(*by).agg(
        F.count("order_id").alias("total_orders"),
        F.sum(F.col("order_revenue") * F.col("copies")).alias("gross_revenue"),
        F.coalesce(
            F.sum(F.when(F.col("order_revenue").isNotNull(), F.col("copies"))), F.lit(0)
        ).alias("priced_orders"),
    )
