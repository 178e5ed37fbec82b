"""The two daily marts.

They disagree on purpose: one counts staged orders with fractional delivery days and
rows as the base of the return rate, the other counts raw orders with calendar days
and distinct orders as the base.

Each mart has two halves that meet on the day.  Customers are the only distinct count
of the first half, so Spark does not multiply rows for several distinct groups; orders
and revenue are counted in the second half, which is already reduced per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import day_start, micros_between
from tillstream.functions.money import exact_mean, mean_of, percentage
from tillstream.operators.revenue import orders_and_revenue
from tillstream.plans.staging import MICROS_PER_DAY


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _on_day(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join two frames with one row per day; the NULL day is a day, too."""
    right = right.withColumnRenamed("order_date", "_day")
    return left.join(right, F.col("order_date").eqNullSafe(F.col("_day")), "left").drop("_day")


def mart_order_metrics(stg: DataFrame, items: DataFrame) -> DataFrame:
    """Daily KPIs over staged orders, newest day first, NULL day before all."""
    dated = stg.withColumn("order_date", day_start(F.col("purchased_at")))
    spent = micros_between(F.col("purchased_at"), F.col("delivered_at"))
    returned = F.col("order_status") == "returned"
    visits = dated.groupBy("order_date").agg(
        F.countDistinct("customer_id").alias("unique_customers"),
        exact_mean(
            F.sum(spent.cast("decimal(20,0)")),
            F.count(spent) * F.lit(MICROS_PER_DAY).cast("decimal(12,0)"),
            1,
            "decimal(26,0)",
        ).cast("decimal(9,1)").alias("avg_delivery_days"),
        _count_where(F.col("is_late")).alias("late_orders"),
        _count_where(returned).alias("returned_orders"),
        percentage(_count_where(returned), F.count(F.lit(1))).cast("decimal(18,2)").alias(
            "return_rate_pct"
        ),
    )
    sales = orders_and_revenue(dated.select("order_id", "order_date"), items, ["order_date"])
    return (
        _on_day(visits, sales)
        .select(
            "order_date",
            "total_orders",
            "unique_customers",
            "gross_revenue",
            exact_mean(F.col("gross_revenue"), F.col("priced_orders"), 2)
            .cast("decimal(18,2)")
            .alias("avg_order_value"),
            "avg_delivery_days",
            "late_orders",
            "returned_orders",
            "return_rate_pct",
        )
        .orderBy(F.desc_nulls_first("order_date"))
    )


def days_without_items(mart: DataFrame, stg: DataFrame, items: DataFrame) -> DataFrame:
    """The days of mart_order_metrics that have no revenue because none of their orders has
    an item; a day whose items lack a price or a quantity is not among them."""
    bare = mart.where(F.col("gross_revenue").isNull()).select("order_date")
    dated = stg.select("order_id", day_start(F.col("purchased_at")).alias("_day"))
    orders = dated.join(bare, F.col("_day").eqNullSafe(F.col("order_date")), "left_semi")
    sold = orders.join(items.select("order_id").distinct(), "order_id", "left_semi").select("_day").distinct()
    return bare.join(sold, F.col("order_date").eqNullSafe(F.col("_day")), "left_anti")


def spark_order_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Daily KPIs over raw orders, newest day first, NULL day last."""
    dated = orders.withColumn("_order_day", F.to_date("order_purchase_ts")).drop("order_date")
    dated = dated.withColumnRenamed("_order_day", "order_date")
    days = F.datediff("order_delivered_ts", "order_purchase_ts")
    visits = dated.groupBy("order_date").agg(
        F.countDistinct("customer_id").alias("unique_customers"),
        mean_of(days, 1).cast("decimal(9,1)").alias("avg_delivery_days"),
        _count_where(F.col("order_status") == "returned").alias("returned_orders"),
    )
    sales = orders_and_revenue(dated.select("order_id", "order_date"), items, ["order_date"])
    return (
        _on_day(visits, sales)
        .select(
            "order_date",
            "total_orders",
            "unique_customers",
            "gross_revenue",
            exact_mean(F.col("gross_revenue"), F.col("priced_orders"), 2)
            .cast("decimal(18,2)")
            .alias("avg_order_value"),
            "avg_delivery_days",
            "returned_orders",
            percentage(F.col("returned_orders"), F.col("total_orders"))
            .cast("decimal(18,2)")
            .alias("return_rate_pct"),
        )
        .orderBy(F.desc_nulls_last("order_date"))
    )
