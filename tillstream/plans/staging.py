"""Staging: cleaned orders, recomputed on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import micros_between

MICROS_PER_DAY = 86_400_000_000


def stg_orders(orders: DataFrame) -> DataFrame:
    """Orders that have both keys, with delivery time and lateness.

    A delivery during the estimated day is late already, because the date stands for
    its midnight.  An order that is not delivered is not late.
    """
    delivered = F.col("order_delivered_ts")
    spent = micros_between(F.col("order_purchase_ts"), delivered)
    late = delivered > F.col("order_estimated_delivery_date").cast("timestamp_ntz")
    return orders.where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_ts").alias("purchased_at"),
        F.col("order_approved_ts").alias("approved_at"),
        delivered.alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_date"),
        (spent / F.lit(float(MICROS_PER_DAY))).alias("delivery_days"),
        F.when(late, True).otherwise(False).alias("is_late"),
        "created_at",
    )


def publish_view(df: DataFrame, name: str = "stg_orders") -> None:
    df.createOrReplaceTempView(name)
