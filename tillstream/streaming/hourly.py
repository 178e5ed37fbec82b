"""Hourly order metrics over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.clock import day_start, hour_start
from tillstream.functions.money import line_revenue
from tillstream.operators.distinct import NumberedKeys, bitmaps, distinct_counts
from tillstream.schemas import LONG, STRING, TIME, columns
from tillstream.sources.order_topic import accepted, decode
from tillstream.sources.tables import Lake, side_by_side
from tillstream.streaming.fresh import held, new_rows, with_new_keys
from tillstream.streaming.jobs import EachBatch

TOTALS = columns(hour=TIME, total_orders=LONG, gross_revenue=T.DecimalType(38, 2))
VISITS = columns(hour=TIME, customer_id=STRING)


def hourly_windows(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Tumbling hours of order_id, purchased_at, price and quantity, for complete mode.

    Every event counts however late; state is one row per hour.  Customers per hour and
    redelivered orders need the keys seen so far: count_hours has both.  A delay, which
    must be asked for, drops what arrives later than that, and in return drops orders
    redelivered within it, bounds the state, and allows append mode.
    """
    timed = events.withColumn("_at", F.col("purchased_at").cast("timestamp"))
    if delay:
        timed = timed.withWatermark("_at", delay).dropDuplicatesWithinWatermark(["order_id"])
    return (
        timed.groupBy(F.window("_at", "1 hour").alias("_window"))
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(line_revenue()).cast("decimal(38,2)").alias("gross_revenue"),
        )
        .select(
            F.col("_window.start").cast("timestamp_ntz").alias("hour"), "total_orders", "gross_revenue"
        )
    )


def keep_latest_result(lake: Lake, name: str) -> EachBatch:
    """For complete mode: replace the table by each micro-batch's whole result."""

    def each_batch(result: DataFrame, batch: str) -> None:
        lake.rebuild(result, "marts", name)

    return each_batch


def orders_by_hour(messages: DataFrame) -> DataFrame:
    """A stream of messages as orders with their hour, and markers of the order_ids that it
    has not carried before."""
    orders = accepted(decode(messages)).select(
        "order_id",
        "customer_id",
        hour_start(F.col("purchased_at")).alias("hour"),
        line_revenue(F.col("product.price"), F.col("quantity")).alias("revenue"),
        F.col("ts").alias("sent"),
    )
    return with_new_keys(orders, {"order": F.col("order_id")})


def count_hours(lake: Lake) -> EachBatch:
    """Exact hourly metrics of orders_by_hour for any lateness and redelivery.

    Which orders are new the stream's state says, so no earlier micro-batch is read.  Each
    micro-batch writes its new orders' totals per hour, which sum up, and their distinct
    customers per hour, which hourly_counts merges.
    """

    def each_batch(orders: DataFrame, batch: str) -> None:
        with held(orders) as kept, held(new_rows(kept, "order", "order_id", ["sent"])) as fresh:
            totals = fresh.groupBy("hour").agg(
                F.count("order_id").alias("total_orders"),
                F.sum("revenue").cast("decimal(38,2)").alias("gross_revenue"),
            )
            visits = fresh.select("hour", "customer_id").distinct()
            side_by_side(
                lake.spark,
                [
                    lambda: lake.write_batch(totals, "hourly_totals", batch, TOTALS, "staging"),
                    lambda: lake.write_batch(visits, "hourly_visits", batch, VISITS, "staging"),
                ],
            )

    return each_batch


def hourly_counts(lake: Lake) -> DataFrame:
    """The metrics of all micro-batches so far."""
    totals = (
        lake.read("hourly_totals", TOTALS, "staging")
        .groupBy("hour")
        .agg(F.sum("total_orders").alias("total_orders"), F.sum("gross_revenue").alias("gross_revenue"))
    )
    customers = (
        lake.read("hourly_visits", VISITS, "staging")
        .groupBy("hour")
        .agg(F.countDistinct("customer_id").alias("unique_customers"))
    )
    return totals.join(customers, "hour").select("hour", "total_orders", "gross_revenue", "unique_customers")


BITMAPS = columns(hour=TIME, bucket=LONG, bitmap=T.BinaryType())


def count_customers(lake: Lake) -> EachBatch:
    """Customers per hour of orders_by_hour as bitmaps, which merge over micro-batches and
    over hours.  Customers are numbered as they come, so that bitmaps are dense."""

    def each_batch(orders: DataFrame, batch: str) -> None:
        with held(orders) as kept, held(new_rows(kept, "order", "order_id", ["sent"]).select("hour", "customer_id").distinct()) as fresh:
            numbers = NumberedKeys(lake, "customer_numbers").take_in(fresh, "customer_id", batch)
            seen = fresh.join(numbers, F.col("customer_id") == F.col("key"))
            lake.write_batch(bitmaps(seen, ["hour"]), "hourly_bitmaps", batch, BITMAPS, "staging")

    return each_batch


def customers_by_hour(lake: Lake) -> DataFrame:
    """period ('hour'), start and unique_customers of all micro-batches so far."""
    found = distinct_counts(lake.read("hourly_bitmaps", BITMAPS, "staging"), ["hour"], "unique_customers")
    return found.select(F.lit("hour").alias("period"), F.col("hour").alias("start"), "unique_customers")


def customers_by_day(lake: Lake) -> DataFrame:
    """As customers_by_hour, by day: the union of the day's hours, not their sum."""
    daily = lake.read("hourly_bitmaps", BITMAPS, "staging").withColumn("start", day_start(F.col("hour")))
    found = distinct_counts(daily, ["start"], "unique_customers")
    return found.select(F.lit("day").alias("period"), "start", "unique_customers")
