"""Report queries over raw tables and the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, hour_start, since
from tillstream.functions.money import mean_of
from tillstream.operators.keyed import only_keys_of
from tillstream.operators.revenue import orders_and_revenue
from tillstream.plans.placed import items_since


def hourly_order_metrics(
    orders: DataFrame, items: DataFrame, as_of: AsOf = None, lookback: str | None = "48 hours"
) -> DataFrame:
    """Orders, revenue and customers per hour, newest hour first.

    lookback=None takes all orders.
    """
    recent = since(orders, "order_purchase_ts", as_of, lookback) if lookback else orders
    timed = recent.select(
        "order_id", "customer_id", hour_start(F.col("order_purchase_ts")).alias("hour")
    )
    customers = timed.groupBy(F.col("hour").alias("_hour")).agg(
        F.countDistinct("customer_id").alias("unique_customers")
    )
    if lookback:
        items = only_keys_of(items_since(items, as_of, lookback), timed, "order_id")
    sales = orders_and_revenue(timed.select("order_id", "hour"), items, ["hour"])
    return (
        sales.join(customers, F.col("hour").eqNullSafe(F.col("_hour")))
        .select("hour", "total_orders", "gross_revenue", "unique_customers")
        .orderBy(F.desc_nulls_first("hour"))
    )


def weather_order_metrics(
    orders: DataFrame, as_of: AsOf = None, lookback: str = "7 days"
) -> DataFrame:
    """Orders and mean readings per weather condition, most orders first."""
    condition = F.col("weather_condition")
    recent = since(orders, "order_purchase_ts", as_of, lookback)
    return (
        recent.where(condition.isNotNull() & (condition != ""))
        .groupBy("weather_condition")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            mean_of(F.col("temperature_c"), 1, scale=2).cast("decimal(9,1)").alias("avg_temp"),
            mean_of(F.col("humidity"), 1).cast("decimal(9,1)").alias("avg_humidity"),
        )
        .orderBy(F.desc("total_orders"), "weather_condition")
    )


def city_order_metrics(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    as_of: AsOf = None,
    lookback: str = "7 days",
) -> DataFrame:
    """Orders and revenue per city and coordinates, most orders first."""
    placed = customers.where(F.col("lat").isNotNull() & (F.col("lat") != 0)).select(
        "customer_id",
        F.col("customer_city").alias("city"),
        "country_name",
        "country_code",
        "lat",
        F.coalesce("lon", F.lit(0.0)).alias("lon"),
    )
    recent = since(orders, "order_purchase_ts", as_of, lookback).select("order_id", "customer_id")
    items = only_keys_of(items_since(items, as_of, lookback), recent, "order_id")
    by = ["city", "country_name", "country_code", "lat", "lon"]
    located = recent.join(placed, "customer_id").select("order_id", *by)
    return (
        orders_and_revenue(located, items, by)
        .drop("priced_orders")
        .orderBy(F.desc("total_orders"), *by)
    )


def live_order_feed(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    as_of: AsOf = None,
    lookback: str = "1 hour",
    n: int = 20,
) -> DataFrame:
    """The newest n order lines, one row per item.

    Every order gives at least one line and lines sort by their order first, so all n
    lines belong to the n newest orders.
    """
    lead = ["order_id", "customer_id", "order_status", "weather_condition", "temperature_c"]
    by_order = [F.desc("purchased_at"), *lead]
    newest = (
        since(orders, "order_purchase_ts", as_of, lookback)
        .select(*lead, F.col("order_purchase_ts").alias("purchased_at"))
        .orderBy(*by_order)
        .limit(n)
    )
    places = customers.select("customer_id", F.col("customer_city").alias("city"), "country_code")
    by_place = [*by_order, "city", "country_code"]
    placed = _top_with_details(_held(newest), places, "customer_id", by_place, n)
    prices = items_since(items, as_of, lookback).select("order_id", "price")
    lines = _top_with_details(_held(placed), prices, "order_id", [*by_place, "price"], n)
    return lines.select(
        "order_id", "city", "country_code", "order_status", "weather_condition",
        "temperature_c", "price", "purchased_at",
    )


def _held(top: DataFrame) -> DataFrame:
    """The few rows of a top n, computed once: a plan that names them twice would
    otherwise scan their tables twice."""
    return top.sparkSession.createDataFrame(top.toArrow(), top.schema)


def _top_with_details(
    top: DataFrame, details: DataFrame, key: str, order: list, n: int
) -> DataFrame:
    """First n rows of `top left join details`, where top has at most n rows and
    `order` starts with columns of top.

    The n rows are broadcast to the details, so those are filtered where they are
    scanned, and each task keeps its first n matches.  A row of top without a match
    among the first n matches either has none at all, or comes after n others and
    falls to the final limit.
    """
    matched = details.join(F.broadcast(top), key).orderBy(*order).limit(n)
    both = matched.withColumn("_match", F.lit(True)).unionByName(
        top.withColumn("_match", F.lit(False)), allowMissingColumns=True
    )
    # At most 2 n rows.
    found = F.max("_match").over(Window.partitionBy(key))
    return (
        both.withColumn("_found", found)
        .where(F.col("_match") | ~F.col("_found"))
        .drop("_match", "_found")
        .orderBy(*order)
        .limit(n)
    )


def daily_metrics_recent(mart: DataFrame, n: int = 90) -> DataFrame:
    """The newest n days of the mart."""
    return mart.orderBy(F.desc_nulls_first("order_date")).limit(n)


def dq_latest_results(log: DataFrame, n: int = 50) -> DataFrame:
    """The newest n rows of the quality log."""
    return (
        log.select("table_name", "check_name", "status", "fail_count", "run_at")
        .orderBy(F.desc_nulls_first("run_at"), "table_name", "check_name")
        .limit(n)
    )


def kpi_latest(mart: DataFrame, n: int = 90) -> DataFrame:
    """The latest day's KPIs and their change from the row before it.

    The window has no partitions; it sees the n rows that remain of the mart.
    """
    recent = daily_metrics_recent(mart, n)
    by_day = Window.orderBy(F.asc_nulls_last("order_date"))
    from_newest = Window.orderBy(F.desc_nulls_first("order_date"))
    earlier_revenue = F.lag("gross_revenue").over(by_day)
    zero = F.lit(0)
    return (
        recent.select(
            "order_date",
            "total_orders",
            (F.col("total_orders") - F.lag("total_orders").over(by_day)).alias("orders_delta"),
            "gross_revenue",
            F.when(earlier_revenue != 0, F.col("gross_revenue") - earlier_revenue).alias(
                "revenue_delta"
            ),
            "avg_order_value",
            F.coalesce("avg_delivery_days", zero).alias("avg_delivery_days"),
            F.coalesce("return_rate_pct", zero).alias("return_rate_pct"),
            F.row_number().over(from_newest).alias("_row"),
        )
        .where(F.col("_row") == 1)
        .drop("_row")
    )


def revenue_trend(mart: DataFrame, days: int = 30, n: int = 90) -> DataFrame:
    """Revenue of the newest days, oldest first."""
    recent = daily_metrics_recent(mart, min(days, n)).select("order_date", "gross_revenue")
    return recent.orderBy(F.asc_nulls_last("order_date"))
