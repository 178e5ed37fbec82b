from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from frames import frame
from tillstream.operators.revenue import orders_and_revenue
from tillstream.plans import marts, reports
from tillstream.plans.staging import stg_orders

ORDER = (
    "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz,"
    " order_approved_ts timestamp_ntz, order_delivered_ts timestamp_ntz,"
    " order_estimated_delivery_date date, created_at timestamp_ntz"
)
ITEM = "order_id string, product_id string, quantity int, price decimal(18,2), freight_value decimal(18,2)"


def order(oid, customer="c1", status="shipped", bought=datetime(2024, 1, 1, 10), delivered=None, due=None):
    return (oid, customer, status, bought, None, delivered, due, bought)


def item(oid, price, quantity=1, product="p1"):
    return (oid, product, quantity, Decimal(price), Decimal("0.10"))


def test_staging_rules(spark):
    due = date(2024, 1, 5)
    orders = frame(
            spark,
        [
            order("on_due_day", delivered=datetime(2024, 1, 5, 0, 0, 1), due=due),
            order("at_midnight", delivered=datetime(2024, 1, 5), due=due),
            order("open", due=due),
            order("no_due", delivered=datetime(2024, 1, 2, 22)),
            order(None),
            order("no_customer", customer=None),
        ],
        ORDER,
    )
    got = {r.order_id: r for r in stg_orders(orders).collect()}
    assert set(got) == {"on_due_day", "at_midnight", "open", "no_due"}
    assert {k: r.is_late for k, r in got.items()} == {
        "on_due_day": True, "at_midnight": False, "open": False, "no_due": False,
    }
    assert got["no_due"].delivery_days == 1.5
    assert got["open"].delivery_days is None


def test_mart_of_days_with_and_without_items(spark):
    second = datetime(2024, 1, 2, 9)
    orders = frame(
            spark,
        [
            order("a", delivered=datetime(2024, 1, 2, 22)),
            order("b", customer="c2", status="returned"),
            order("c", customer="c1", bought=second, status="cancelled"),
            order("n", bought=None),
        ],
        ORDER,
    )
    items = frame(spark, [item("a", "10.00", 2), item("a", "1.01"), item("x", "9.00")], ITEM)
    got = marts.mart_order_metrics(stg_orders(orders), items).collect()
    # A NULL day comes first, then the newest.
    assert [r.order_date for r in got] == [None, datetime(2024, 1, 2), datetime(2024, 1, 1)]
    no_items, first = got[1], got[2]
    assert (no_items.gross_revenue, no_items.avg_order_value, no_items.total_orders) == (None, None, 1)
    assert first.gross_revenue == Decimal("21.01") == first.avg_order_value
    assert first.avg_delivery_days == Decimal("1.5")
    assert (first.unique_customers, first.returned_orders, first.return_rate_pct) == (2, 1, Decimal("50.00"))

    raw = marts.spark_order_metrics(orders, items).collect()
    assert [r.order_date for r in raw] == [date(2024, 1, 2), date(2024, 1, 1), None]
    assert raw[1].avg_delivery_days == Decimal("1.0")


def test_raw_mart_keeps_null_orders_and_does_not_divide_by_zero(spark):
    orders = frame(spark, [order(None, status="returned"), order(None)], ORDER)
    items = frame(spark, [item(None, "5.00")], ITEM)
    row = marts.spark_order_metrics(orders, items).first()
    assert (row.total_orders, row.returned_orders, row.return_rate_pct) == (0, 1, None)
    assert row.gross_revenue is None


def test_grouped_join_equals_join_of_raw_rows(spark, rows):
    """A third of the items and of the orders belongs to one order; NULLs and copies."""
    draw = random.Random(3)
    ids = ["hot"] * 40 + [None] * 10 + [f"o{i}" for i in range(70)]
    orders = frame(
            spark,
        [(draw.choice(ids), draw.choice("xyz")) for _ in range(300)], "order_id string, g string"
    )
    items = frame(
            spark,
        [(draw.choice(ids), draw.randrange(1, 5), Decimal(draw.randrange(1, 9999)) / 100) for _ in range(400)],
        "order_id string, quantity int, price decimal(18,2)",
    )
    expected = (
        orders.join(items, "order_id", "left")
        .groupBy("g")
        .agg(F.countDistinct("order_id"), F.sum(F.col("price") * F.col("quantity")).cast("decimal(38,2)"))
    )
    got = orders_and_revenue(orders, items, ["g"]).drop("priced_orders")
    assert rows(got) == rows(expected)


def test_live_feed_equals_top_of_joined_rows(spark, rows):
    draw = random.Random(5)
    start = datetime(2024, 1, 1)
    orders = frame(
            spark,
        [
            (f"o{i}", f"c{draw.randrange(6)}", "shipped", start + timedelta(minutes=draw.randrange(90)), None, None, None, None)
            for i in range(40)
        ],
        ORDER,
    ).withColumns({"weather_condition": F.lit("Rain"), "temperature_c": F.lit(1)})
    items = frame(
            spark,
        [item(f"o{draw.randrange(30)}", f"{draw.randrange(100)}.00") for _ in range(60)]
        + [item("o7", f"{i}.00") for i in range(60)],
        ITEM,
    )
    customers = frame(
            spark,
        [("c1", "Oslo", "NO"), ("c2", "Rome", "IT"), ("c2", "Bari", "IT"), ("c3", "Graz", "AT")],
        "customer_id string, customer_city string, country_code string",
    )
    joined = orders.join(customers, "customer_id", "left").join(items, "order_id", "left")
    for n in (1, 5, 20, 200):
        expected = (
            joined.where(F.col("order_purchase_ts") >= F.lit("2024-01-01 00:30:00").cast("timestamp_ntz"))
            .orderBy(F.desc("order_purchase_ts"), "order_id", "customer_id", "customer_city", "country_code", "price")
            .limit(n)
            .select("order_id", "customer_city", "country_code", "price", "order_purchase_ts")
        )
        got = reports.live_order_feed(orders, customers, items, "2024-01-01 01:30:00", n=n).select(
            "order_id", "city", "country_code", "price", "purchased_at"
        )
        assert rows(got) == rows(expected)


def test_kpi_changes_compare_rows_not_calendar_days(spark):
    def day(n, orders, revenue):
        return (datetime(2024, 1, n), orders, revenue, None, None, None)

    schema = (
        "order_date timestamp_ntz, total_orders bigint, gross_revenue decimal(38,2),"
        " avg_order_value decimal(18,2), avg_delivery_days decimal(9,1), return_rate_pct decimal(18,2)"
    )
    mart = frame(spark, [day(1, 4, Decimal(10)), day(5, 7, Decimal(25))], schema)
    row = reports.kpi_latest(mart).first()
    assert (row.orders_delta, row.revenue_delta) == (3, Decimal(15))
    assert (row.avg_delivery_days, row.return_rate_pct) == (0, 0)
    zero = frame(spark, [day(1, 4, Decimal(0)), day(2, 7, Decimal(25))], schema)
    assert reports.kpi_latest(zero).first().revenue_delta is None
    single = frame(spark, [day(1, 4, Decimal(10))], schema)
    row = reports.kpi_latest(single).first()
    assert (row.orders_delta, row.revenue_delta) == (None, None)
    trend = reports.revenue_trend(mart, 1).collect()
    assert [r.order_date for r in trend] == [datetime(2024, 1, 5)]
