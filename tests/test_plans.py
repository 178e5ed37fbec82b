"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tillstream.functions.clock import since
from tillstream.operators.keyed import only_keys_of
from tillstream.operators.revenue import orders_and_revenue
from tillstream.plans import reports
from tillstream.plans.staging import publish_view, stg_orders
from tillstream.session import work_area
from tillstream.sources.shaped import Shop
from tillstream.sources.tables import Lake, save_colocated, save_mart, table_name

SMALL = "/root/testdata/sf0.001"
# Queries that write tables first and read them back.
WRITING = (
    r"(stream|pipeline|reject|write)_?.*|op\d+_.*|.*_placed|mart_incremental|insert_orders_by_index"
    r"|hourly_customers_bitmap|dq_on_write|evolve_stored_tables"
)
BATCH_QUERIES = [n for n in entry_points.queries() if not re.fullmatch(WRITING, n)]


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_plans_stay_on_the_jvm_and_form_no_products(spark, plan, no_broadcast, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    for operator in ("Python", "CartesianProduct", "NestedLoopJoin", "ExistingRDD"):
        assert operator not in text


def test_mart_reads_only_the_columns_it_needs(spark, plan):
    text = plan(entry_points.queries()["mart_order_metrics"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    items = [s for s in schemas if "l_orderkey" in s]
    assert items == ["l_orderkey:bigint,l_quantity:double,l_extendedprice:double"]


def test_live_feed_does_not_shuffle_items(spark, plan, no_broadcast):
    shop = Shop(spark, SMALL)
    feed = reports.live_order_feed(
        shop.orders(), shop.customers(), shop.order_items(), entry_points.RETAIL_NOW, "7 days"
    )
    text = plan(feed)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert text.count("FileScan parquet [l_orderkey") == 1


def test_colocated_tables_join_without_shuffling_orders(spark, plan, no_broadcast):
    shop = Shop(spark, SMALL)
    save_colocated(shop.orders(), "raw", "orders", "order_id", 4)
    save_colocated(shop.order_items(), "raw", "order_items", "order_id", 4)
    orders, items = spark.table(table_name("raw", "orders")), spark.table(table_name("raw", "order_items"))
    days = orders.select("order_id", F.to_date("order_purchase_ts").alias("day"))
    sales = orders_and_revenue(days, items, ["day"])
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan(sales))
    assert shuffles == ["day"]
    assert sales.agg(F.sum("total_orders")).first()[0] == orders.count()


@pytest.mark.parametrize("period, column", [("day", "order_date"), ("month", "order_month")])
def test_time_range_prunes_partitions(spark, plan, tmp_path, period, column):
    lake = Lake(spark, str(tmp_path), period)
    some = Shop(spark, SMALL).orders().where("order_purchase_ts >= '2001-05-01'")
    lake.write_batch(some, "orders", "b")
    recent = since(lake.read("orders"), "order_purchase_ts", "2001-08-01 00:00:00", "7 days")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(recent)).group(1)
    assert column in filters
    assert recent.count() == some.where("order_purchase_ts >= '2001-07-25'").count() > 0


def test_short_reports_filter_items_by_broadcast_keys(spark, plan, rows, no_broadcast, monkeypatch):
    shop = Shop(spark, SMALL)

    def report():
        return reports.hourly_order_metrics(shop.orders(), shop.order_items(), entry_points.RETAIL_NOW)

    few = report()
    assert re.search(r"BroadcastHashJoin \[order_id#\d+\], \[order_id#\d+\], LeftSemi", plan(few))
    monkeypatch.setattr(reports, "only_keys_of", lambda df, few, key: only_keys_of(df, few, key, limit=0))
    many = report()
    assert "LeftSemi" not in plan(many)
    assert rows(many) == rows(few) != []


def test_views_and_marts(spark):
    shop = Shop(spark, SMALL)
    publish_view(stg_orders(shop.orders()))
    assert spark.table("stg_orders").count() == shop.orders().count()
    daily = entry_points._mart(shop)
    save_mart(daily, "mart_order_metrics")
    save_mart(daily, "mart_order_metrics")
    assert spark.table("marts.mart_order_metrics").count() == daily.count()


def test_work_area_lies_in_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    one, two = work_area(spark, "x"), work_area(spark, "x")
    assert one.startswith(shared) and one != two


def test_hot_customer_is_split_in_the_city_report(spark, plan, rows, no_broadcast):
    """A third of the orders of one customer: the join splits that partition."""
    shop = Shop(spark, SMALL)
    n = F.col("id")
    orders = spark.range(0, 60_000, 1, 6).select(
        F.concat(F.lit("o"), n.cast("string")).alias("order_id"),
        F.when(n % 3 == 0, "7").otherwise((n % 100).cast("string")).alias("customer_id"),
        F.lit("2001-08-01 12:00:00").cast("timestamp_ntz").alias("order_purchase_ts"),
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        report = reports.city_order_metrics(shop.customers(), orders, shop.order_items(), entry_points.RETAIL_NOW)
        total = sum(r.total_orders for r in report.collect())
        assert "skew=true" in plan(report)
    finally:
        for key in settings:
            spark.conf.unset(key)
    placed = shop.customers().where("lat <> 0").select("customer_id")
    assert total == orders.join(placed, "customer_id").count()
