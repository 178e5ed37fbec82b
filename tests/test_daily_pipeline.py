from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

import __spark_entry__ as entry_points
from frames import frame
from tillstream.plans.pipeline import TEST_RESULTS, ingest_batch, run_pipeline, run_spark_metrics
from tillstream.plans.quality import QualityError, SchemaTestError, require_schema_tests
from tillstream.sources.tables import Lake

NOW = "2024-02-01 00:00:00"


def batch(spark, n, status="shipped", items=True, first=0):
    ids = [f"o{i}" for i in range(first, first + n)]
    bought = datetime(2024, 1, 15, 8)
    return {
        "customers": frame(spark, [("c1", "Oslo")], "customer_id string, customer_city string"),
        "products": frame(spark, [("p1", "toys", Decimal(2))], "product_id string, category_name string, product_price decimal(18,2)"),
        "orders": frame(
            spark,
            [(i, "c1", status, bought) for i in ids],
            "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz",
        ),
        "order_items": frame(
            spark,
            [(i, "p1", 1, Decimal(2)) for i in ids if items],
            "order_id string, product_id string, quantity int, price decimal(18,2)",
        ),
    }


def mart_rows(lake):
    return lake.rebuilt("marts", "mart_order_metrics").collect()


def test_run_builds_the_mart_and_can_be_repeated(spark, lake):
    first = run_pipeline(lake, batch(spark, 5), "day-1", NOW).collect()
    assert (first[0].total_orders, first[0].gross_revenue) == (5, Decimal(10))
    assert run_pipeline(lake, batch(spark, 5), "day-1", NOW).collect() == first
    second = run_pipeline(lake, batch(spark, 5, first=3), "day-2", NOW).collect()
    # Orders 3 and 4 are known; their items are added again, as items have no key.
    assert (second[0].total_orders, second[0].gross_revenue) == (8, Decimal(20))
    log = lake.read("dq_results")
    assert log.count() == 42
    assert {r.run_id for r in log.select("run_id").distinct().collect()} == {"day-1", "day-2"}


def test_gate_leaves_the_mart_as_it_was(spark, lake):
    run_pipeline(lake, batch(spark, 5), "day-1", NOW)
    before = mart_rows(lake)
    with pytest.raises(QualityError, match="halted"):
        run_pipeline(lake, batch(spark, 5, status="lost", first=10), "day-2", NOW)
    assert mart_rows(lake) == before
    assert lake.read("dq_results").where("status = 'FAIL'").count() == 1


def test_day_without_items_fails_a_schema_test(spark, lake):
    with pytest.raises(SchemaTestError, match="gross_revenue not_null"):
        run_pipeline(lake, batch(spark, 3, items=False), "day-1", NOW)
    assert mart_rows(lake)[0].gross_revenue is None


def test_every_row_of_a_batch_is_accounted_for(spark, lake):
    ddl = "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz, sent int"
    bought = datetime(2024, 1, 15, 8)
    load = lambda rows, name: ingest_batch(lake, {"orders": frame(spark, rows, ddl)}, name, {"orders": ["sent"]})
    load([("o1", "c1", "shipped", bought, 1)], "day-1")
    load(
        [(None, "c2", "shipped", bought, 1), ("o1", "c9", "lost", bought, 0), ("o2", "z", "late", bought, 5),
         ("o2", "c3", "first", bought, 4), ("o2", "a", "unknown", bought, None), (None, None, None, None, None)],
        "day-2",
    )
    stored = {r.order_id: r.customer_id for r in lake.read("orders").collect()}
    assert stored == {"o1": "c1", "o2": "c3"}
    bad = lake.read("quarantine").collect()
    assert [r.reason for r in bad] == ["orders without order_id"] * 2
    assert '"customer_id":"c2"' in "".join(r.value for r in bad)


def test_fail_fast_and_reported_tests(spark, lake):
    with pytest.raises(QualityError, match="1 quality check"):
        run_pipeline(lake, batch(spark, 5, status="lost"), "day-1", NOW, fail_fast=True)
    lake = Lake(spark, f"{lake.root}-other")
    run_pipeline(lake, batch(spark, 3, items=False), "day-2", NOW, require_tests=False)
    failures = {(r.dataset, r.test): r.failures for r in lake.batches("test_results", TEST_RESULTS, "staging").collect() if r.failures}
    assert failures == {("mart_order_metrics", "not_null"): 1}
    assert mart_rows(lake)[0].gross_revenue is None


def test_a_rebuilt_table_is_read_whole_at_any_time(spark, lake):
    for n in (3, 5, 2):
        lake.rebuild(spark.range(n), "marts", "m")
        assert lake.rebuilt("marts", "m").count() == n
    # A run that died while it wrote: the slot in turn is broken, the table is as it was.
    spark.range(9).write.mode("overwrite").parquet(f"{lake.path('marts', 'm')}/slot0")
    assert lake.rebuilt("marts", "m").count() == 2


def test_second_mart_is_written(spark, lake):
    ingest_batch(lake, batch(spark, 4), "day-1")
    assert [(r.total_orders, r.gross_revenue) for r in run_spark_metrics(lake).collect()] == [(4, Decimal(8))]


def test_created_at_is_filled(spark, lake):
    lake.write_batch(batch(spark, 2)["orders"], "orders", "b", created_at="2024-01-01 00:00:00")
    assert {r.created_at for r in lake.read("orders").collect()} == {datetime(2024, 1, 1)}


def given_shop(spark, folder, customer=lambda key: 1, items=lambda key: True):
    """Tables of 200 orders, one per day, and as many events, for the registered query."""
    day = lambda k: datetime(2000, 1 + k // 28, 1 + k % 28)
    kinds = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    tables = {
        "orders": (
            [(k, customer(k), day(k), kinds[k % 5], 10.0) for k in range(200)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double",
        ),
        "lineitem": (
            [(k, 1, 1, 2.0, 3.0) for k in range(200) if items(k)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double",
        ),
        "customer": ([(1,)], "c_custkey long"),
        "part": ([(1, "toys", 2, 3.0)], "p_partkey long, p_type string, p_size int, p_retailprice double"),
        "events": (
            [(k, datetime(2024, 1, 15, 8), k % 7, "view", 3.0, '{"k": 4}') for k in range(200)],
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        ),
    }
    for name, (given, ddl) in tables.items():
        frame(spark, given, ddl).write.parquet(f"{folder}/{name}.parquet")
    return entry_points.queries()["pipeline_daily"](spark, str(folder))


def test_daily_query_stops_at_a_failed_schema_test(spark, tmp_path):
    # One order of 400 has no customer: the gate lets a warning pass, a declared test does not.
    with pytest.raises(SchemaTestError, match=r"failed: orders.customer_id not_null \(1\)$"):
        given_shop(spark, tmp_path, customer=lambda key: None if key == 7 else 1)


def test_daily_query_keeps_days_without_items(spark, tmp_path):
    got = given_shop(spark, tmp_path, items=lambda key: key not in (3, 50)).collect()
    assert len(got) == 201
    assert sorted(r.order_date for r in got if r.gross_revenue is None) == [datetime(2000, 1, 4), datetime(2000, 2, 23)]


def test_only_days_without_items_are_excused(spark, lake):
    def run(name, orders):
        """orders: order_id, day of January, prices of its items."""
        tables = batch(spark, 0)
        tables["orders"] = frame(spark, [(o, "c1", "shipped", datetime(2024, 1, d)) for o, d, _ in orders], tables["orders"].schema)
        tables["order_items"] = frame(spark, [(o, "p1", 1, p) for o, _, prices in orders for p in prices], tables["order_items"].schema)
        return run_pipeline(lake, tables, name, NOW, itemless_days=True)

    two = Decimal(2)
    first = run("day-1", [("a", 1, [two]), ("b", 2, []), ("c", 3, []), ("d", 3, [two, None])]).collect()
    assert [r.gross_revenue for r in first] == [two, None, two]
    # Items without a price: this day has no revenue for another reason.
    with pytest.raises(SchemaTestError, match=r"failed: mart_order_metrics.gross_revenue not_null \(2\)$"):
        run("day-2", [("e", 4, [None, None]), ("f", 4, [])])


def test_more_failures_than_excused_rows_raise(spark):
    key = ("orders", "order_id", "unique")
    found = frame(spark, [(*key, 2), ("orders", "customer_id", "not_null", 0)], TEST_RESULTS)
    require_schema_tests(found, {key: spark.range(2)})
    for excused in ({key: spark.range(1)}, {("orders", "order_id", "not_null"): spark.range(9)}, None):
        with pytest.raises(SchemaTestError, match=r"unique \(2\)"):
            require_schema_tests(found, excused)
