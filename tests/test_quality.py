from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from frames import frame
from tillstream.plans import quality

ORDERS = "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz, order_approved_ts timestamp_ntz"
ITEMS = "order_id string, product_id string, price decimal(18,2), quantity int"
NOON = datetime(2024, 1, 1, 12)


def tables(spark, orders=(), items=()):
    return {
        "orders": frame(spark, list(orders), ORDERS),
        "customers": frame(spark, [], "customer_id string, customer_city string"),
        "products": frame(spark, [], "product_id string, category_name string, product_price decimal(18,2)"),
        "order_items": frame(spark, list(items), ITEMS),
    }


def by_check(df):
    return {r.check_name: r for r in df.collect()}


def test_empty_tables_pass(spark):
    got = quality.run_checks(tables(spark), NOON).collect()
    assert len(got) == 21
    assert {(r.status, r.detail, r.row_count, r.fail_count) for r in got} == {("PASS", "", 0, 0)}
    assert [r.table_name for r in got][::7] == ["orders", "orders", "products"]


@pytest.mark.parametrize("rows, status, share", [(100, "FAIL", "1.0"), (101, "WARN", "1.0"), (99, "FAIL", "1.0")])
def test_threshold_is_exactly_one_percent(spark, rows, status, share):
    orders = [(None if i == 0 else f"o{i}", "c", "shipped", NOON, NOON) for i in range(rows)]
    got = by_check(quality.run_checks(tables(spark, orders), NOON, ["orders"]))
    assert got["null_order_id"].status == status
    assert got["null_order_id"].detail == f"1 rows affected ({share}%)"
    assert got["duplicate_order_id"].status == "PASS"


def test_unknown_values_count_only_in_their_null_rule(spark):
    orders = [
        (None, None, None, None, NOON),
        (None, "c", "lost", datetime(2024, 1, 1, 13), NOON),
        ("a", "c", "shipped", NOON, None),
        ("a", "c", "shipped", NOON, NOON),
        ("a", "c", "shipped", NOON, NOON),
    ]
    got = {k: r.fail_count for k, r in by_check(quality.run_checks(tables(spark, orders), NOON, ["orders"])).items()}
    assert got == {
        "null_order_id": 2, "null_customer_id": 1, "null_status": 1, "null_purchase_ts": 1,
        # Keys, not rows: 'a' and NULL.
        "duplicate_order_id": 2,
        "future_purchase_ts": 1, "approved_before_purchase": 1, "invalid_status": 1,
    }


def test_orphans_include_null_keys(spark):
    orders = [("a", "c", "shipped", NOON, NOON), (None, "c", "shipped", NOON, NOON)]
    one = Decimal(1)
    items = [("a", "p", one, 1), ("b", "p", one, 1), ("b", "p", one, 0), (None, "p", -one, 1)]
    got = {
        k: (r.fail_count, r.row_count)
        for k, r in by_check(quality.run_checks(tables(spark, orders, items), NOON, ["order_items"])).items()
    }
    assert got["orphan_order_id"] == (3, 4)
    assert got["zero_quantity"] == (1, 4)
    assert got["negative_price"] == (1, 4)


def test_unknown_table_is_skipped(spark):
    got = quality.run_checks(tables(spark), NOON, ["nothing", "customers"]).collect()
    assert [r.check_name for r in got] == ["null_customer_id", "null_city", "duplicate_customer_id"]
    none = quality.run_checks(tables(spark), NOON, ["nothing"])
    assert none.columns == quality.run_checks(tables(spark), NOON).columns and none.count() == 0


def test_gate_looks_back_ten_minutes_and_lets_warnings_pass(spark):
    log = frame(
            spark,
        [("FAIL", datetime(2024, 1, 1, 11, 49, 59)), ("WARN", NOON), ("PASS", NOON)],
        "status string, run_at timestamp_ntz",
    )
    quality.require_gate(log, NOON)
    edge = frame(spark, [("FAIL", datetime(2024, 1, 1, 11, 50))], log.schema)
    with pytest.raises(quality.QualityError):
        quality.require_gate(edge, NOON)


def test_fail_fast(spark):
    bad = [(None, "c", "shipped", NOON, NOON)]
    quality.require_no_fail(quality.run_checks(tables(spark), NOON))
    with pytest.raises(quality.QualityError):
        quality.require_no_fail(quality.run_checks(tables(spark, bad), NOON))
