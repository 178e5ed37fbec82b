"""Items under their orders' periods, and tables whose schema grows."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from frames import frame
from pyspark.sql import types as T

from tillstream.plans import placed, reports
from tillstream.schemas import INT, LONG, MONEY, STRING, TIME, columns
from tillstream.sources.evolving import EvolvingTable, fields_of, store_as_they_come, unified
from tillstream.sources.order_topic import MESSAGE
from tillstream.sources.tables import Lake

NOW = datetime(2024, 6, 30, 12)
ORDERS = columns(order_id=STRING, customer_id=STRING, order_status=STRING, order_purchase_ts=TIME)
ITEMS = columns(order_id=STRING, product_id=STRING, quantity=INT, price=MONEY)


@pytest.mark.parametrize("period", ["day", "month"])
def test_a_short_report_opens_few_files_of_items(spark, tmp_path, rows, period):
    lake = Lake(spark, str(tmp_path / "lake"), order_period=period)
    orders = [(f"o{n}", f"c{n % 4}", "shipped", NOW - timedelta(days=3 * n, hours=1)) for n in range(60)]
    items = [(f"o{n % 60}", f"p{n}", 1 + n % 3, 10 + n) for n in range(150)]
    lake.write_batch(frame(spark, orders[:50], ORDERS), "orders", "b0")
    placed.place_items(lake, frame(spark, items[:100], ITEMS), "b0")
    # Items that come late, with orders of their own, and without any order.
    lake.write_batch(frame(spark, orders[50:], ORDERS), "orders", "b1")
    late = [*items[100:], ("none", "p", 1, 5), (None, "p", 1, 5)]
    placed.place_items(lake, frame(spark, late, ITEMS), "b1")
    held = lake.read("placed_items")
    assert held.count() == 152
    plain = frame(spark, items, ITEMS)
    recent = placed.items_since(held, NOW, "7 days")
    recent.collect()
    scan = recent._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    opened = scan.metrics().apply("numFiles").value()
    total = len(held.inputFiles())
    assert opened < total / 3
    assert "PartitionFilters: [(isnull" in recent._jdf.queryExecution().executedPlan().toString() or "order_" in scan.toString()
    kept = lake.read("orders")
    for lookback in ("48 hours", "30 days"):
        assert rows(reports.hourly_order_metrics(kept, held, NOW, lookback)) == rows(
            reports.hourly_order_metrics(frame(spark, orders, ORDERS), plain, NOW, lookback)
        )


def schema(**types):
    return columns(**types)


def test_types_grow_by_the_rules_of_a_union(spark):
    old = schema(a=INT, b=LONG, c=STRING, d=T.DecimalType(5, 2), e=T.NullType(), f=INT, g=T.BooleanType())
    new = schema(b=T.DoubleType(), d=T.DecimalType(9, 4), a=LONG, h=STRING, e=INT, f=STRING, g=INT)
    found = {f.name: f.dataType.simpleString() for f in unified(spark, old, new)}
    assert found == {
        "a": "bigint", "b": "double", "c": "string", "d": "decimal(9,4)", "e": "int", "f": "string", "g": "string", "h": "string",
    }
    assert unified(spark, old, schema()).names == old.names


def test_stored_rows_are_read_in_the_newest_schema(spark, tmp_path, rows):
    table = EvolvingTable(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError):
        table.read()
    assert table.write_batch(frame(spark, [(1, "x")], schema(a=INT, b=STRING)), "b0") == 1
    assert table.write_batch(frame(spark, [(2, "y")], schema(a=INT, b=STRING)), "b1") == 1
    assert table.write_batch(frame(spark, [(2**40, 1.5)], schema(a=LONG, c=T.DoubleType())), "b2") == 2
    assert table.write_batch(frame(spark, [("z",)], schema(b=STRING)), "b3") == 2
    want = [(None, "z", None), (1, "x", None), (2**40, None, 1.5), (2, "y", None)]
    assert rows(table.read()) == want
    # A batch that is run again replaces its own rows.
    table.write_batch(frame(spark, [(2**40, 1.5)], schema(a=LONG, c=T.DoubleType())), "b2")
    assert rows(table.read()) == want
    assert [f.dataType.simpleString() for f in table.read().schema] == ["bigint", "string", "double"]


def test_fields_come_from_the_messages(spark, tmp_path, rows):
    def batch(*values):
        return frame(spark, [("k", v if v is None or isinstance(v, str) else json.dumps(v)) for v in values], MESSAGE)

    mixed = batch({"a": 1, "b": "x"}, {"a": 2.5}, {"c": {"d": 1}}, {"c": [1]}, None, "not json", "[1]", "7")
    found = {f.name: f.dataType.simpleString() for f in fields_of(mixed)}
    assert found["b"] == found["c"] == "string" and found["a"].startswith(("decimal", "double"))
    table = EvolvingTable(spark, str(tmp_path / "table"))
    each = store_as_they_come(table)
    each(batch(None, "bad"), "b0")
    each(batch({"a": 1}, "bad"), "b1")
    each(batch({"a": 2, "b": "x"}), "b2")
    each(batch({"a": 2.25, "c": {"d": 1}}, {"a": 9}), "b3")
    got = [(float(r.a), r.b, r.c) for r in table.read().orderBy("a").collect()]
    assert got == [(1, None, None), (2, "x", None), (2.25, None, '{"d":1}'), (9, None, None)]
