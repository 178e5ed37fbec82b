"""Batches that arrive late, again, or only in part."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from frames import frame

from tillstream.operators.distinct import NumberedKeys, bitmaps, distinct_counts, numbered
from tillstream.operators.key_index import KeyIndex
from tillstream.plans import checked, incremental, pipeline, quality
from tillstream.plans.marts import mart_order_metrics
from tillstream.plans.staging import stg_orders
from tillstream.schemas import DATE, INT, LONG, MONEY, STRING, TIME, columns
from tillstream.sources.commits import CommittedLake
from tillstream.sources.order_topic import MESSAGE
from tillstream.streaming import feed
from tillstream.streaming.fresh import KEY, KIND
from tillstream.streaming.ingest import ingest_atomically

KEYS = columns(order_id=STRING)
ORDERS = columns(
    order_id=STRING, customer_id=STRING, order_status=STRING, order_purchase_ts=TIME, order_delivered_ts=TIME,
    order_estimated_delivery_date=DATE,
)
ITEMS = columns(order_id=STRING, product_id=STRING, quantity=INT, price=MONEY, freight_value=MONEY)
DAY = datetime(2024, 3, 1)


def order(n, day=0, status="shipped"):
    return (f"o{n}", f"c{n % 3}", status, None if day is None else DAY + timedelta(days=day, hours=n % 24), None, None)


def item(n, price=10):
    return (f"o{n}", f"p{n}", 2, price, 1)


def metrics(df):
    """Files opened and rows read by the only scan of a plan without shuffles."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = leaves.apply(0).metrics()
    return found.apply("numFiles").value(), found.apply("numOutputRows").value()


# Key index.


def test_a_lookup_opens_only_the_files_its_keys_can_be_in(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=16, expected=1000)
    for batch in range(3):
        index.add(spark.range(2000 * batch, 2000 * (batch + 1)).selectExpr("concat('o', id) as order_id"), "order_id", f"b{batch}")
    keys = lambda *names: frame(spark, [(n,) for n in names], KEYS)
    files, rows = metrics(index.candidates(keys("o17", "o5000"), "order_id"))
    assert files <= 2 * 3 and 2 <= rows < 6000 / 16 * 2
    # Keys inside the range of the files that none of them holds: the Bloom filters say so.
    files, rows = metrics(index.candidates(keys("o17x", "o3000x", "o5000x"), "order_id"))
    assert rows == 0
    many, _ = metrics(index.candidates(spark.range(4000).selectExpr("concat('o', id) as order_id"), "order_id", few=10))
    assert many == 16 * 3
    assert metrics(index.candidates(keys("o17"), "order_id", but="b0"))[1] == 0


def test_new_rows_by_index(spark, tmp_path, rows):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=4)
    schema = columns(order_id=STRING, key=STRING, sent=INT)
    assert rows(index.new_rows(frame(spark, [("a", "x", 1)], schema), "order_id")) == [("a", "x", 1)]
    index.add(frame(spark, [("a",), ("b",), (None,), ("a",)], KEYS), "order_id", "b0")
    incoming = frame(spark, [("a", "x", 1), ("c", "y", 2), ("c", "z", 1), (None, "n", 1), ("d", None, None)], schema)
    for known in (None, 5):
        assert rows(index.new_rows(incoming, "order_id", ["sent"], rows=known)) == [("c", "z", 1), ("d", None, None)]
    # The batch that brought a key does not know it when it is run again.
    assert [r[0] for r in rows(index.new_rows(incoming, "order_id", ["sent"], but="b0"))] == ["a", "c", "d"]
    none = frame(spark, [], columns(batch_id=STRING))
    assert len(rows(index.new_rows(incoming, "order_id", ["sent"], batches=none))) == 3
    index.compact("all")
    again = KeyIndex(spark, str(tmp_path / "keys_compacted"), buckets=4)
    assert sorted(r.key for r in again.scan().collect()) == ["a", "b"]
    assert index.new_rows(incoming.limit(0), "order_id").count() == 0


# One commit over four tables.


def event(n, **changes):
    sent = DAY + timedelta(minutes=n)
    body = {
        "order_id": f"o{n}", "customer_id": f"c{n % 3}", "order_status": "shipped",
        "product": {"product_id": f"p{n % 2}", "category_name": "x", "price": 10 + n}, "quantity": 2, "freight_value": 1,
        "customer": {"city": f"city{n}", "state": "SP", "zip": "1", "country_code": "BR"},
        "purchased_at": sent.isoformat(), "ts": sent.isoformat(),
    }
    body.update(changes)
    return body["order_id"], json.dumps(body)


@pytest.fixture
def shared(spark, tmp_path):
    lake = CommittedLake(spark, str(tmp_path / "lake"))
    return lake, {n: KeyIndex(spark, str(tmp_path / "keys" / n), buckets=4) for n in pipeline.RAW}


def sizes(lake, **at):
    return {n: (lake.read_at(n, **at) if at else lake.read(n)).count() for n in (*pipeline.RAW, "quarantine")}


def test_a_batch_is_in_all_tables_or_in_none(spark, shared, monkeypatch):
    lake, indexes = shared
    run = ingest_atomically(lake, indexes, enriched=False)
    run(frame(spark, [event(0), event(1), ("bad", "{")], MESSAGE), "s-0")
    before = sizes(lake)
    assert before == {"orders": 2, "customers": 2, "products": 2, "order_items": 2, "quarantine": 1}

    class Died(Exception):
        pass

    # The process dies when the first tables are written and others are not.
    plain, seen = CommittedLake.write_batch, []

    def dies(self, df, name, *a, **k):
        if name == "order_items":
            seen.append(sizes(lake))
            raise Died
        return plain(self, df, name, *a, **k)

    monkeypatch.setattr(CommittedLake, "write_batch", dies)
    second = frame(spark, [event(1), event(2), event(4), ("bad", "[")], MESSAGE)
    with pytest.raises(Died):
        run(second, "s-1")
    monkeypatch.undo()
    assert seen == [before] and sizes(lake) == before
    # Another batch comes first; keys of the dead one are not known to it.
    run(frame(spark, [event(4, customer_id="c9")], MESSAGE), "t-0")
    assert sizes(lake)["orders"] == 3
    run(second, "s-1")
    assert sizes(lake) == {"orders": 4, "customers": 4, "products": 2, "order_items": 4, "quarantine": 2}
    assert lake.read("orders").where("order_id = 'o4'").first().customer_id == "c9"
    # A committed batch that is run again is not even written.
    monkeypatch.setattr(CommittedLake, "write_batch", dies)
    run(second, "s-1")
    monkeypatch.undo()
    assert sizes(lake, upto=1) == before
    assert [r.number for r in lake.commits().orderBy("number").collect()] == [1, 2, 3]


# Marts by touched period.


@pytest.mark.parametrize("period", ["day", "month"])
def test_refreshed_mart_equals_a_rebuilt_one(spark, tmp_path, rows, period):
    from tillstream.sources.tables import Lake

    lake = Lake(spark, str(tmp_path / "lake"), order_period=period)

    def load(batch, orders, items):
        pipeline.ingest_batch(lake, {"orders": frame(spark, orders, ORDERS), "order_items": frame(spark, items, ITEMS)}, batch)

    def same():
        full = mart_order_metrics(stg_orders(lake.read("orders")), lake.read("order_items"))
        assert rows(incremental.mart_by_period(lake)) == rows(full)

    load("b0", [order(n, day=n % 40) for n in range(50)] + [order(98, None)], [item(n) for n in range(45)])
    incremental.refresh_mart(lake)
    same()
    first = len(rows(incremental.mart_by_period(lake)))
    # New orders of an old day, of a new day, and late items of orders of another batch.
    load("b1", [order(60, day=3, status="returned"), order(61, day=70)], [item(60), item(61), item(47), item(98)])
    touched = incremental.refresh_mart(lake, ["b1"])
    assert len(touched) == (4 if period == "day" else 3)
    same()
    assert len(rows(incremental.mart_by_period(lake))) == first + 1
    # Repeated: nothing changes.
    incremental.refresh_mart(lake, ["b1"])
    same()
    # Replaced by other rows: a day that has no order left leaves the mart.
    load("b1", [order(60, day=4)], [item(60, 7)])
    incremental.refresh_mart(lake, ["b1"])
    same()
    assert len(rows(incremental.mart_by_period(lake))) == first
    assert incremental.refresh_mart(lake, ["no such batch"]) == []


def test_a_refresh_reads_only_touched_partitions(spark, tmp_path, plan):
    from tillstream.sources.tables import Lake

    lake = Lake(spark, str(tmp_path / "lake"))
    for b in range(3):
        orders = frame(spark, [order(100 * b + n, day=10 * b + n) for n in range(10)], ORDERS)
        pipeline.ingest_batch(lake, {"orders": orders, "order_items": frame(spark, [item(100 * b)], ITEMS)}, f"b{b}")
    touched = incremental._in_periods(lake.read("orders"), "order_date", incremental.periods_of_batch(lake, "b1"))
    files, read = metrics(touched)
    assert (files, read) == (10, 10)


# Mergeable distinct counts.


def test_numbers_are_gapless_and_stay(spark, lake, rows):
    keys = spark.range(5000).selectExpr("concat('c', id % 1000) as k")
    found = rows(numbered(keys, "k", 10, 7))
    assert sorted(int(r[1]) for r in found) == list(range(11, 1011)) and len({r[0] for r in found}) == 1000
    numbers = NumberedKeys(lake, "numbers", parts=3)
    first = dict(rows(numbers.take_in(frame(spark, [("a",), ("b",), (None,)], columns(k=STRING)), "k", "b0")))
    assert sorted(first.values()) == [1, 2]
    second = dict(rows(numbers.take_in(frame(spark, [("b",), ("z",)], columns(k=STRING)), "k", "b1")))
    assert second == {"b": first["b"], "z": 3}
    assert dict(rows(numbers.take_in(frame(spark, [("b",), ("z",)], columns(k=STRING)), "k", "b1"))) == second


def test_bitmaps_merge(spark, rows):
    data = [(g, n) for g in range(3) for n in range(1, 70_000, 7 + g)]
    schema = columns(g=INT, number=LONG)
    parts = [bitmaps(frame(spark, data[k::2] + data[:50], schema), ["g"]) for k in (0, 1)]
    both = parts[0].unionByName(parts[1])
    want = [(g, len({n for h, n in data if h == g})) for g in range(3)]
    assert rows(distinct_counts(both, ["g"], "n")) == want
    whole = distinct_counts(both.withColumn("g", both.g * 0), ["g"], "n")
    assert rows(whole) == [(0, len({n for _, n in data}))]


# The feed over a stream.


def feed_batch(spark, events):
    """A micro-batch as feed_events gives it: lines and markers of new keys."""
    lines = [(f"o{n}", f"c{n % 4}", "shipped", "Rain", 1, 10 + n, f"city{n}", "BR", DAY + timedelta(minutes=at), DAY) for n, at, _, _ in events]
    schema = columns(
        order_id=STRING, customer_id=STRING, order_status=STRING, weather_condition=STRING, temperature_c=INT, price=INT,
        city=STRING, country_code=STRING, purchased_at=TIME, sent=TIME,
    )
    plain = frame(spark, lines, schema)
    marks = [("order", f"o{n}") for n, _, new, _ in events if new] + [("customer", f"c{n % 4}") for n, _, _, new in events if new]
    return plain.withColumns({KIND: plain.order_id.substr(1, 0), KEY: plain.order_id.substr(1, 0)}).selectExpr(
        "* except (%s, %s)" % (KIND, KEY), f"cast(null as string) as {KIND}", f"cast(null as string) as {KEY}"
    ).unionByName(frame(spark, marks, columns(**{KIND: STRING, KEY: STRING})), allowMissingColumns=True)


def test_feed_is_exact_under_late_and_repeated_batches(spark, lake):
    run = feed.keep_feed(lake, n=3)
    shown = lambda: [(r.order_id, r.city) for r in feed.live_feed(lake, DAY + timedelta(days=1), "2 days").collect()]
    assert shown() == []
    run(feed_batch(spark, [(1, 10, True, True), (2, 20, True, True)]), "s-0")
    assert shown() == [("o2", "city2"), ("o1", "city1")]
    late = feed_batch(spark, [(3, 15, True, True), (5, 5, True, False), (9, 30, True, False), (2, 50, False, False)])
    for _ in range(2):  # a micro-batch that is run again changes nothing
        run(late, "s-1")
        # o9 is of customer c1, whose first place is city1; o2 came before.
        assert shown() == [("o9", "city1"), ("o2", "city2"), ("o3", "city3")]


# Checks on write.


def test_checks_counted_on_write_equal_a_scan(spark, lake, rows, plan):
    orders = frame(spark, [order(1), order(2), (None, *order(3)[1:]), order(2), (None, *order(5, status="lost")[1:])], ORDERS)
    late = frame(spark, [order(1), order(7, None, "new")], ORDERS)
    customers = frame(spark, [("c1", None), (None, "x")], columns(customer_id=STRING, customer_city=STRING))
    products = frame(spark, [("p1", "x", -1), ("p2", None, 0), ("p1", "y", 1)], columns(product_id=STRING, category_name=STRING, product_price=MONEY))
    items = frame(spark, [item(1), item(9), item(9, -1), (None, "p", 0, 1, 1)], ITEMS)
    for _ in range(2):  # a batch written again replaces its counts
        checked.write_checked(lake, items, "order_items", "b0", DAY)
        checked.write_checked(lake, orders, "orders", "b0", DAY)
        checked.write_checked(lake, late, "orders", "b1", DAY)
        checked.write_checked(lake, customers, "customers", "b0", DAY)
        checked.write_checked(lake, products, "products", "b0", DAY)
    found = checked.counted_checks(lake)
    raw = {n: lake.read(n) for n in pipeline.RAW}
    assert rows(found) == rows(quality.run_checks(raw, DAY))
    assert "/raw/" not in plan(found)
    only = checked.counted_checks(lake, ["products"])
    assert rows(only) == rows(quality.run_checks(raw, DAY, ["products"]))
