from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from frames import frame
from tillstream.plans.enrich import enrich_country, enrich_weather
from tillstream.plans.ingest import first_currency, flatten_order_items, flatten_orders
from tillstream.plans.reports import hourly_order_metrics
from tillstream.sources.order_topic import MESSAGE, accepted, decode, encode, folder_stream, rejected
from tillstream.schemas import INT, LONG, STRING, TIME, columns
from tillstream.sources.shaped import EVENT_ROWS, Shop
from tillstream.streaming.feed import feed_events
from tillstream.streaming.enrich import TABLE, enrich_orders
from tillstream.streaming.hourly import count_hours, hourly_counts, hourly_windows, orders_by_hour
from tillstream.streaming.ingest import append_new_orders, ingest_messages, orders_once
from tillstream.streaming.jobs import run_to_end, start

START = datetime(2024, 1, 1)


def event(n, buyer="c1", sold="p1", minutes=None, **changes):
    sent = START + timedelta(minutes=n if minutes is None else minutes)
    body = {
        "event_type": "order_created",
        "order_id": f"o{n}",
        "customer_id": buyer,
        "order_status": "shipped",
        "product": {"product_id": sold, "category_name": f"cat{n}", "price": 10.5 + n},
        "quantity": 2,
        "freight_value": 1.05,
        "customer": {"city": f"city{n}", "state": "SP", "zip": "01", "country_code": "BR"},
        "weather": {"weather_condition": "Rain", "temperature_c": 3.5, "humidity": 7},
        "purchased_at": (sent - timedelta(minutes=n % 50)).isoformat(),
        "ts": sent.isoformat(),
    }
    body.update(changes)
    return (body["order_id"], json.dumps({k: v for k, v in body.items() if v is not ...}))


def deliver(spark, folder, name, messages):
    frame(spark, messages, MESSAGE).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def topic(tmp_path):
    return str(tmp_path / "topic")


def messages_of(spark, topic, **options):
    return folder_stream(spark, f"{topic}/*", **options)


def table(lake, name, *columns):
    return sorted(tuple(r) for r in lake.read(name).select(*columns).collect())


@pytest.fixture
def delivered(spark, topic):
    """Three files: repeated orders within and across them, late events, bad messages."""
    deliver(spark, topic, "1", [event(3), event(1), event(2, buyer="c2"), event(1)])
    deliver(spark, topic, "2", [event(2, buyer="c9"), event(4, sold="p2"), ("bad", '{"order_id": "o5", "qua')])
    deliver(spark, topic, "3", [event(0, buyer="c3", sold="p3"), event(6, customer_id=...), event(4)])
    return topic


@pytest.mark.parametrize("files_at_once", [1, None])
def test_ingest_stores_each_order_once(spark, lake, delivered, tmp_path, files_at_once):
    stream = messages_of(spark, delivered, max_files_per_trigger=files_at_once)
    run_to_end(stream, ingest_messages(lake, enriched=False), str(tmp_path / "checkpoint"))
    assert [r[0] for r in table(lake, "orders", "order_id")] == ["o0", "o1", "o2", "o3", "o4"]
    assert [r[0] for r in table(lake, "order_items", "order_id")] == ["o0", "o1", "o2", "o3", "o4"]
    assert table(lake, "quarantine", "key", "reason") == [("bad", "malformed"), ("o6", "missing customer_id")]
    assert [r[0] for r in table(lake, "products", "product_id")] == ["p1", "p2", "p3"]
    assert {r[0] for r in table(lake, "order_items", "seller_id")} == {"kafka-seller"}
    customers = dict(table(lake, "customers", "customer_id", "customer_city"))
    # Of the first file's events for c1, the one sent first.
    assert customers["c1"] == "city1"
    assert customers["c2"] == "city2"


def test_ingest_resumes_from_its_checkpoint(spark, lake, topic, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    deliver(spark, topic, "1", [event(1), event(2)])
    run_to_end(messages_of(spark, topic), ingest_messages(lake), checkpoint)
    deliver(spark, topic, "2", [event(2, order_status="returned"), event(3)])
    run_to_end(messages_of(spark, topic), ingest_messages(lake), checkpoint)
    assert table(lake, "orders", "order_id", "order_status") == [("o1", "shipped"), ("o2", "shipped"), ("o3", "shipped")]


def test_repeated_micro_batch_changes_nothing(spark, lake, rows):
    batch = frame(spark, [event(1), event(2), ("bad", "{")], MESSAGE)
    run = ingest_messages(lake)
    run(batch, "s-0")
    names = ("orders", "customers", "products", "order_items", "quarantine")
    before = {n: rows(lake.read(n).drop("created_at")) for n in names}
    run(batch, "s-0")
    assert before == {n: rows(lake.read(n).drop("created_at")) for n in names}
    run(batch, "s-1")
    assert lake.read("orders").count() == lake.read("order_items").count() == 2


def test_another_checkpoint_keeps_what_is_stored(spark, lake, tmp_path):
    """A stream with a fresh checkpoint counts its micro-batches from 0 again."""
    for name, sent in (("one", [event(1), event(2)]), ("two", [event(2, order_status="returned"), event(3)])):
        deliver(spark, str(tmp_path / name), "1", sent)
        run_to_end(messages_of(spark, str(tmp_path / name)), ingest_messages(lake), str(tmp_path / f"{name}-checkpoint"))
    assert table(lake, "orders", "order_id", "order_status") == [("o1", "shipped"), ("o2", "shipped"), ("o3", "shipped")]
    assert lake.read("order_items").count() == 3


def test_two_kinds_of_stream_share_the_tables(spark, lake, topic, tmp_path):
    deliver(spark, topic, "1", [event(1), event(2), ("bad", "{")])
    run_to_end(messages_of(spark, topic), ingest_messages(lake, enriched=False), str(tmp_path / "simple"))
    deliver(spark, topic, "2", [event(3)])
    run_to_end(messages_of(spark, topic), ingest_messages(lake), str(tmp_path / "enriched"))
    assert table(lake, "order_items", "order_id", "seller_id") == [
        ("o1", "kafka-seller"), ("o2", "kafka-seller"), ("o3", "kafka-hybrid"),
    ]
    assert lake.read("quarantine").count() == 2


def test_simple_event_needs_its_fields(spark):
    sent = [event(1, quantity=...), event(2, customer=...), event(3, freight_value=...), event(4)]
    reasons = {r.key: r.reason for r in rejected(decode(frame(spark, sent, MESSAGE), enriched=False)).collect()}
    assert reasons == {"o1": "missing quantity", "o2": "missing customer.city", "o3": "missing freight_value"}


def test_an_unreadable_time_never_comes_first(spark, lake):
    sent = [event(1, buyer="c1", ts="soon"), event(2, buyer="c1"), event(3, buyer="c1", ts=...)]
    ingest_messages(lake)(frame(spark, sent, MESSAGE), "s-0")
    assert table(lake, "customers", "customer_id", "customer_city") == [("c1", "city2")]


def test_compaction_keeps_the_rows(spark, lake, rows):
    for n in range(3):
        ingest_messages(lake)(frame(spark, [event(n), ("bad", "{")], MESSAGE), f"s-{n}")
    for name in ("orders", "order_items", "quarantine"):
        lake.compact(name, "closed")
        again = lake.read(f"{name}_compacted", lake.read(name).drop("order_date").schema)
        assert rows(again.drop("order_date", "created_at")) == rows(lake.read(name).drop("order_date", "created_at"))


def test_enrichment_sees_readings_that_arrive_later(spark, lake, tmp_path):
    events = columns(order_id=STRING, city_id=INT, purchased_at=TIME)
    kept = columns(city_id=INT, fetched_at=TIME, weather_condition=STRING, humidity=INT)
    place = str(tmp_path / "readings")
    cities = frame(spark, [(1, "Oslo", "NO")], columns(city_id=INT, city=STRING, country_code=STRING))
    countries = frame(
        spark, [("NO", "Norway", "NOK", 5, "Europe")],
        columns(country_code=STRING, country_name=STRING, currency=STRING, population=LONG, region=STRING),
    )
    frame(spark, [(1, START, "Rain", 7)], kept).write.parquet(place)
    first, second = [frame(spark, [(n, 1, START + timedelta(hours=h))], events) for n, h in (("a", 0), ("b", 2))]
    schema = enrich_weather(
        enrich_country(first.join(cities, "city_id", "left"), countries), spark.read.parquet(place)
    ).schema
    each = enrich_orders(lake, lambda: cities, lambda: countries, lambda: spark.read.parquet(place), schema)
    each(first, "s-0")
    frame(spark, [(1, START + timedelta(hours=2), "Snow", 7)], kept).write.mode("append").parquet(place)
    each(second, "s-1")
    found = lake.read(TABLE, schema, "staging").select("order_id", "weather_condition").collect()
    assert dict(tuple(r) for r in found) == {"a": "Rain", "b": "Snow"}


def test_dedup_keeps_the_first_status(spark, lake, delivered, tmp_path):
    stream = messages_of(spark, delivered, max_files_per_trigger=1)
    run_to_end(orders_once(stream), append_new_orders(lake), str(tmp_path / "checkpoint"))
    assert [r[0] for r in table(lake, "orders", "order_id")] == ["o0", "o1", "o2", "o3", "o4"]
    assert dict(table(lake, "orders", "order_id", "customer_id"))["o2"] == "c2"


@pytest.mark.parametrize("files_at_once", [1, None])
def test_hourly_counts_equal_the_batch_report(spark, lake, topic, tmp_path, rows, files_at_once):
    first = [event(n, buyer=f"c{n % 3}", minutes=n * 7) for n in range(40)]
    second = [event(n, buyer=f"c{n % 5}", minutes=n * 7) for n in range(20, 60)]
    deliver(spark, topic, "1", second)
    deliver(spark, topic, "2", first)
    stream = messages_of(spark, topic, max_files_per_trigger=files_at_once)
    run_to_end(stream, ingest_messages(lake), str(tmp_path / "c1"))
    run_to_end(orders_by_hour(stream), count_hours(lake), str(tmp_path / "c2"))
    batch = hourly_order_metrics(lake.read("orders"), lake.read("order_items"), lookback=None)
    assert rows(hourly_counts(lake)) == rows(batch)


def test_watermarked_hours_drop_repeats_and_emit_closed_hours(spark, topic, tmp_path):
    deliver(spark, topic, "1", [event(n, minutes=n * 10) for n in range(12)] + [event(3, minutes=30)])
    deliver(spark, topic, "2", [event(99, minutes=600)])
    events = accepted(decode(messages_of(spark, topic, max_files_per_trigger=1))).select(
        "order_id", "purchased_at", "product.price", "quantity"
    )
    hours = hourly_windows(events, delay="1 hour")
    query = (
        hours.writeStream.format("memory").queryName("hours").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.hour: r.total_orders for r in spark.table("hours").collect()}
    assert sum(got.values()) == 12


def test_parse_reasons_and_defaults(spark):
    wrong = [
        ("k1", "not json"),
        ("k2", None),
        event(1, order_status=...),
        event(2, product=...),
        event(3, purchased_at="yesterday"),
        event(4, purchased_at=...),
    ]
    good = [event(5, weather=..., quantity=..., freight_value=...), event(6, customer=...)]
    decoded = decode(frame(spark, wrong + good, MESSAGE))
    reasons = {r.key: r.reason for r in rejected(decoded).collect()}
    assert reasons == {
        "k1": "malformed", "k2": "malformed", "o1": "missing order_status",
        "o2": "missing product.product_id", "o3": "bad purchased_at", "o4": "missing purchased_at",
    }
    events = accepted(decoded)
    item = {r.order_id: r for r in flatten_order_items(events).collect()}["o5"]
    assert (item.quantity, item.freight_value, item.seller_id) == (1, 0, "kafka-hybrid")
    order = {r.order_id: r for r in flatten_orders(events).collect()}["o5"]
    assert (order.weather_condition, order.temperature_c, order.humidity) == ("", 0, 0)


def test_encoded_events_decode_to_themselves(spark):
    events = accepted(decode(frame(spark, [event(1), event(2)], MESSAGE)))
    again = accepted(decode(encode(events)))
    assert sorted(events.collect()) == sorted(again.collect())
    assert encode(events).dtypes == [("key", "binary"), ("value", "binary")]


def test_first_currency(spark):
    df = frame(spark, [({"TRY": 1},), ({},), (None,)], "m map<string,int>")
    assert [r.c for r in df.select(first_currency(df.m).alias("c")).collect()] == ["TRY", "USD", "USD"]


@pytest.mark.parametrize("files_at_once", [1, None])
def test_stream_enrichment_equals_batch_enrichment(spark, lake, tmp_path, rows, files_at_once):
    events_schema = columns(order_id=STRING, city_id=INT, purchased_at=TIME)
    files = [
        [("a", 1, START + timedelta(seconds=10)), ("b", 2, START + timedelta(hours=5)), ("e", 9, START)],
        [("c", 1, START + timedelta(seconds=330)), ("d", 1, START + timedelta(seconds=331)), ("f", None, None)],
    ]
    for n, data in enumerate(files):
        frame(spark, data, events_schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    cities = frame(spark, [(1, "Oslo", "NO"), (2, "Rome", "IT")], columns(city_id=INT, city=STRING, country_code=STRING))
    countries = frame(
        spark, [("NO", "Norway", "NOK", 5, "Europe")],
        columns(country_code=STRING, country_name=STRING, currency=STRING, population=LONG, region=STRING),
    )
    readings = frame(
        spark, [(1, START + timedelta(seconds=30), "Rain", 7), (1, START, "Snow", 3)],
        columns(city_id=INT, fetched_at=TIME, weather_condition=STRING, humidity=INT),
    )
    all_events = spark.read.schema(events_schema).parquet(str(tmp_path / "in" / "*"))
    batch = enrich_weather(enrich_country(all_events.join(cities, "city_id", "left"), countries), readings)
    stream = folder_stream(spark, str(tmp_path / "in" / "*"), events_schema, files_at_once)
    each = enrich_orders(lake, lambda: cities, lambda: countries, lambda: readings, batch.schema)
    run_to_end(stream, each, str(tmp_path / "checkpoint"))
    assert rows(lake.read(TABLE, batch.schema, "staging")) == rows(batch)
    weather = {r.order_id: r.weather_condition for r in batch.collect()}
    # 300 seconds after the reading it is still valid, 301 seconds after it is not.
    assert weather == {"a": "Snow", "b": "Unknown", "c": "Rain", "d": "Unknown", "e": "Unknown", "f": "Unknown"}
    facts = {r.order_id: (r.country_name, r.currency, r.population) for r in batch.collect()}
    assert facts["a"] == ("Norway", "NOK", 5)
    assert facts["b"] == ("IT", "USD", 0)


def test_what_a_micro_batch_reads_does_not_grow(spark, lake, topic, tmp_path, monkeypatch):
    """The state knows the keys: no micro-batch opens a file of an earlier one."""
    opened = []
    monkeypatch.setattr(type(lake), "batches", lambda self, name, *a: opened.append(name))
    checkpoint = str(tmp_path / "checkpoint")
    inputs, states = [], []
    for n in range(4):
        deliver(spark, topic, str(n), [event(20 * n + k, buyer=f"c{n}") for k in range(20)] + [event(0, buyer="again", ts="2024-02-01T00:00:00")])
        query = start(orders_once(messages_of(spark, topic)), append_new_orders(lake), checkpoint)
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        inputs.append(sum(p["numInputRows"] for p in progress))
        states.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
    monkeypatch.undo()
    assert not opened
    assert len(set(inputs)) == 1  # the stream's own new files, the same number each time
    assert states == [20, 40, 60, 80]
    assert lake.read("orders").count() == 80
    assert not lake.read("orders").where("customer_id = 'again'").count()


def test_of_copies_in_one_micro_batch_the_first_sent_is_new(spark, lake, topic, tmp_path):
    deliver(spark, topic, "1", [event(1, buyer="late", ts="2024-01-03T00:00:00"), event(1, buyer="first"), event(2, ts="soon")])
    run_to_end(orders_once(messages_of(spark, topic)), append_new_orders(lake), str(tmp_path / "checkpoint"))
    assert table(lake, "orders", "order_id", "customer_id") == [("o1", "first"), ("o2", "c1")]


@pytest.mark.parametrize("shape", [orders_once, orders_by_hour, feed_events])
def test_a_micro_batch_is_parsed_once(spark, tmp_path, shape):
    """Rows and markers come from one shuffle."""
    deliver(spark, tmp_path / "topic", "a", [event(1), event(2), event(2)])
    query = start(shape(folder_stream(spark, f"{tmp_path}/topic/*")), lambda df, _: df.count(), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert "ReusedExchange" in query._jsq.explainInternal(False)


def test_events_are_dealt_out_before_messages_are_made(spark, tmp_path, plan):
    events = [(n, START + timedelta(minutes=n), n, "view", 1.5, '{"k": 3}') for n in range(50)]
    spark.createDataFrame(events, EVENT_ROWS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    shop = Shop(spark, str(tmp_path))
    assert "REBALANCE_PARTITIONS" in plan(shop.wire_messages()) and shop.wire_messages().count() == 51  # one is sent twice
    assert "Repartition" in shop.message_stream()._jdf.queryExecution().analyzed().toString()
