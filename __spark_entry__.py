"""Entry points: the flagship query, all queries, and their SQL oracles."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles  # noqa: E402
from tillstream.functions.clock import as_of_column  # noqa: E402
from tillstream.functions.money import freight, line_revenue  # noqa: E402
from tillstream.operators.evolve import ensure_columns  # noqa: E402
from tillstream.operators.key_index import KeyIndex  # noqa: E402
from tillstream.operators.keyed import insert_if_absent, missing_parent  # noqa: E402
from tillstream.operators.revenue import order_item_totals  # noqa: E402
from tillstream.operators.sampling import sample_ids  # noqa: E402
from tillstream.plans import checked, enrich, incremental, ingest, marts, pipeline, placed, quality, reports  # noqa: E402
from tillstream.plans.staging import stg_orders  # noqa: E402
from tillstream.schemas import (  # noqa: E402
    CUSTOMER_COUNTRY_COLUMNS,
    INT,
    LONG,
    ORDER_WEATHER_COLUMNS,
    READING,
    STRING,
    TIME,
    columns,
)
from tillstream.session import work_area  # noqa: E402
from tillstream.sources import evolving, folder_log  # noqa: E402
from tillstream.sources.commits import CommittedLake  # noqa: E402
from tillstream.sources.order_topic import accepted, decode, encode, folder_stream, rejected  # noqa: E402
from tillstream.sources.shaped import (  # noqa: E402
    EVENTS_NOW,
    RETAIL_NOW,
    Shop,
    numbered_messages_from,
    order_events_from,
    weather_readings_from,
)
from tillstream.sources.tables import Lake  # noqa: E402
from tillstream.streaming import asof as stream_asof  # noqa: E402
from tillstream.streaming import enrich as stream_enrich  # noqa: E402
from tillstream.streaming import feed, hourly, ingest as stream_ingest  # noqa: E402
from tillstream.streaming.jobs import EachBatch, run_to_end  # noqa: E402

try:  # the training-data operators and their pipeline can be left out
    import corpus_pipeline  # noqa: E402
    from tillstream.llm import queries as llm_queries  # noqa: E402
except ImportError as error:  # another missing module is a fault
    if not (error.name or "").startswith(("corpus_pipeline", "tillstream.llm")):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]
SEED = "42"
RECEIVED = columns(key=STRING, value=STRING, partition=INT, offset=LONG)


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as bigints, as the oracles return them."""

    def column(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*[column(name, kind) for name, kind in df.dtypes])


def _over_shop(plan: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, folder: _comparable(plan(Shop(spark, folder)))


# Marts and reports.


def _stg(shop: Shop) -> DataFrame:
    return stg_orders(shop.orders())


def _mart(shop: Shop) -> DataFrame:
    return marts.mart_order_metrics(_stg(shop), shop.order_items())


def _spark_mart(shop: Shop) -> DataFrame:
    return marts.spark_order_metrics(shop.orders(), shop.order_items())


def _hourly(shop: Shop) -> DataFrame:
    return reports.hourly_order_metrics(shop.orders(), shop.order_items(), RETAIL_NOW)


def _city(shop: Shop) -> DataFrame:
    return reports.city_order_metrics(
        shop.customers(), shop.orders(), shop.order_items(), RETAIL_NOW
    )


def _feed(shop: Shop) -> DataFrame:
    return reports.live_order_feed(
        shop.orders(), shop.customers(), shop.order_items(), RETAIL_NOW, lookback="7 days"
    )


# Quality.


def _dq(only: list[str] | None = None) -> Callable[[Shop], DataFrame]:
    return lambda shop: quality.run_checks(shop.dirty(), RETAIL_NOW, only)


def _dq_log(shop: Shop) -> DataFrame:
    """Two runs: the clean tables, and ten minutes later the dirty ones."""
    clean = quality.logged(
        quality.run_checks(shop.raw(), RETAIL_NOW), "2001-08-01 23:45:00", "clean"
    )
    dirty = quality.logged(
        quality.run_checks(shop.dirty(), RETAIL_NOW), "2001-08-01 23:55:00", "dirty"
    )
    return clean.unionByName(dirty)


def _duplicates(shop: Shop) -> DataFrame:
    found = None
    for table, df, key in (
        ("orders", shop.dirty_orders(), "order_id"),
        ("customers", shop.dirty_customers(), "customer_id"),
        ("products", shop.dirty_products(), "product_id"),
    ):
        part = quality.duplicate_keys(df, key).select(
            F.lit(table).alias("table_name"), F.col(key).alias("key"), "copies"
        )
        found = part if found is None else found.unionByName(part)
    return found


def _orphans(shop: Shop) -> DataFrame:
    keys = missing_parent(shop.dirty_order_items(), shop.dirty_orders(), "order_id")
    return keys.where("missing").select("order_id", F.col("rows").alias("items"))


def _schema_tests(shop: Shop) -> DataFrame:
    tables = shop.dirty()
    staged = stg_orders(tables["orders"])
    mart = marts.mart_order_metrics(staged, tables["order_items"])
    return quality.schema_tests({**tables, "stg_orders": staged, "mart_order_metrics": mart})


# Ingest.


def _events(shop: Shop) -> DataFrame:
    return accepted(decode(shop.wire_messages()))


def _loaded() -> Column:
    return as_of_column(RETAIL_NOW).alias("sent")


def _insert_customers(shop: Shop) -> DataFrame:
    """Customers of the shop and of the event messages into a table that lost some."""
    columns = ["customer_id", "customer_city", "customer_state"]
    old = shop.customers().select(*columns, _loaded())
    new = _events(shop).select(*ingest.customer_columns(), F.col("ts").alias("sent"))
    incoming = old.unionByName(new.select(*columns, "sent"))
    fresh = insert_if_absent(shop.dirty_customers(), incoming, "customer_id", ["sent"])
    return fresh.drop("sent")


def _insert_products(shop: Shop) -> DataFrame:
    columns = ["product_id", "category_name", "product_price"]
    old = shop.products().select(*columns, _loaded())
    new = _events(shop).select(*ingest.product_columns(), F.col("ts").alias("sent"))
    incoming = old.unionByName(new.select(*columns, "sent"))
    fresh = insert_if_absent(shop.dirty_products(), incoming, "product_id", ["sent"])
    return fresh.drop("sent")


def _insert_orders(shop: Shop) -> DataFrame:
    columns = ["order_id", "customer_id", "order_status", "order_purchase_ts"]
    new = ingest.flatten_orders(_events(shop)).select(*columns)
    incoming = shop.orders().select(*columns).unionByName(new)
    return insert_if_absent(shop.dirty_orders(), incoming, "order_id")


def _append_items(shop: Shop) -> DataFrame:
    return shop.order_items().unionByName(ingest.flatten_order_items(_events(shop)))


def _parsed(shop: Shop) -> DataFrame:
    return _events(shop).select(
        "order_id", "customer_id", "order_status", "product.product_id", "product.category_name",
        "product.price", "quantity", "freight_value", "customer.city", "customer.country_code",
        "weather.weather_condition", "weather.temperature_c", "purchased_at", "ts",
    )


def _simple_events(shop: Shop) -> DataFrame:
    columns = {}
    for group in (
        ingest.order_columns(False),
        ingest.customer_columns(False),
        ingest.product_columns(),
        ingest.order_item_columns(False),
    ):
        for name, column in zip(_events(shop).select(*group).columns, group, strict=True):
            columns.setdefault(name, column)
    columns.pop("price")
    return _events(shop).select(*columns.values())


def _freight(shop: Shop) -> DataFrame:
    return shop.order_items().select(
        "order_id", "product_id", "quantity", "price",
        freight(F.col("price")).alias("freight_value"), line_revenue().alias("line_revenue"),
    )


def _samples(shop: Shop) -> DataFrame:
    customers = sample_ids(shop.customers(), "customer_id", 200, SEED)
    products = sample_ids(shop.products(), "product_id", 100, SEED)
    return customers.select(F.lit("customers").alias("source"), F.col("customer_id").alias("id")).unionByName(
        products.select(F.lit("products").alias("source"), F.col("product_id").alias("id"))
    )


def _currency(shop: Shop) -> DataFrame:
    payload = F.from_json("props", "map<string,int>")
    return shop.table("events").select("event_id", ingest.first_currency(payload).alias("currency"))


def _published(shop: Shop) -> DataFrame:
    events = shop.wire_events().drop("event_id", "customer", "weather")
    return encode(events).select(F.col("key").cast("string"), F.col("value").cast("string"))


# Enrichment.

COUNTRY = ["city", "country_code", "country_name", "currency", "population", "region"]
WEATHER = [
    "weather_condition", "weather_desc", "temperature_c", "feels_like_c", "humidity", "wind_speed",
]


def _country(shop: Shop) -> DataFrame:
    placed = shop.order_events().join(F.broadcast(shop.cities()), "city_id", "left")
    return enrich.enrich_country(placed, shop.countries()).select("order_id", *COUNTRY)


def _weather(valid_seconds: int) -> Callable[[Shop], DataFrame]:
    def plan(shop: Shop) -> DataFrame:
        events = shop.order_events().select("order_id", "city_id", "purchased_at")
        return enrich.enrich_weather(events, shop.weather_readings(), valid_seconds=valid_seconds)

    return plan


# Streams: each runs to the end of what is there, then its tables are read.


def _lake(spark: SparkSession, name: str) -> tuple[Lake, str]:
    area = work_area(spark, name)
    return Lake(spark, f"{area}/tables"), f"{area}/checkpoint"


def _in_parts(shop: Shop, each_batch: EachBatch, checkpoint: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """The messages as four micro-batches; an event that is sent twice comes in two of them."""
    for stream in shop.deliver_messages(work_area(shop.spark, "topic")):
        run_to_end(shape(stream) if shape else stream, each_batch, checkpoint)


def _stream_ingest(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "ingest")
    run_to_end(shop.message_stream(), stream_ingest.ingest_messages(lake, enriched=False), checkpoint)
    return _four_tables(lake)


def _four_tables(lake: Lake) -> DataFrame:
    orders = lake.read("orders").select("order_id", "customer_id", "order_status", "order_purchase_ts")
    items = lake.read("order_items").drop("created_at")
    customers = lake.read("customers").select("customer_id", "customer_city", "customer_zip")
    products = lake.read("products").select("product_id", "category_name", "product_price")
    return (
        orders.join(items, "order_id").join(customers, "customer_id").join(products, "product_id")
    )


def _stream_enriched(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "enriched")
    _in_parts(shop, stream_ingest.ingest_messages(lake), checkpoint)
    orders = lake.read("orders").select(
        "order_id", "customer_id", "order_status", "order_purchase_ts", "weather_condition", "temperature_c"
    )
    items = lake.read("order_items").select("order_id", "product_id", "seller_id", "quantity", "price")
    customers = lake.read("customers").select("customer_id", "customer_city", "country_name", "population")
    products = lake.read("products").select("product_id", "category_name")
    return orders.join(items, "order_id").join(customers, "customer_id").join(products, "product_id")


def _stream_dedup(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "dedup")
    _in_parts(shop, stream_ingest.append_new_orders(lake), checkpoint, stream_ingest.orders_once)
    return lake.read("orders").select(
        "order_id", "customer_id", "order_status", "order_purchase_ts", "weather_condition",
        "weather_desc", "temperature_c", "humidity", "wind_speed",
    )


def _stream_hourly(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "hourly")
    _in_parts(shop, hourly.count_hours(lake), checkpoint, hourly.orders_by_hour)
    return hourly.hourly_counts(lake)


def _stream_windows(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "windows")
    hours = hourly.hourly_windows(order_events_from(shop.event_stream()), delay=None)
    run_to_end(hours, hourly.keep_latest_result(lake, "hours"), checkpoint, "complete")
    return lake.rebuilt("marts", "hours")


def _stream_enrich(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "enrich")
    events = order_events_from(shop.event_stream()).select("order_id", "city_id", "purchased_at")
    lookups = shop.cities, shop.countries, shop.weather_readings
    columns = ["order_id", "city_id", "purchased_at", *COUNTRY, *WEATHER]
    one = enrich.enrich_weather(
        enrich.enrich_country(
            shop.order_events().join(F.broadcast(shop.cities()), "city_id", "left"), shop.countries()
        ),
        shop.weather_readings(),
    )
    schema = one.select(*columns).schema
    run_to_end(events, stream_enrich.enrich_orders(lake, *lookups, schema), checkpoint)
    return lake.read(stream_enrich.TABLE, schema, "staging")


def _stream_reject(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "reject")
    run_to_end(shop.message_stream(), stream_ingest.quarantine_messages(lake), checkpoint)
    return lake.read("quarantine").select("key", "reason")


def _pipeline(shop: Shop) -> DataFrame:
    """The shop's tables as history, then a daily run that adds the orders of events."""
    # Months, as the history goes back years and arrives as one batch.
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'pipeline')}/tables", order_period="month")
    pipeline.ingest_batch(lake, shop.raw(), "history")
    events = shop.spread_events().withColumn(
        "purchased_at", F.col("purchased_at").cast("timestamp_ntz")
    )
    incoming = {
        "customers": ingest.flatten_customers(events),
        "products": ingest.flatten_products(events),
        "orders": ingest.flatten_orders(events),
        "order_items": ingest.flatten_order_items(events),
    }
    # A day none of whose orders has items is a row without revenue.  On small data there are
    # such days; they are reported, and whatever else fails a test stops the run.
    return pipeline.run_pipeline(lake, incoming, "daily", EVENTS_NOW, itemless_days=True)


def _atomic(shop: Shop) -> DataFrame:
    """As _stream_ingest over four micro-batches that become visible as a whole; one that
    was cut off between its tables leaves rows that no reader sees."""
    area = work_area(shop.spark, "atomic")
    lake = CommittedLake(shop.spark, f"{area}/tables")
    indexes = {n: KeyIndex(shop.spark, f"{area}/keys/{n}", buckets=8) for n in pipeline.RAW}
    cut_off = accepted(decode(shop.wire_messages())).select(*ingest.customer_columns(False))
    lake.write_batch(cut_off.withColumn("customer_city", F.lit("nowhere")), "customers", "cut-off")
    _in_parts(shop, stream_ingest.ingest_atomically(lake, indexes, enriched=False), f"{area}/checkpoint")
    return _four_tables(lake)


def _by_index(shop: Shop) -> DataFrame:
    """Orders that are new to a table whose keys an index holds."""
    columns = ["order_id", "customer_id", "order_status", "order_purchase_ts"]
    area = work_area(shop.spark, "index")
    index = KeyIndex(shop.spark, f"{area}/orders", buckets=16)
    index.add(shop.dirty_orders(), "order_id", "history")
    new = ingest.flatten_orders(_events(shop)).select(*columns)
    # The batch lies in files, as it is read several times; messages are parsed once.
    shop.orders().select(*columns).unionByName(new).write.parquet(f"{area}/incoming")
    incoming = shop.spark.read.parquet(f"{area}/incoming")
    return index.new_rows(incoming, "order_id", rows=incoming.count()).select(*columns)


def _mart_incremental(shop: Shop) -> DataFrame:
    """The mart of the shop's history, refreshed after a batch of events, after items that
    came late for old orders, and after a batch that was written again."""
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'incremental')}/tables", order_period="month")
    raw = shop.raw()
    late = F.xxhash64("order_id") % 97 == 0
    pipeline.ingest_batch(lake, {"orders": raw["orders"], "order_items": raw["order_items"].where(~late)}, "history")
    incremental.refresh_mart(lake)
    events = shop.wire_events().withColumn("purchased_at", F.col("purchased_at").cast("timestamp_ntz"))
    orders, items = ingest.flatten_orders(events), ingest.flatten_order_items(events)
    pipeline.ingest_batch(lake, {"orders": orders, "order_items": items.where("quantity > 3")}, "events")
    incremental.refresh_mart(lake, ["events"])
    pipeline.ingest_batch(lake, {"order_items": raw["order_items"].where(late)}, "late")
    pipeline.ingest_batch(lake, {"orders": orders, "order_items": items}, "events")
    incremental.refresh_mart(lake, ["late", "events"])
    return incremental.mart_by_period(lake)


def _customers_bitmap(shop: Shop) -> DataFrame:
    """Customers per hour and per day, merged from the bitmaps of four micro-batches."""
    lake, checkpoint = _lake(shop.spark, "bitmaps")
    _in_parts(shop, hourly.count_customers(lake), checkpoint, hourly.orders_by_hour)
    return hourly.customers_by_hour(lake).unionByName(hourly.customers_by_day(lake))


def _stream_feed(shop: Shop) -> DataFrame:
    lake, checkpoint = _lake(shop.spark, "feed")
    _in_parts(shop, feed.keep_feed(lake), checkpoint, feed.feed_events)
    return feed.live_feed(lake, EVENTS_NOW, "1 day")


def _stream_asof(shop: Shop) -> DataFrame:
    """Order events and readings as two streams; the batch join of all gives the same."""
    lake, checkpoint = _lake(shop.spark, "asof")
    schema = columns(
        order_id=STRING, city_id=INT, purchased_at=TIME, weather_condition=STRING, weather_desc=STRING,
        temperature_c=READING, feels_like_c=READING, humidity=INT, wind_speed=READING,
    )
    for rows in shop.deliver_events(work_area(shop.spark, "events")):
        placed = order_events_from(rows)
        joined = stream_asof.enrich_from_stream(placed, weather_readings_from(rows), ["order_id"], salts=4)
        run_to_end(joined, lambda df, batch: lake.write_batch(df, "asof", batch, schema, "staging"), checkpoint)
    return lake.read("asof", schema, "staging").where("order_id <> 'E-1'")


def _stream_latest(shop: Shop) -> DataFrame:
    """A stream that starts at the end of a log, stops, and goes on: what came before it
    began is not read, what came while it was stopped is."""
    lake, checkpoint = _lake(shop.spark, "latest")
    log = f"{work_area(shop.spark, 'log')}/topic"
    numbered = numbered_messages_from(shop.spread_events())

    def run() -> None:
        messages = folder_log.log_stream(shop.spark, log, "latest", f"{checkpoint}/start")
        run_to_end(messages, lambda df, batch: lake.write_batch(df, "received", batch, RECEIVED, "staging"), checkpoint)

    edges = ["2024-01-16", "2024-01-24", "9999"]
    for k, edge in enumerate(edges):
        part = numbered.where((F.col("sent") < edge) & (F.col("sent") >= (edges[k - 1] if k else "")))
        folder_log.append(part, log, partitions=4, order="sent")
        run()
    received = lake.read("received", RECEIVED, "staging")
    # Each message once, at an offset of its own.
    whole = received.groupBy("partition", "offset").agg(F.any_value("value").alias("value"), F.any_value("key").alias("key"))
    return accepted(decode(whole)).select("order_id", "customer_id", "order_status", "purchased_at")


def _placed(shop: Shop) -> Lake:
    """The shop's orders and items, both laid out by the order's month."""
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'placed')}/tables", order_period="month")
    # The batch as it comes, without a search for known keys: what is tested is the layout.
    lake.write_batch(shop.orders(), "orders", "history")
    placed.place_items(lake, shop.order_items(), "history")
    return lake


def _hourly_placed(shop: Shop) -> DataFrame:
    lake = _placed(shop)
    return reports.hourly_order_metrics(lake.read("orders"), lake.read("placed_items"), RETAIL_NOW)


def _city_placed(shop: Shop) -> DataFrame:
    lake = _placed(shop)
    return reports.city_order_metrics(shop.customers(), lake.read("orders"), lake.read("placed_items"), RETAIL_NOW)


def _evolve_stored(shop: Shop) -> DataFrame:
    """Events that gain fields, and fields that gain digits, between micro-batches."""
    area = work_area(shop.spark, "evolving")
    events = shop.wire_events()
    day = F.dayofmonth(F.col("ts").cast("timestamp_ntz"))
    plain = [F.col("order_id"), F.col("customer_id"), F.col("quantity")]
    warm = F.col("weather.temperature_c")
    shapes = {
        0: plain,
        1: [*plain, F.col("weather.weather_condition"), F.floor(warm).cast("int").alias("temperature_c")],
        2: [*plain, F.col("weather.weather_condition"), warm.alias("temperature_c"), F.col("customer.country_code")],
    }
    table = evolving.EvolvingTable(shop.spark, f"{area}/table")
    for k, shape in shapes.items():
        part = events.where(F.least(F.floor((day - 1) / 11), F.lit(2)) == k)
        messages = part.select(F.col("order_id").alias("key"), F.to_json(F.struct(*shape)).alias("value"))
        messages.write.parquet(f"{area}/topic/{k}")
        run_to_end(folder_stream(shop.spark, f"{area}/topic/*"), evolving.store_as_they_come(table), f"{area}/checkpoint")
    return table.read()


def _dq_on_write(shop: Shop) -> DataFrame:
    """The dirty tables in three batches each, checked as they are written."""
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'checked')}/tables", order_period="month")
    for name, df in shop.dirty().items():
        part = F.pmod(F.xxhash64(*df.columns), F.lit(3))
        for k in range(3):
            checked.write_checked(lake, df.where(part == k), name, f"part-{k}", RETAIL_NOW)
    return checked.counted_checks(lake)


def _spark_metrics(shop: Shop) -> DataFrame:
    """The second mart as its job writes it."""
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'metrics')}/tables", order_period="month")
    pipeline.ingest_batch(lake, {n: shop.raw()[n] for n in ("orders", "order_items")}, "history")
    return pipeline.run_spark_metrics(lake)


def _reject_rows(shop: Shop) -> DataFrame:
    """Rows of the dirty tables that a batch load cannot store."""
    lake = Lake(shop.spark, f"{work_area(shop.spark, 'rejects')}/tables", order_period="month")
    pipeline.ingest_batch(lake, {n: shop.dirty()[n] for n in pipeline.KEYS}, "dirty")
    return lake.read("quarantine").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def entry(spark: SparkSession) -> DataFrame:
    return _over_shop(_mart)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    plans: dict[str, Callable[[Shop], DataFrame]] = {
        "stg_orders": _stg,
        "order_item_agg": lambda shop: order_item_totals(shop.order_items()),
        "mart_order_metrics": _mart,
        "spark_order_metrics": _spark_mart,
        "hourly_order_metrics": _hourly,
        "weather_order_metrics": lambda shop: reports.weather_order_metrics(shop.orders(), RETAIL_NOW),
        "city_order_metrics": _city,
        "live_order_feed": _feed,
        "daily_metrics_recent": lambda shop: reports.daily_metrics_recent(_mart(shop)),
        "kpi_latest": lambda shop: reports.kpi_latest(_mart(shop)),
        "revenue_trend_30d": lambda shop: reports.revenue_trend(_mart(shop), 30),
        "dq_latest_results": lambda shop: reports.dq_latest_results(_dq_log(shop)),
        "dq_orders": _dq(["orders"]),
        "dq_customers": _dq(["customers"]),
        "dq_products": _dq(["products"]),
        "dq_order_items": _dq(["order_items"]),
        "dq_results": _dq(),
        "dq_results_single_table": _dq(["orders", "no_such_table"]),
        "dq_summary": lambda shop: quality.summary(_dq()(shop)),
        "dq_gate": lambda shop: quality.gate(_dq_log(shop), RETAIL_NOW),
        "duplicate_keys": _duplicates,
        "orphan_order_items": _orphans,
        "schema_tests": _schema_tests,
        "insert_new_customers": _insert_customers,
        "insert_new_products": _insert_products,
        "insert_new_orders": _insert_orders,
        "append_order_items": _append_items,
        "parse_order_events": _parsed,
        "flatten_orders": lambda shop: ingest.flatten_orders(_events(shop)),
        "flatten_customers": lambda shop: ingest.flatten_customers(_events(shop)),
        "flatten_products": lambda shop: ingest.flatten_products(_events(shop)),
        "flatten_order_items": lambda shop: ingest.flatten_order_items(_events(shop)),
        "flatten_simple_events": _simple_events,
        "ensure_order_columns": lambda shop: ensure_columns(
            shop.orders().select("order_id", "weather_condition"), ORDER_WEATHER_COLUMNS
        ),
        "ensure_columns": lambda shop: ensure_columns(shop.customers(), CUSTOMER_COUNTRY_COLUMNS),
        "derive_freight": _freight,
        "sample_ids": _samples,
        "country_currency": _currency,
        "publish_order_events": _published,
        "enrich_country": _country,
        "enrich_weather_asof": _weather(300),
        "enrich_weather_asof_6h": _weather(6 * 3600),
        "stream_ingest_orders": _stream_ingest,
        "stream_ingest_enriched": _stream_enriched,
        "stream_dedup_orders": _stream_dedup,
        "stream_hourly_orders": _stream_hourly,
        "stream_hourly_windows": _stream_windows,
        "stream_enrich_orders": _stream_enrich,
        "reject_malformed_events": _stream_reject,
        "reject_batch_rows": _reject_rows,
        "stream_ingest_atomic": _atomic,
        "insert_orders_by_index": _by_index,
        "mart_incremental": _mart_incremental,
        "hourly_customers_bitmap": _customers_bitmap,
        "stream_live_feed": _stream_feed,
        "dq_on_write": _dq_on_write,
        "stream_asof_weather": _stream_asof,
        "stream_from_latest": _stream_latest,
        "hourly_order_metrics_placed": _hourly_placed,
        "city_order_metrics_placed": _city_placed,
        "evolve_stored_tables": _evolve_stored,
        "write_spark_metrics": _spark_metrics,
        "pipeline_daily": _pipeline,
    }
    found = {name: _over_shop(plan) for name, plan in plans.items()}
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    if llm_queries:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
