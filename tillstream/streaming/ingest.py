"""Order messages to the raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.key_index import KeyIndex
from tillstream.operators.keyed import insert_if_absent
from tillstream.plans.ingest import (
    customer_columns,
    order_columns,
    order_item_columns,
    product_columns,
)
from tillstream.sources.commits import CommittedLake
from tillstream.sources.order_topic import accepted, decode, rejected
from tillstream.sources.tables import Lake, side_by_side
from tillstream.streaming.fresh import held, new_rows, with_new_keys
from tillstream.streaming.jobs import EachBatch


def ingest_messages(lake: Lake, enriched: bool = True) -> EachBatch:
    """Store messages in the four raw tables.

    Customers, products and orders are inserted if absent: the first write of a key
    wins, within a micro-batch the event sent first.  An event carries one item, so an
    order_id that has its item already is a redelivery and adds none.  Messages that
    cannot be stored go to quarantine.

    Streams may take turns on the same tables.  Two that run at once do not overwrite
    each other, but a key that is new to both is stored by both: give the keyed tables
    one writing stream at a time.
    """
    targets = [
        ("customers", "customer_id", customer_columns(enriched)),
        ("products", "product_id", product_columns()),
        ("orders", "order_id", order_columns(enriched)),
        ("order_items", "order_id", order_item_columns(enriched)),
    ]

    def each_batch(messages: DataFrame, batch: str) -> None:
        decoded = decode(messages, enriched).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = accepted(decoded)
            rows = events.count()

            def store(table: str, key: str, columns: list[Column]) -> None:
                incoming = events.select(*columns, F.col("ts").alias("_sent"))
                known = lake.other_batches(table, batch)
                fresh = insert_if_absent(known, incoming, key, ["_sent"], rows)
                lake.write_batch(fresh.drop("_sent"), table, batch)

            writes = [partial(store, *target) for target in targets]
            writes.append(lambda: lake.write_batch(rejected(decoded), "quarantine", batch))
            side_by_side(lake.spark, writes)
        finally:
            decoded.unpersist()

    return each_batch


def ingest_atomically(lake: CommittedLake, indexes: Mapping[str, KeyIndex], enriched: bool = True) -> EachBatch:
    """As ingest_messages, with a micro-batch visible in all tables or in none.

    Which keys are new the indexes say, so no table is scanned; there is one of the keys of
    each table (of order_items, order_id).  A key counts as known once its micro-batch
    has been committed, as an index may hold keys of a batch that died.
    """
    targets = {
        "customers": ("customer_id", customer_columns(enriched)),
        "products": ("product_id", product_columns()),
        "orders": ("order_id", order_columns(enriched)),
        "order_items": ("order_id", order_item_columns(enriched)),
    }

    def each_batch(messages: DataFrame, batch: str) -> None:
        decoded = decode(messages, enriched).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = accepted(decoded)
            rows = events.count()
            done = lake.commits()

            def store(table: str) -> None:
                key, columns = targets[table]
                incoming = events.select(*columns, F.col("ts").alias("_sent"))
                fresh = indexes[table].new_rows(incoming, key, ["_sent"], batch, rows, done).drop("_sent")
                fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
                try:
                    indexes[table].add(fresh, key, batch)
                    lake.write_batch(fresh, table, batch)
                finally:
                    fresh.unpersist()

            writes = [partial(store, table) for table in targets]
            writes.append(lambda: lake.write_batch(rejected(decoded), "quarantine", batch))
            lake.all_or_nothing(batch, writes)
        finally:
            decoded.unpersist()

    return each_batch


def orders_once(messages: DataFrame, enriched: bool = True) -> DataFrame:
    """A stream of messages as orders, and markers of the order_ids it has not carried before."""
    events = accepted(decode(messages, enriched))
    orders = events.select(*order_columns(enriched), F.col("ts").alias("sent"))
    return with_new_keys(orders, {"order": F.col("order_id")})


def append_new_orders(lake: Lake) -> EachBatch:
    """Store the orders of orders_once alone, each order_id once.

    The stream's state says which are new, so the table is not read, whatever its size.
    For a table that this stream alone writes; ingest_messages shares tables.
    """

    def each_batch(orders: DataFrame, batch: str) -> None:
        with held(orders) as kept:
            lake.write_batch(new_rows(kept, "order", "order_id", ["sent"]).drop("sent"), "orders", batch)

    return each_batch


def quarantine_messages(lake: Lake, enriched: bool = True) -> EachBatch:
    """Keep the messages that cannot be stored, with the reason."""

    def each_batch(messages: DataFrame, batch: str) -> None:
        lake.write_batch(rejected(decode(messages, enriched)), "quarantine", batch)

    return each_batch
