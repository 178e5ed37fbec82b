"""Stream enrichment against lookup tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.clock import as_of_column
from tillstream.plans.enrich import enrich_country, enrich_weather, small_or_plain
from tillstream.schemas import WEATHER_VALID_SECONDS
from tillstream.sources.tables import Lake
from tillstream.streaming.jobs import EachBatch

# Reads a lookup table as it is now.
Lookup = Callable[[], DataFrame]

TABLE = "enriched_orders"


def enrich_orders(
    lake: Lake,
    cities: Lookup,
    countries: Lookup,
    readings: Lookup,
    schema: T.StructType,
    valid_seconds: int = WEATHER_VALID_SECONDS,
) -> EachBatch:
    """Add city, country facts and weather to order events of a micro-batch.

    The lookups are functions: each micro-batch reads them anew, so rows that arrived
    meanwhile are used (a DataFrame would keep the files it was made with).  A join
    of two streams would hold back unmatched events and drop late ones.  Of the
    readings only those are read that can be valid for some event of the micro-batch.
    """

    def each_batch(events: DataFrame, batch: str) -> None:
        events = events.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            span = events.agg(F.min("purchased_at").alias("first"), F.max("purchased_at").alias("last"))
            first, last = span.first()
            usable = readings()
            if first is not None:
                oldest = as_of_column(first - timedelta(seconds=valid_seconds))
                usable = usable.where(F.col("fetched_at").between(oldest, as_of_column(last)))
            located = events.join(small_or_plain(cities()), "city_id", "left")
            placed = enrich_country(located, countries())
            full = enrich_weather(placed, usable, valid_seconds=valid_seconds)
            lake.write_batch(full, TABLE, batch, schema, "staging")
        finally:
            events.unpersist()

    return each_batch
