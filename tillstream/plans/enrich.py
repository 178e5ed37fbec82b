"""Enrichment of order events with country facts and weather readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.asof import latest_within
from tillstream.schemas import (
    COUNTRY_DEFAULT_CURRENCY,
    WEATHER_DEFAULTS,
    WEATHER_VALID_SECONDS,
)

# A lookup table is broadcast up to this many rows; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


def small_or_plain(lookup: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """lookup with a broadcast hint if it has at most `limit` rows."""
    return F.broadcast(lookup) if lookup.count() <= limit else lookup


def enrich_country(events: DataFrame, countries: DataFrame) -> DataFrame:
    """Add country_name, currency, population and region by country_code.

    A country that is not found is named by its code, with default values.
    """
    facts = countries.select("country_code", "country_name", "currency", "population", "region")
    return events.join(small_or_plain(facts), "country_code", "left").withColumns(
        {
            "country_name": F.coalesce("country_name", "country_code"),
            "currency": F.coalesce("currency", F.lit(COUNTRY_DEFAULT_CURRENCY)),
            "population": F.coalesce("population", F.lit(0)).cast("bigint"),
            "region": F.coalesce("region", F.lit("")),
        }
    )


def enrich_weather(
    events: DataFrame,
    readings: DataFrame,
    key: str = "city_id",
    event_ts: str = "purchased_at",
    reading_ts: str = "fetched_at",
    valid_seconds: int = WEATHER_VALID_SECONDS,
) -> DataFrame:
    """Add the newest weather reading of the event's city, if it is still valid.

    Without one, the event carries the defaults of a failed lookup.
    """
    found = latest_within(events, readings, key, event_ts, reading_ts, valid_seconds)
    present = set(readings.columns)
    added = {
        name: F.coalesce(
            F.col("reading")[name], F.lit(default).cast(readings.schema[name].dataType)
        )
        for name, default in WEATHER_DEFAULTS.items()
        if name in present
    }
    return found.withColumns(added).drop("reading")
