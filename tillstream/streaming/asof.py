"""As-of join of two streams: each event with the latest reading of its place.

Time is cut into slots as long as a reading is valid.  An event lies in one slot; a reading
can serve its own slot and the next, so it goes to both.  All that can meet has the same
place and slot, which is the key of a grouping whose state Spark closes once the watermark
has passed the slot's end: then every reading that can count is there.  State is what
lies in slots not yet closed, whatever one place's share of the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.schemas import WEATHER_DEFAULTS, WEATHER_VALID_SECONDS
from tillstream.streaming.fresh import keep_state_on_disk


def enrich_from_stream(
    events: DataFrame,
    readings: DataFrame,
    event_columns: Sequence[str],
    delay: str = "2 hours",
    valid_seconds: int = WEATHER_VALID_SECONDS,
    salts: int = 1,
) -> DataFrame:
    """event_columns, city_id, purchased_at and the weather at that time, for append mode.

    events has city_id and purchased_at, readings has city_id, fetched_at and the weather
    columns.  A reading counts from its instant for valid_seconds, both ends included;
    without one an event gets the defaults.  Of several at one instant the largest
    counts.  A row that comes more than `delay` after later ones is too late: its slot
    may be closed.  Events without a time are left out, those without a place get the
    defaults.  A place with very many events in a slot is split into `salts` groups,
    each with a copy of the slot's readings.
    """
    keep_state_on_disk(events.sparkSession)
    weather = [c for c in readings.columns if c not in ("city_id", "fetched_at")]
    kinds = dict(readings.dtypes)
    known = dict(events.dtypes)
    reading = F.struct("fetched_at", *weather)
    empty_reading = F.lit(None).cast(f"struct<fetched_at:timestamp_ntz,{','.join(f'{c}:{kinds[c]}' for c in weather)}>")
    event = F.struct("purchased_at", *event_columns)
    empty_event = F.lit(None).cast(f"struct<purchased_at:timestamp_ntz,{','.join(f'{c}:{known[c]}' for c in event_columns)}>")
    seconds = f"{valid_seconds} seconds"

    def at(column: str) -> Column:
        return F.col(column).cast("timestamp")

    salt = F.pmod(F.xxhash64(event), F.lit(salts)).cast("int")
    own = events.select(
        "city_id", salt.alias("salt"), at("purchased_at").alias("at"), event.alias("event"), empty_reading.alias("reading")
    )
    twice = F.array(at("fetched_at"), at("fetched_at") + F.expr(f"INTERVAL {seconds}"))
    copies = readings.where("city_id is not null").withColumn("at", F.explode(twice))
    both = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "city_id", "salt", "at", empty_event.alias("event"), reading.alias("reading")
    )
    merged = own.unionByName(both).withWatermark("at", delay)
    met = merged.groupBy("city_id", "salt", F.window("at", seconds).alias("slot")).agg(
        F.collect_list("event").alias("events"), F.collect_list("reading").alias("readings")
    )
    each = met.select("city_id", F.explode("events").alias("event"), "readings")
    oldest = F.col("event.purchased_at") - F.expr(f"INTERVAL {seconds}")
    usable = F.filter("readings", lambda r: (r["fetched_at"] <= F.col("event.purchased_at")) & (r["fetched_at"] >= oldest))
    placed = each.withColumn("found", F.array_max(usable))
    filled = [
        F.coalesce(F.col("found")[c], F.lit(WEATHER_DEFAULTS[c]).cast(kinds[c])).alias(c)
        for c in weather
    ]
    return placed.select(*[F.col("event")[c].alias(c) for c in event_columns], "city_id", F.col("event.purchased_at").alias("purchased_at"), *filled)
