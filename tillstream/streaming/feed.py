"""The live feed, kept over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, since
from tillstream.schemas import MONEY, READING, STRING, TIME, columns
from tillstream.sources.order_topic import accepted, decode
from tillstream.sources.tables import Lake
from tillstream.streaming.fresh import held, new_rows, with_new_keys
from tillstream.streaming.jobs import EachBatch

FEED = "live_feed"
PLACES = columns(customer_id=STRING, city=STRING, country_code=STRING)
LINES = columns(
    order_id=STRING, city=STRING, country_code=STRING, order_status=STRING, weather_condition=STRING,
    temperature_c=READING, price=MONEY, purchased_at=TIME, batch_id=STRING,
)
SHOWN = [f for f in LINES.names if f != "batch_id"]


def feed_events(messages: DataFrame) -> DataFrame:
    """A stream of messages as order lines, and markers of the order_ids and customers that
    it has not carried before."""
    lines = accepted(decode(messages)).select(
        "order_id",
        "customer_id",
        "order_status",
        F.coalesce("weather.weather_condition", F.lit("")).alias("weather_condition"),
        F.coalesce("weather.temperature_c", F.lit(0)).cast("decimal(9,2)").alias("temperature_c"),
        F.coalesce("product.price", F.lit(0)).cast("decimal(18,2)").alias("price"),
        F.coalesce("customer.city", F.lit("")).alias("city"),
        F.coalesce("customer.country_code", F.lit("")).alias("country_code"),
        "purchased_at",
        F.col("ts").alias("sent"),
    )
    return with_new_keys(lines, {"order": F.col("order_id"), "customer": F.col("customer_id")})


def keep_feed(lake: Lake, n: int = 20) -> EachBatch:
    """Keep the n newest order lines of feed_events, exact also when orders arrive late.

    A micro-batch's new orders compete with the n lines kept so far; what falls out can
    never come back, as lines only arrive.  An order shows the place its customer had
    first; only n customers are looked up among those of earlier micro-batches.  A
    micro-batch that is run again takes its own lines out of the kept ones first.
    """

    def newest(lines: DataFrame) -> DataFrame:
        return lines.orderBy(F.desc("purchased_at"), "order_id").limit(n)

    def each_batch(events: DataFrame, batch: str) -> None:
        with held(events) as kept:
            places = new_rows(kept, "customer", "customer_id", ["sent"]).select(*PLACES.names)
            lake.write_batch(places, "feed_places", batch, PLACES, "staging")
            fresh = newest(new_rows(kept, "order", "order_id", ["sent"])).drop("city", "country_code", "sent")
            # At most n rows, and their customers.
            top = lake.spark.createDataFrame(fresh.toArrow(), fresh.schema)
            known = lake.read("feed_places", PLACES, "staging").join(F.broadcast(top.select("customer_id").distinct()), "customer_id", "left_semi")
            lines = top.join(known, "customer_id", "left").select(*SHOWN, F.lit(batch).alias("batch_id"))
            shown = kept_feed(lake).where(F.col("batch_id") != batch)
            lake.rebuild(newest(shown.unionByName(lines)), "marts", FEED)

    return each_batch


def kept_feed(lake: Lake) -> DataFrame:
    if not lake.version("marts", FEED):
        return lake.spark.createDataFrame([], LINES)
    return lake.rebuilt("marts", FEED)


def live_feed(lake: Lake, as_of: AsOf = None, lookback: str = "1 hour") -> DataFrame:
    """The kept lines of the time before as_of, newest first."""
    recent = since(kept_feed(lake), "purchased_at", as_of, lookback)
    return recent.select(*SHOWN).orderBy(F.desc("purchased_at"), "order_id")
