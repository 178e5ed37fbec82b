"""The order topic: key = order_id, value = one JSON event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import CORRUPT, EVENT, STRING, columns

MESSAGE = columns(key=STRING, value=STRING)


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "orders-raw",
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a broker topic.  Progress lives in the query's checkpoint; the
    starting offsets ('earliest' or 'latest') matter for its first run only."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def folder_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
) -> DataFrame:
    """Messages that arrive as parquet files in a folder (a glob is allowed)."""
    reader = spark.readStream.schema(schema).option("latestFirst", latest_first)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def encode(events: DataFrame) -> DataFrame:
    """Messages for the topic: order_id bytes as key, the event as JSON value."""
    value = F.to_json(F.struct(*[c for c in events.columns if c != CORRUPT]))
    return events.select(
        F.col("order_id").cast("binary").alias("key"), value.cast("binary").alias("value")
    )


def publish(messages: DataFrame, servers: str, topic: str = "orders-raw") -> None:
    """Send a batch of messages to a broker, waiting for all replicas."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def decode(messages: DataFrame, enriched: bool = True) -> DataFrame:
    """Messages as key, value, the event's columns, and `reason`.

    `reason` is NULL for an event that can be stored.  Otherwise it says why not: the
    text is not JSON of the event's shape, a required field is absent, or the purchase
    time is not a timestamp.  The enriched event has defaults for most fields; the simple one
    requires all that its four tables take from it.

    The parsed struct is unpacked by a generator: filters and selections above it then
    refer to its columns, and no text is parsed more than once.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, EVENT, {"columnNameOfCorruptRecord": CORRUPT})
    read = messages.select(F.col("key").cast("string"), text.alias("value"), F.inline(F.array(parsed)))
    timed = read.withColumns(
        {
            "_purchased_at": F.col("purchased_at").try_cast("timestamp_ntz"),
            "ts": F.col("ts").try_cast("timestamp_ntz"),
        }
    )
    return (
        timed.withColumn("reason", _reason(enriched))
        .withColumn("purchased_at", F.col("_purchased_at"))
        .drop("_purchased_at", CORRUPT)
    )


def _reason(enriched: bool) -> Column:
    required = ["order_id", "customer_id", "order_status", "product.product_id", "purchased_at"]
    if not enriched:
        required += [
            "product.category_name", "product.price", "quantity", "freight_value",
            "customer.city", "customer.state", "customer.zip",
        ]
    reason = F.when(F.col("value").isNull() | F.col(CORRUPT).isNotNull(), "malformed")
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"missing {name}")
    return reason.when(F.col("_purchased_at").isNull(), "bad purchased_at")


def accepted(decoded: DataFrame) -> DataFrame:
    """The events that can be stored, as columns."""
    return decoded.where(F.col("reason").isNull()).drop("key", "value", "reason")


def rejected(decoded: DataFrame) -> DataFrame:
    """The messages that cannot be stored, as received, with the reason."""
    return decoded.where(F.col("reason").isNotNull()).select("key", "value", "reason")
