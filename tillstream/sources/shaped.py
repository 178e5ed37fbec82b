"""The order data model as views over a given star schema (orders, lineitem, ...).

All views are narrow expressions over whole tables.  The dirty_* views break rows on
purpose, so that quality rules have something to find.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.money import freight
from tillstream.sources.order_topic import folder_stream
from tillstream.schemas import DOUBLE, INT, LONG, STRING, TIME, columns

# Clocks that stand for "now" in reports over the given tables.
RETAIL_NOW = "2001-08-02 00:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"

# The cities and their coordinates.
CITIES = [
    (0, "Istanbul", "TR", 41.01, 28.95),
    (1, "Ankara", "TR", 39.93, 32.86),
    (2, "Izmir", "TR", 38.42, 27.14),
    (3, "Berlin", "DE", 52.52, 13.40),
    (4, "Amsterdam", "NL", 52.37, 4.90),
    (5, "Paris", "FR", 48.85, 2.35),
    (6, "London", "GB", 51.51, -0.13),
    (7, "Warsaw", "PL", 52.23, 21.01),
    (8, "Vienna", "AT", 48.21, 16.37),
    (9, "Madrid", "ES", 40.42, -3.70),
    (10, "Rome", "IT", 41.90, 12.49),
    (11, "Prague", "CZ", 50.08, 14.44),
]

# Country facts. CZ is left out, so that the default of the lookup is used.
COUNTRIES = [
    ("TR", "Türkiye", "TRY", 85_000_000, "Asia"),
    ("DE", "Germany", "EUR", 83_000_000, "Europe"),
    ("NL", "Netherlands", "EUR", 17_000_000, "Europe"),
    ("FR", "France", "EUR", 67_000_000, "Europe"),
    ("GB", "United Kingdom", "GBP", 67_000_000, "Europe"),
    ("PL", "Poland", "PLN", 38_000_000, "Europe"),
    ("AT", "Austria", "EUR", 9_000_000, "Europe"),
    ("ES", "Spain", "EUR", 47_000_000, "Europe"),
    ("IT", "Italy", "EUR", 59_000_000, "Europe"),
]

WEATHER_WORDS = ["Clear", "Clouds", "Rain", "Snow", "Mist"]

EVENT_ROWS = columns(
    event_id=LONG, ts=TIME, user_id=LONG, event_type=STRING, value=DOUBLE, props=STRING
)
CITY_ROWS = columns(city_id=INT, city=STRING, country_code=STRING, lat=DOUBLE, lon=DOUBLE)
COUNTRY_ROWS = columns(
    country_code=STRING, country_name=STRING, currency=STRING, population=LONG, region=STRING
)


def _values(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A constant table planned as a local relation."""
    literals = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {literals} AS t({', '.join(schema.names)})")
    return table.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def _by_word(column: Column, words: dict[str, str], otherwise: str) -> Column:
    picked = None
    for given, word in words.items():
        picked = F.when(column == given, word) if picked is None else picked.when(column == given, word)
    return picked.otherwise(otherwise)


def order_events_from(events: DataFrame) -> DataFrame:
    """Order events out of raw event rows (batch or streaming)."""
    k = F.get_json_object("props", "$.k")
    status = _by_word(
        F.col("event_type"),
        {"purchase": "delivered", "signup": "shipped", "view": "processing", "error": "cancelled"},
        "returned",
    )
    return events.select(
        "event_id",
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_id"),
        status.alias("order_status"),
        F.concat(F.lit("P"), k).alias("product_id"),
        (k.cast("int") % 10).alias("category_no"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        (F.col("user_id") % 12).cast("int").alias("city_id"),
        F.timestamp_add("SECOND", (-((F.col("event_id") * 37) % 3600)).cast("int"), F.col("ts")).alias("purchased_at"),
        "ts",
    )


def weather_readings_from(events: DataFrame) -> DataFrame:
    """Readings per city out of raw event rows, temperatures rounded to a tenth."""
    value = F.col("value").cast("decimal(18,2)")
    k = F.get_json_object("props", "$.k").cast("int")
    word = F.element_at(F.array(*[F.lit(w) for w in WEATHER_WORDS]), k % 5 + 1)
    return (
        events.where(F.col("event_type") == "view")
        .select(
            (F.col("user_id") % 12).cast("int").alias("city_id"),
            F.col("ts").alias("fetched_at"),
            word.alias("weather_condition"),
            F.lower(word).alias("weather_desc"),
            F.round(value, 1).alias("temperature_c"),
            F.round(value - 2, 1).alias("feels_like_c"),
            k.alias("humidity"),
            (k.cast("decimal(9,1)") / 10).cast("decimal(9,1)").alias("wind_speed"),
        )
    )


def _iso(ts: Column) -> Column:
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def wire_events_from(order_events: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Events in the layout of the topic, both flavours' fields filled."""
    number = F.col("event_id")
    bare = number % 101 == 5
    word = F.element_at(F.array(*[F.lit(w) for w in WEATHER_WORDS]), (number % 5 + 1).cast("int"))
    places = F.broadcast(
        cities.join(F.broadcast(countries), "country_code", "left").select(
            "city_id", "city", "country_code", "country_name", "currency", "population", "region",
            "lat", "lon",
        )
    )
    customer = F.struct(
        "city",
        F.col("country_code").alias("state"),
        F.format_string("%05d", F.col("city_id") * 100).alias("zip"),
        "country_code", "country_name", "currency", "population", "region", "lat", "lon",
    )
    weather = F.struct(
        word.alias("weather_condition"),
        F.lower(word).alias("weather_desc"),
        (((number * 13) % 401 - 50) / F.lit(10)).cast("decimal(9,1)").alias("temperature_c"),
        (((number * 13) % 401 - 70) / F.lit(10)).cast("decimal(9,1)").alias("feels_like_c"),
        (number % 101).cast("int").alias("humidity"),
        ((number % 150) / F.lit(10)).cast("decimal(9,1)").alias("wind_speed"),
    )
    product = F.struct(
        "product_id",
        F.concat(F.lit("category_"), F.col("category_no").cast("string")).alias("category_name"),
        "price",
    )
    return order_events.join(places, "city_id", "left").select(
        "event_id",
        F.lit("order_created").alias("event_type"),
        "order_id", "customer_id", "order_status",
        product.alias("product"),
        "quantity",
        freight(F.col("price")).alias("freight_value"),
        F.when(~bare, customer).alias("customer"),
        F.when(~bare, weather).alias("weather"),
        _iso(F.col("purchased_at")).alias("purchased_at"),
        _iso(F.col("ts")).alias("ts"),
    )


def numbered_messages_from(wire_events: DataFrame) -> DataFrame:
    """key and JSON value, with some events sent twice and some cut in half; sent, copy."""
    number = F.col("event_id")
    payload = F.to_json(F.struct(*[c for c in wire_events.columns if c != "event_id"]))
    cut = F.substring(payload, F.lit(1), F.floor(F.length(payload) / 2).cast("int"))
    copies = F.when(number % 127 == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        wire_events.withColumn("value", F.when(number % 251 == 17, cut).otherwise(payload))
        .withColumn("copy", F.explode(copies))
        .select(F.col("order_id").alias("key"), "value", F.col("ts").alias("sent"), "copy")
    )


def wire_messages_from(wire_events: DataFrame) -> DataFrame:
    return numbered_messages_from(wire_events).select("key", "value")


@dataclass(frozen=True)
class Shop:
    """Views over the tables in one folder."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def cities(self) -> DataFrame:
        return _values(self.spark, CITIES, CITY_ROWS)

    def countries(self) -> DataFrame:
        return _values(self.spark, COUNTRIES, COUNTRY_ROWS)

    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = _by_word(
            F.col("o_orderpriority"),
            {
                "1-URGENT": "delivered",
                "2-HIGH": "shipped",
                "3-MEDIUM": "processing",
                "4-NOT SPECIFIED": "cancelled",
            },
            "returned",
        )
        weather = F.element_at(
            F.array(*[F.lit(w) for w in WEATHER_WORDS], F.lit(""), F.lit(None).cast("string")),
            (key % 7 + 1).cast("int"),
        )

        def later(unit: str, n: Column, ts: str) -> Column:
            return F.timestamp_add(unit, n.cast("int"), F.col(ts))

        timed = (
            self.table("orders")
            .withColumn("pts", later("SECOND", (key * 7919) % 86400, "o_orderdate"))
            .withColumn("ats", later("MINUTE", key % 56 + 5, "pts"))
        )
        estimated = later("DAY", F.floor("o_totalprice") % 24 + 7, "pts")
        return timed.select(
            key.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            status.alias("order_status"),
            F.col("pts").alias("order_purchase_ts"),
            F.col("ats").alias("order_approved_ts"),
            F.when(F.col("o_orderpriority") == "1-URGENT", later("DAY", key % 18 + 3, "ats")).alias(
                "order_delivered_ts"
            ),
            F.to_date(estimated).alias("order_estimated_delivery_date"),
            F.col("pts").alias("created_at"),
            weather.alias("weather_condition"),
            (((key * 13) % 401 - 50) / F.lit(10)).cast("decimal(5,1)").alias("temperature_c"),
            (key % 101).cast("int").alias("humidity"),
        )

    def order_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            price.alias("price"),
            freight(price).cast("decimal(18,2)").alias("freight_value"),
        )

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        known = F.broadcast(self.countries())
        places = F.broadcast(self.cities().join(known, "country_code", "left"))
        lat = F.when(key % 13 == 0, None).when(key % 17 == 0, 0.0).otherwise(F.col("lat"))
        return (
            self.table("customer")
            .join(places, (key % 12).cast("int") == F.col("city_id"))
            .select(
                key.cast("string").alias("customer_id"),
                F.col("city").alias("customer_city"),
                F.col("country_code").alias("customer_state"),
                F.lit("").alias("customer_zip"),
                "country_code",
                F.coalesce("country_name", "country_code").alias("country_name"),
                lat.alias("lat"),
                "lon",
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_type").alias("category_name"),
            (F.col("p_size") * 100).alias("product_weight_g"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("product_price"),
        )

    def order_events(self) -> DataFrame:
        return order_events_from(self.table("events"))

    def weather_readings(self) -> DataFrame:
        return weather_readings_from(self.table("events"))

    def wire_events(self) -> DataFrame:
        return wire_events_from(self.order_events(), self.cities(), self.countries())

    def spread_events(self) -> DataFrame:
        """wire_events, dealt evenly to tasks while rows are narrow: a file of events is read by
        as few tasks as it has row groups, and a message costs far more than its event."""
        events = order_events_from(self.table("events").hint("rebalance"))
        return wire_events_from(events, self.cities(), self.countries())

    def wire_messages(self) -> DataFrame:
        return wire_messages_from(self.spread_events())

    def event_stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        """Raw event rows as a stream; the glob covers one file and a folder of files."""
        reader = self.spark.readStream.schema(EVENT_ROWS)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(f"{self.folder}/event[s].parquet")

    def message_stream(self) -> DataFrame:
        dealt = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        events = order_events_from(self.event_stream().repartition(dealt))
        return wire_messages_from(wire_events_from(events, self.cities(), self.countries()))

    def deliver_messages(self, area: str, parts: int = 4) -> Iterator[DataFrame]:
        """The messages in `parts` folders in the order sent, and for each a stream over the
        folders up to it, to be run on one checkpoint: so each adds a part.

        An event that is sent twice comes again in the part after its own.  All parts are
        written by one job, each by as many tasks as have rows of it.
        """
        numbered = numbered_messages_from(self.spread_events())
        day = F.dayofmonth(F.col("sent").cast("timestamp_ntz"))
        part = F.least(F.floor((day - 1) * parts / 31), F.lit(parts - 1)) + F.col("copy") - 1
        held = numbered.withColumn("part", F.least(part, F.lit(parts - 1)).cast("int"))
        held.select("part", "key", "value").write.partitionBy("part").parquet(area)
        for k in range(parts):
            yield folder_stream(self.spark, f"{area}/part={{{','.join(map(str, range(k + 1)))}}}")

    def deliver_events(self, area: str, parts: int = 4) -> Iterator[DataFrame]:
        """As deliver_messages, with raw event rows by their time; a last part holds one view
        of the year 2100, event -1, which tells that nothing older will come."""
        events = self.table("events").select(*EVENT_ROWS.names)
        part = F.least(F.floor((F.dayofmonth("ts") - 1) * parts / 31), F.lit(parts - 1)).cast("int")
        last = _values(self.spark, [(-1, "2100-01-01 00:00:00", 0, "view", 0, '{"k": 1}')], EVENT_ROWS)
        both = events.withColumn("part", part).unionByName(last.withColumn("part", F.lit(parts)))
        both.write.partitionBy("part").parquet(area)
        for k in range(parts + 1):
            yield folder_stream(self.spark, f"{area}/part={{{','.join(map(str, range(k + 1)))}}}", EVENT_ROWS)

    def dirty_orders(self) -> DataFrame:
        n = F.col("order_id").cast("bigint")
        purchase = F.col("order_purchase_ts")
        return self.orders().withColumns(
            {
                "order_id": F.when(n % 997 == 3, None).when(n % 1009 == 5, "7").otherwise(F.col("order_id")),
                "customer_id": F.when(n % 499 != 7, F.col("customer_id")),
                "order_status": F.when(n % 61 == 11, "lost").when(n % 1499 == 9, None).otherwise(F.col("order_status")),
                "order_purchase_ts": F.when(n % 2003 == 17, None)
                .when(n % 3001 == 19, purchase + F.expr("INTERVAL 20 YEARS"))
                .otherwise(purchase),
                "order_approved_ts": F.when(n % 701 == 13, purchase - F.expr("INTERVAL 1 HOUR")).otherwise(
                    F.col("order_approved_ts")
                ),
            }
        )

    def dirty_customers(self) -> DataFrame:
        n = F.col("customer_id").cast("bigint")
        return self.customers().withColumns(
            {
                "customer_id": F.when(n % 401 != 2, F.col("customer_id")),
                "customer_city": F.when(n % 37 != 0, F.col("customer_city")),
            }
        )

    def dirty_products(self) -> DataFrame:
        n = F.col("product_id").cast("bigint")
        price = F.col("product_price")
        return self.products().withColumns(
            {
                "product_id": F.when(n % 503 == 4, "9").otherwise(F.col("product_id")),
                "category_name": F.when(n % 29 != 0, F.col("category_name")),
                "product_price": F.when(n % 307 == 1, -price).when(n % 411 == 3, 0).otherwise(price),
            }
        )

    def dirty_order_items(self) -> DataFrame:
        n = F.col("order_id").cast("bigint")
        p = F.col("product_id").cast("bigint")
        return self.order_items().withColumns(
            {
                "order_id": F.when(n % 2999 == 21, None)
                .when(n % 1999 == 23, F.concat(F.lit("X"), F.col("order_id")))
                .otherwise(F.col("order_id")),
                "product_id": F.when(p % 1777 != 1, F.col("product_id")),
                "quantity": F.when(p % 1301 == 2, 0).otherwise(F.col("quantity")),
                "price": F.when(p % 1103 == 3, -F.col("price")).otherwise(F.col("price")),
            }
        )

    def raw(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders(),
            "customers": self.customers(),
            "products": self.products(),
            "order_items": self.order_items(),
        }

    def dirty(self) -> dict[str, DataFrame]:
        return {
            "orders": self.dirty_orders(),
            "customers": self.dirty_customers(),
            "products": self.dirty_products(),
            "order_items": self.dirty_order_items(),
        }
