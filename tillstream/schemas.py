"""Table and event schemas, and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Order statuses.
STATUSES = ["delivered", "shipped", "processing", "cancelled", "returned"]

# seller_id written for orders that arrive on the topic.
SELLER_SIMPLE = "kafka-seller"
SELLER_ENRICHED = "kafka-hybrid"

# What an event carries when a lookup has no answer.
WEATHER_DEFAULTS = {
    "weather_condition": "Unknown",
    "weather_desc": "unavailable",
    "temperature_c": 0,
    "feels_like_c": 0,
    "humidity": 0,
    "wind_speed": 0,
}
COUNTRY_DEFAULT_CURRENCY = "USD"

# A weather reading stays valid for this many seconds.
WEATHER_VALID_SECONDS = 300


STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
TIME = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)
READING = T.DecimalType(9, 2)


def columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


ORDERS = columns(
    order_id=STRING,
    customer_id=STRING,
    order_status=STRING,
    order_purchase_ts=TIME,
    order_approved_ts=TIME,
    order_delivered_ts=TIME,
    order_estimated_delivery_date=DATE,
    created_at=TIME,
)
CUSTOMERS = columns(
    customer_id=STRING,
    customer_city=STRING,
    customer_state=STRING,
    customer_zip=STRING,
    created_at=TIME,
)
PRODUCTS = columns(
    product_id=STRING,
    category_name=STRING,
    product_weight_g=MONEY,
    product_price=MONEY,
    created_at=TIME,
)
ORDER_ITEMS = columns(
    order_id=STRING,
    product_id=STRING,
    seller_id=STRING,
    quantity=INT,
    price=MONEY,
    freight_value=MONEY,
    created_at=TIME,
)
DQ_RESULTS = columns(
    run_id=STRING,
    table_name=STRING,
    check_name=STRING,
    status=STRING,
    detail=STRING,
    row_count=LONG,
    fail_count=LONG,
    run_at=TIME,
)
QUARANTINE = columns(key=STRING, value=STRING, reason=STRING)

# Columns the enriched events add to the raw tables.
ORDER_WEATHER_COLUMNS = columns(
    weather_condition=STRING,
    weather_desc=STRING,
    temperature_c=READING,
    humidity=INT,
    wind_speed=READING,
)
CUSTOMER_COUNTRY_COLUMNS = columns(
    country_code=STRING,
    country_name=STRING,
    currency=STRING,
    population=LONG,
    region=STRING,
    lat=DOUBLE,
    lon=DOUBLE,
)

RAW_TABLES = {
    "orders": T.StructType(ORDERS.fields + ORDER_WEATHER_COLUMNS.fields),
    "customers": T.StructType(CUSTOMERS.fields + CUSTOMER_COUNTRY_COLUMNS.fields),
    "products": PRODUCTS,
    "order_items": ORDER_ITEMS,
    "placed_items": ORDER_ITEMS,
    "dq_results": DQ_RESULTS,
    "quarantine": QUARANTINE,
}

# One schema reads both event flavours; fields a flavour lacks come back NULL.
CORRUPT = "_corrupt_record"
EVENT = columns(
    event_type=STRING,
    order_id=STRING,
    customer_id=STRING,
    order_status=STRING,
    product=columns(product_id=STRING, category_name=STRING, price=MONEY),
    quantity=INT,
    freight_value=MONEY,
    customer=columns(
        city=STRING,
        state=STRING,
        zip=STRING,
        country_code=STRING,
        country_name=STRING,
        currency=STRING,
        population=LONG,
        region=STRING,
        lat=DOUBLE,
        lon=DOUBLE,
    ),
    weather=columns(
        weather_condition=STRING,
        weather_desc=STRING,
        temperature_c=READING,
        feels_like_c=READING,
        humidity=INT,
        wind_speed=READING,
    ),
    purchased_at=STRING,
    ts=STRING,
    **{CORRUPT: STRING},
)
