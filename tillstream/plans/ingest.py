"""Accepted events as rows of the four raw tables.

Two flavours: the simple event takes its fields as they are; the enriched one fills
absent fields with defaults and adds weather and country columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.schemas import COUNTRY_DEFAULT_CURRENCY, SELLER_ENRICHED, SELLER_SIMPLE


def _or(field: str, default: str | int) -> Column:
    return F.coalesce(F.col(field), F.lit(default))


def customer_columns(enriched: bool = True) -> list[Column]:
    if not enriched:
        return [
            F.col("customer_id"),
            F.col("customer.city").alias("customer_city"),
            F.col("customer.state").alias("customer_state"),
            F.col("customer.zip").alias("customer_zip"),
        ]
    return [
        F.col("customer_id"),
        _or("customer.city", "").alias("customer_city"),
        _or("customer.country_code", "").alias("customer_state"),
        F.lit("").alias("customer_zip"),
        _or("customer.country_code", "").alias("country_code"),
        _or("customer.country_name", "").alias("country_name"),
        _or("customer.currency", "").alias("currency"),
        _or("customer.population", 0).cast("bigint").alias("population"),
        _or("customer.region", "").alias("region"),
        _or("customer.lat", 0).cast("double").alias("lat"),
        _or("customer.lon", 0).cast("double").alias("lon"),
    ]


def product_columns() -> list[Column]:
    return [
        F.col("product.product_id"),
        F.col("product.category_name"),
        F.col("product.price").alias("product_price"),
    ]


def order_columns(enriched: bool = True) -> list[Column]:
    plain = [
        F.col("order_id"),
        F.col("customer_id"),
        F.col("order_status"),
        F.col("purchased_at").alias("order_purchase_ts"),
    ]
    if not enriched:
        return plain
    return [
        *plain,
        _or("weather.weather_condition", "").alias("weather_condition"),
        _or("weather.weather_desc", "").alias("weather_desc"),
        _or("weather.temperature_c", 0).cast("decimal(9,2)").alias("temperature_c"),
        _or("weather.humidity", 0).alias("humidity"),
        _or("weather.wind_speed", 0).cast("decimal(9,2)").alias("wind_speed"),
    ]


def order_item_columns(enriched: bool = True) -> list[Column]:
    keys = [F.col("order_id"), F.col("product.product_id")]
    if not enriched:
        return [
            *keys,
            F.lit(SELLER_SIMPLE).alias("seller_id"),
            F.col("quantity"),
            F.col("product.price"),
            F.col("freight_value"),
        ]
    return [
        *keys,
        F.lit(SELLER_ENRICHED).alias("seller_id"),
        _or("quantity", 1).alias("quantity"),
        _or("product.price", 0).cast("decimal(18,2)").alias("price"),
        _or("freight_value", 0).cast("decimal(18,2)").alias("freight_value"),
    ]


def flatten_customers(events: DataFrame, enriched: bool = True) -> DataFrame:
    return events.select(*customer_columns(enriched))


def flatten_products(events: DataFrame) -> DataFrame:
    return events.select(*product_columns())


def flatten_orders(events: DataFrame, enriched: bool = True) -> DataFrame:
    return events.select(*order_columns(enriched))


def flatten_order_items(events: DataFrame, enriched: bool = True) -> DataFrame:
    return events.select(*order_item_columns(enriched))


def first_currency(currencies: Column) -> Column:
    """The first key of a country's currency map, else the default."""
    first = F.try_element_at(F.map_keys(currencies), F.lit(1))
    return F.coalesce(first, F.lit(COUNTRY_DEFAULT_CURRENCY))
