"""Time functions on zone-free timestamps.

They subtract and truncate TIMESTAMP_NTZ values without a detour over TIMESTAMP,
so a session time zone with daylight saving does not shift results.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str | Column | None


def as_of_column(as_of: AsOf) -> Column:
    """The moment a report looks back from; None means now."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from start to end, as bigint."""
    # timestamp_diff would go over TIMESTAMP; subtraction does not.
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def day_start(ts: Column) -> Column:
    """Midnight of the day, as a timestamp."""
    return F.to_date(ts).cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(ts), day_start(ts))


def since(df: DataFrame, column: str, as_of: AsOf, lookback: str) -> DataFrame:
    """Rows whose timestamp is at most `lookback` (e.g. '48 hours') before as_of.

    On orders laid out by day or month the same bound prunes partitions.
    """
    bound = as_of_column(as_of) - F.expr(f"INTERVAL {lookback}")
    kept = df.where(F.col(column) >= bound)
    if column == "order_purchase_ts":
        if "order_date" in df.columns:
            kept = kept.where(F.col("order_date") >= F.to_date(bound))
        if "order_month" in df.columns:
            kept = kept.where(F.col("order_month") >= F.trunc(F.to_date(bound), "month"))
    return kept
