"""The staged daily mart, kept up to date by the periods that batches touch.

A period is what raw orders are laid out by (a day or a month).  A refresh finds the
periods whose days can have changed, recomputes those and overwrites their partitions; the
others are not read.  The result equals a full rebuild after any batches, late,
repeated or replaced.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.keyed import only_keys_of
from tillstream.plans.marts import mart_order_metrics
from tillstream.plans.staging import stg_orders
from tillstream.schemas import DATE, columns
from tillstream.sources.tables import BATCH, PERIOD_COLUMNS, Lake

MART, TOUCHED = "mart_by_period", "mart_periods"
PERIODS = columns(period=DATE)

Period = datetime.date | None


def _in_periods(orders: DataFrame, column: str, periods: Sequence[Period]) -> DataFrame:
    """Orders of the periods; the filter is on the layout, so it prunes the scan."""
    known = [p for p in periods if p is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return orders.where(found | F.col(column).isNull() if None in periods else found)


def periods_of_batch(lake: Lake, batch_id: str) -> list[Period]:
    """The periods whose orders or items this batch holds now; at most all days of the data.

    Items whose order came with another batch are looked up among all orders, reading two
    columns; a batch that brings items with their orders costs no such scan.
    """
    column = PERIOD_COLUMNS[lake.order_period]
    orders = lake.batches("orders")
    own = orders.where(F.col(BATCH) == batch_id)
    items = lake.batches("order_items").where((F.col(BATCH) == batch_id) & F.col("order_id").isNotNull())
    late = items.select("order_id").join(own.select("order_id"), "order_id", "left_anti")
    found = own.select(column)
    if late.head(1):
        theirs = orders.select("order_id", column)
        found = found.unionByName(only_keys_of(theirs, late, "order_id").join(late.distinct(), "order_id", "left_semi").select(column))
    return [r[0] for r in found.distinct().collect()]


def refresh_mart(lake: Lake, batches: Sequence[str] | None = None) -> list[Period]:
    """Bring the mart up to date with the given batches, or build it from all.

    What a batch touched when it was last taken in is remembered, so a batch that was
    replaced by other rows refreshes the periods of both.  Returns the periods refreshed.
    """
    column = PERIOD_COLUMNS[lake.order_period]
    orders, items = lake.read("orders"), lake.read("order_items")
    if batches is None:
        batches = [r[0] for r in lake.batches("orders").select(BATCH).distinct().collect()]
        periods = [r[0] for r in orders.select(column).distinct().collect()]
        now = {b: periods for b in batches}
    else:
        now = {b: periods_of_batch(lake, b) for b in batches}
        before = lake.batches(TOUCHED, PERIODS, "staging").where(F.col(BATCH).isin(list(batches)))
        periods = list({p for found in now.values() for p in found} | {r["period"] for r in before.collect()})
    if not periods:
        return []
    touched = _in_periods(orders, column, periods)
    staged = stg_orders(touched)
    mart = mart_order_metrics(staged, only_keys_of(items, staged, "order_id"))
    day = F.to_date("order_date")
    kept = mart.withColumns({"empty": F.lit(False), "period": day if lake.order_period == "day" else F.trunc(day, "month")})
    # A period that has lost all its orders gets a line that readers skip, so that its
    # partition is overwritten, too.
    given = lake.spark.createDataFrame([(p,) for p in periods], PERIODS)
    lost = given.join(kept.select(F.col("period").alias("_kept")).distinct(), F.col("period").eqNullSafe(F.col("_kept")), "left_anti")
    marked = kept.unionByName(lost.withColumn("empty", F.lit(True)), allowMissingColumns=True)
    (
        marked.hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period")
        .parquet(lake.path("marts", MART))
    )
    for batch, found in now.items():
        lake.write_batch(lake.spark.createDataFrame([(p,) for p in found], PERIODS), TOUCHED, batch, PERIODS, "staging")
    return periods


def mart_by_period(lake: Lake) -> DataFrame:
    """The mart as last refreshed, newest day first."""
    try:
        found = lake.spark.read.parquet(lake.path("marts", MART))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return mart_order_metrics(stg_orders(lake.read("orders")), lake.read("order_items")).limit(0)
    return found.where(~F.col("empty")).drop("empty", "period").orderBy(F.desc_nulls_first("order_date"))
