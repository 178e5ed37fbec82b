"""Items laid out by the period of their order, so that short reports read few of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, as_of_column
from tillstream.operators.keyed import only_keys_of
from tillstream.sources.tables import BATCH, PERIOD_COLUMNS, PLACED_ITEMS, Lake


def place_items(lake: Lake, items: DataFrame, batch_id: str) -> None:
    """Write a batch of items under the periods of their orders.

    Orders come first: those of the same batch and of earlier ones are known.  An item
    whose order is not known lies under no period, where every report looks.
    """
    column = PERIOD_COLUMNS[lake.order_period]
    orders = lake.batches("orders").where(F.col("order_id").isNotNull())
    own = orders.where(F.col(BATCH) == batch_id).select("order_id")
    late = items.where(F.col("order_id").isNotNull()).select("order_id").join(own, "order_id", "left_anti")
    if late.head(1):
        # Two columns of the other batches' orders, of few keys where they are scanned.
        older = only_keys_of(orders.where(F.col(BATCH) != batch_id).select("order_id", column), late, "order_id")
        known = orders.where(F.col(BATCH) == batch_id).select("order_id", column).unionByName(older)
    else:
        known = orders.where(F.col(BATCH) == batch_id).select("order_id", column)
    periods = known.groupBy("order_id").agg(F.min(column).alias(column))
    lake.write_batch(items.join(periods, "order_id", "left"), PLACED_ITEMS, batch_id)


def items_since(items: DataFrame, as_of: AsOf, lookback: str) -> DataFrame:
    """Items that can belong to orders of at most `lookback` before as_of, by their layout.

    Items without a layout are all kept.
    """
    bound = F.to_date(as_of_column(as_of) - F.expr(f"INTERVAL {lookback}"))
    for column, first in (("order_date", bound), ("order_month", F.trunc(bound, "month"))):
        if column in items.columns:
            items = items.where((F.col(column) >= first) | F.col(column).isNull())
    return items
