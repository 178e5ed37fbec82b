"""The daily run: ingest, check, gate, transform, test."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, as_of_column
from tillstream.operators.keyed import insert_if_absent
from tillstream.plans.marts import days_without_items, mart_order_metrics, spark_order_metrics
from tillstream.plans.quality import (
    logged,
    require_gate,
    require_no_fail,
    require_schema_tests,
    run_checks,
    schema_tests,
)
from tillstream.plans.staging import stg_orders
from tillstream.schemas import LONG, STRING, columns
from tillstream.sources.tables import Lake, side_by_side

log = logging.getLogger(__name__)
TEST_RESULTS = columns(dataset=STRING, column_name=STRING, test=STRING, failures=LONG)


RAW = ("orders", "customers", "products", "order_items")
NO_REVENUE = ("mart_order_metrics", "gross_revenue", "not_null")
KEYS = {"customers": "customer_id", "products": "product_id", "orders": "order_id"}


def without_key(df: DataFrame, table: str) -> DataFrame:
    """The rows of a keyed table that have no key, as rows of the quarantine."""
    row = F.to_json(F.struct(*[c for c in df.columns]))
    bad = df.where(F.col(KEYS[table]).isNull())
    return bad.select(
        F.lit(None).cast("string").alias("key"), row.alias("value"),
        F.lit(f"{table} without {KEYS[table]}").alias("reason"),
    )


def ingest_batch(
    lake: Lake,
    incoming: dict[str, DataFrame],
    batch_id: str,
    arrival: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Add a batch to the raw tables: keyed tables if absent, items as they are.

    Of several rows of a key the first by the table's arrival columns is stored.  Rows
    without a key go to quarantine.  So each incoming row is stored, known already, a
    later row of its key, or in quarantine.  A batch written before under the same id is
    replaced.
    """
    held = {n: incoming[n].persist(StorageLevel.MEMORY_AND_DISK) for n in KEYS if n in incoming}
    rows = {}

    def count(name: str) -> None:
        rows[name] = held[name].count()

    try:
        # Kept before it is read: writes that met it unfinished would build it again or wait.
        if held:
            side_by_side(lake.spark, [partial(count, name) for name in held])

        def store(name: str) -> None:
            known = lake.other_batches(name, batch_id)
            fresh = insert_if_absent(known, held[name], KEYS[name], (arrival or {}).get(name, ()), rows[name])
            lake.write_batch(fresh, name, batch_id)

        writes = [partial(store, name) for name in held]
        if held:
            bad = reduce(DataFrame.unionByName, [without_key(df, name) for name, df in held.items()])
            writes.append(lambda: lake.write_batch(bad, "quarantine", batch_id))
        if "order_items" in incoming:
            items = incoming["order_items"]
            writes.append(lambda: lake.write_batch(items, "order_items", batch_id))
        side_by_side(lake.spark, writes)
    finally:
        for df in held.values():
            df.unpersist()


def run_pipeline(
    lake: Lake,
    incoming: dict[str, DataFrame],
    batch_id: str,
    as_of: AsOf = None,
    *,
    arrival: Mapping[str, Sequence[str]] | None = None,
    fail_fast: bool = False,
    require_tests: bool = True,
    itemless_days: bool = False,
) -> DataFrame:
    """Run the steps in order and return the mart as written.

    fail_fast stops at any failed rule; else the gate decides.  Both raise before the
    mart is touched; failing schema tests raise after it was rebuilt.  With
    require_tests=False they do not raise: their results are in staging.test_results
    either way.  With itemless_days, days none of whose orders has an item may be without
    revenue, and any other failure raises.  Running a batch id again repeats the run.
    """
    ingest_batch(lake, incoming, batch_id, arrival)

    raw = {name: lake.read(name) for name in RAW}
    # One clock for the whole run; a Spark literal, so the log and the gate agree.
    now = as_of if as_of is not None else _now(lake)
    results = logged(run_checks(raw, now), now, batch_id)
    lake.write_batch(results, "dq_results", batch_id)
    if fail_fast:
        require_no_fail(lake.batches("dq_results").where(F.col("batch_id") == batch_id))
    require_gate(lake.read("dq_results"), now)

    staged = stg_orders(raw["orders"])
    lake.rebuild(mart_order_metrics(staged, raw["order_items"]), "marts", "mart_order_metrics")
    mart = lake.rebuilt("marts", "mart_order_metrics")
    tested = schema_tests({**raw, "stg_orders": staged, "mart_order_metrics": mart})
    lake.write_batch(tested, "test_results", batch_id, TEST_RESULTS, "staging")
    if require_tests:
        found = lake.batches("test_results", TEST_RESULTS, "staging")
        excused = {}
        if itemless_days:
            excused[NO_REVENUE] = days_without_items(mart, staged, raw["order_items"])
        require_schema_tests(found.where(F.col("batch_id") == batch_id), excused)
    log.info("pipeline run %s completed", batch_id)
    return mart


def run_spark_metrics(lake: Lake) -> DataFrame:
    """Rebuild the second mart from the raw tables, once, and return it."""
    plan = spark_order_metrics(lake.read("orders"), lake.read("order_items"))
    lake.rebuild(plan, "marts", "spark_order_metrics")
    return lake.rebuilt("marts", "spark_order_metrics")


def _now(lake: Lake) -> str:
    return str(lake.spark.range(1).select(as_of_column(None).alias("now")).first()["now"])
