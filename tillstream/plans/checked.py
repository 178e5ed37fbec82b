"""Quality checks that are counted while a batch is written.

Row rules are observed on the rows as they go to their table, so no table is scanned for
them.  For duplicate and orphan rules each batch leaves its rows per key; these merge
over batches, and the raw tables are not read again.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, as_of_column
from tillstream.operators.evolve import conform
from tillstream.plans.quality import RULES, DuplicateRule, ParentRule, RowRule, classify
from tillstream.schemas import LONG, RAW_TABLES, STRING, columns
from tillstream.sources.tables import Lake

COUNTS = columns(check_name=STRING, fail_count=LONG, row_count=LONG)
PER_KEY = columns(key=STRING, copies=LONG)


def key_of(table: str) -> str:
    """The column by which a table's rows are counted."""
    return next(r.key for r in RULES[table] if isinstance(r, (DuplicateRule, ParentRule)))


def write_checked(lake: Lake, df: DataFrame, table: str, batch_id: str, as_of: AsOf = None) -> None:
    """Write df as a batch of a raw table and keep what its rules count.

    A batch that is written again replaces its counts.  The rows per key are read from
    the key column of the written batch: one column of this batch.
    """
    rules = [r for r in RULES[table] if isinstance(r, RowRule)]
    now = as_of_column(as_of)
    seen = Observation(f"{table}-{batch_id}")
    counts = [F.count(F.when(r.condition(now), 1)).alias(r.check) for r in rules]
    stored = conform(df, RAW_TABLES[table])
    lake.write_batch(stored.observe(seen, F.count(F.lit(1)).alias("row_count"), *counts), table, batch_id)
    found = seen.get
    rows = [(r.check, found[r.check], found["row_count"]) for r in rules]
    lake.write_batch(lake.spark.createDataFrame(rows, COUNTS), f"{table}_rule_counts", batch_id, COUNTS, "staging")
    written = lake.batches(table).where(F.col("batch_id") == batch_id)
    per_key = written.groupBy(F.col(key_of(table)).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    lake.write_batch(per_key, f"{table}_key_counts", batch_id, PER_KEY, "staging")


def _per_key(lake: Lake, table: str) -> DataFrame:
    """Rows per key over all batches, NULL being a key."""
    held = lake.read(f"{table}_key_counts", PER_KEY, "staging")
    return held.groupBy("key").agg(F.sum("copies").alias("copies"))


def _key_counts(lake: Lake, table: str, rule: DuplicateRule | ParentRule) -> DataFrame:
    keys = _per_key(lake, table)
    if isinstance(rule, ParentRule):
        parents = _per_key(lake, rule.parent).where("key is not null").select("key", F.lit(True).alias("_found"))
        failing = F.when(F.col("_found").isNull(), F.col("copies"))
        keys = keys.join(parents, "key", "left")
    else:
        failing = F.when(F.col("copies") > 1, F.lit(1))
    return keys.agg(
        F.coalesce(F.sum(failing), F.lit(0)).alias("fail_count"), F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count")
    ).select(F.lit(rule.check).alias("check_name"), "fail_count", "row_count")


def counted_checks(lake: Lake, only: Iterable[str] | None = None) -> DataFrame:
    """What run_checks says of the raw tables, from the counts their batches left."""
    parts = []
    for name in RULES if only is None else only:
        order = F.array(*[F.lit(r.check) for r in RULES[name]])
        summed = (
            lake.read(f"{name}_rule_counts", COUNTS, "staging")
            .groupBy("check_name")
            .agg(F.sum("fail_count").alias("fail_count"), F.sum("row_count").alias("row_count"))
        )
        keyed = [_key_counts(lake, name, r) for r in RULES[name] if not isinstance(r, RowRule)]
        place = F.lit(list(RULES).index(name) * 100) + F.array_position(order, F.col("check_name"))
        parts.append(reduce(DataFrame.unionByName, keyed, summed).withColumns({"table_name": F.lit(name), "_rule": place}))
    found = classify(reduce(DataFrame.unionByName, parts)).orderBy("_rule")
    return found.select("table_name", "check_name", "status", "detail", "row_count", "fail_count")
