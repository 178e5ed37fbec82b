"""Data-quality rules, schema tests, and the gate."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.clock import AsOf, as_of_column
from tillstream.functions.money import share_text
from tillstream.operators.keyed import missing_parent
from tillstream.schemas import STATUSES

log = logging.getLogger(__name__)

# Below this share of failing rows a rule warns, from it on it fails.
FAIL_FROM_PERCENT = 1

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowRule:
    """Counts the rows for which a condition is true; unknown does not count."""

    check: str
    condition: Callable[[Column], Column]


@dataclass(frozen=True)
class DuplicateRule:
    """Counts the keys, NULL among them, that occur more than once."""

    check: str
    key: str


@dataclass(frozen=True)
class ParentRule:
    """Counts the rows whose key has no row in the parent table."""

    check: str
    key: str
    parent: str


def _null(column: str) -> Callable[[Column], Column]:
    return lambda as_of: F.col(column).isNull()


RULES: dict[str, list[RowRule | DuplicateRule | ParentRule]] = {
    "orders": [
        RowRule("null_order_id", _null("order_id")),
        RowRule("null_customer_id", _null("customer_id")),
        RowRule("null_status", _null("order_status")),
        RowRule("null_purchase_ts", _null("order_purchase_ts")),
        DuplicateRule("duplicate_order_id", "order_id"),
        RowRule("future_purchase_ts", lambda as_of: F.col("order_purchase_ts") > as_of),
        RowRule(
            "approved_before_purchase",
            lambda as_of: F.col("order_approved_ts") < F.col("order_purchase_ts"),
        ),
        RowRule("invalid_status", lambda as_of: ~F.col("order_status").isin(STATUSES)),
    ],
    "customers": [
        RowRule("null_customer_id", _null("customer_id")),
        RowRule("null_city", _null("customer_city")),
        DuplicateRule("duplicate_customer_id", "customer_id"),
    ],
    "products": [
        RowRule("null_product_id", _null("product_id")),
        RowRule("null_category", _null("category_name")),
        RowRule("negative_price", lambda as_of: F.col("product_price") < 0),
        RowRule("zero_price", lambda as_of: F.col("product_price") == 0),
        DuplicateRule("duplicate_product_id", "product_id"),
    ],
    "order_items": [
        RowRule("null_order_id", _null("order_id")),
        RowRule("null_product_id", _null("product_id")),
        RowRule("negative_price", lambda as_of: F.col("price") < 0),
        RowRule("zero_quantity", lambda as_of: F.col("quantity") <= 0),
        ParentRule("orphan_order_id", "order_id", "orders"),
    ],
}


def _row_counts(df: DataFrame, rules: list[RowRule], as_of: Column) -> DataFrame:
    """One scan for all row rules of a table: (check_name, fail_count, row_count)."""
    counts = [F.count(F.when(r.condition(as_of), 1)).alias(r.check) for r in rules]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
    pairs = F.array(
        *[F.struct(F.lit(r.check).alias("check_name"), F.col(r.check).alias("fail_count")) for r in rules]
    )
    return totals.select("row_count", F.inline(pairs)).select("check_name", "fail_count", "row_count")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys, NULL among them, that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _duplicate_count(df: DataFrame, rule: DuplicateRule) -> DataFrame:
    copies = df.groupBy(rule.key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.count(F.when(F.col("copies") > 1, 1)).alias("fail_count"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
    ).select(F.lit(rule.check).alias("check_name"), "fail_count", "row_count")


def _parent_count(df: DataFrame, rule: ParentRule, parent: DataFrame) -> DataFrame:
    return (
        missing_parent(df, parent, rule.key)
        .agg(
            F.coalesce(F.sum(F.when(F.col("missing"), F.col("rows"))), F.lit(0)).alias("fail_count"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        )
        .select(F.lit(rule.check).alias("check_name"), "fail_count", "row_count")
    )


def _place(table: str, check: str) -> int:
    """Where a rule stands among the results."""
    return list(RULES).index(table) * 100 + [r.check for r in RULES[table]].index(check) + 1


def _shared_keys(tables: Tables, child: str, orphans: ParentRule, duplicates: DuplicateRule) -> DataFrame:
    """Both rules over one grouping of both tables' key, as _table_counts gives them.

    Rows per key are counted for the two tables side by side and combined on the map side,
    so the parent's key is scanned once and nothing is joined.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    parent = orphans.parent
    rows = tables[parent].select(F.col(duplicates.key).alias("key"), one.alias("parents"), none.alias("children")).unionByName(
        tables[child].select(F.col(orphans.key).alias("key"), none.alias("parents"), one.alias("children"))
    )
    keys = rows.groupBy("key").agg(F.sum("parents").alias("parents"), F.sum("children").alias("children"))
    missing = F.col("key").isNull() | (F.col("parents") == 0)
    totals = keys.agg(
        F.count(F.when(F.col("parents") > 1, 1)).alias("copied"),
        F.coalesce(F.sum("parents"), F.lit(0)).alias("parents"),
        F.coalesce(F.sum(F.when(missing, F.col("children"))), F.lit(0)).alias("orphaned"),
        F.coalesce(F.sum("children"), F.lit(0)).alias("children"),
    )
    pairs = [
        F.struct(
            F.lit(rule.check).alias("check_name"), F.col(fails).alias("fail_count"), F.col(n).alias("row_count"),
            F.lit(table).alias("table_name"), F.lit(_place(table, rule.check)).alias("_rule"),
        )
        for table, rule, fails, n in ((parent, duplicates, "copied", "parents"), (child, orphans, "orphaned", "children"))
    ]
    return totals.select(F.inline(F.array(*pairs)))


def _table_counts(name: str, tables: Tables, as_of: Column, done: Iterable[str] = ()) -> DataFrame:
    """The counts of a table's rules, but of those that are done."""
    df, rules = tables[name], [r for r in RULES[name] if r.check not in done]
    parts = [_row_counts(df, [r for r in rules if isinstance(r, RowRule)], as_of)]
    parts += [_duplicate_count(df, r) for r in rules if isinstance(r, DuplicateRule)]
    parts += [
        _parent_count(df, r, tables[r.parent]) for r in rules if isinstance(r, ParentRule)
    ]
    order = F.array(*[F.lit(r.check) for r in RULES[name]])
    place = F.lit(list(RULES).index(name) * 100) + F.array_position(order, F.col("check_name"))
    return reduce(DataFrame.unionByName, parts).withColumns({"table_name": F.lit(name), "_rule": place.cast("int")})


def classify(counts: DataFrame) -> DataFrame:
    """Add status and detail to fail_count and row_count."""
    fails, rows = F.col("fail_count"), F.greatest(F.col("row_count"), F.lit(1))
    status = (
        F.when(fails == 0, "PASS").when(fails * 100 < rows * FAIL_FROM_PERCENT, "WARN").otherwise("FAIL")
    )
    text = F.concat(
        fails.cast("string"), F.lit(" rows affected ("), share_text(fails, F.col("row_count")), F.lit("%)")
    )
    return counts.withColumn("status", status).withColumn(
        "detail", F.when(fails == 0, "").otherwise(text)
    )


def run_checks(tables: Tables, as_of: AsOf = None, only: Iterable[str] | None = None) -> DataFrame:
    """One row per rule of the chosen tables, in table and rule order.

    Each table is scanned once for its row count and all row rules; duplicates and
    orphans need a grouping by key and read the key column alone.  Where a table's parent
    is chosen, too, one grouping serves the orphans and the parent's duplicates.  A name without rules
    is reported and adds no row.
    """
    chosen = []
    for name in RULES if only is None else only:
        if name in RULES:
            chosen.append(name)
        else:
            log.warning("no checks defined for table %r", name)
    now = as_of_column(as_of)
    # Without a known table among those chosen: the shape of the results, and no row.
    pairs = []
    for name in chosen:
        for rule in RULES[name]:
            if isinstance(rule, ParentRule) and rule.parent in chosen:
                same = [r for r in RULES[rule.parent] if isinstance(r, DuplicateRule) and r.key == rule.key]
                pairs += [(name, rule, r) for r in same]
    done = {r.check for _, *two in pairs for r in two}
    parts = [_table_counts(n, tables, now, done) for n in chosen or [next(iter(tables))]]
    parts += [_shared_keys(tables, *pair) for pair in pairs]
    counts = reduce(DataFrame.unionByName, parts if chosen else [parts[0].limit(0)])
    return (
        classify(counts)
        .orderBy("_rule")
        .select("table_name", "check_name", "status", "detail", "row_count", "fail_count")
    )


def logged(results: DataFrame, run_at: AsOf = None, run_id: str | None = None) -> DataFrame:
    """Results as rows of the quality log."""
    return results.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)).withColumn(
        "run_at", as_of_column(run_at)
    )


def summary(results: DataFrame) -> DataFrame:
    def having(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1))

    return results.agg(
        F.count(F.lit(1)).alias("total"),
        having("PASS").alias("passed"),
        having("WARN").alias("warned"),
        having("FAIL").alias("failed"),
    )


class QualityError(ValueError):
    """Rules failed; the pipeline must not go on."""


class SchemaTestError(QualityError):
    """Declared tests failed on the transformed data."""


def gate(log_rows: DataFrame, as_of: AsOf = None, lookback: str = "10 minutes") -> DataFrame:
    """One row: the number of FAILs logged in the last minutes.  WARN passes."""
    bound = as_of_column(as_of) - F.expr(f"INTERVAL {lookback}")
    failed = (F.col("status") == "FAIL") & (F.col("run_at") >= bound)
    return log_rows.agg(F.count(F.when(failed, 1)).alias("fail_count"))


def require_gate(log_rows: DataFrame, as_of: AsOf = None, lookback: str = "10 minutes") -> None:
    fails = gate(log_rows, as_of, lookback).first()["fail_count"]
    if fails:
        raise QualityError(f"{fails} quality check(s) failed; pipeline halted")


def require_no_fail(results: DataFrame) -> None:
    """Fail fast: raise when any rule has failed."""
    fails = summary(results).first()["failed"]
    if fails:
        raise QualityError(f"{fails} quality check(s) failed")


# Declared tests per dataset and column.
SCHEMA_TESTS: dict[str, list[tuple[str, list[str]]]] = {
    "orders": [
        ("order_id", ["not_null", "unique"]),
        ("customer_id", ["not_null"]),
        ("order_status", ["not_null", "accepted_values"]),
    ],
    "customers": [("customer_id", ["not_null", "unique"])],
    "products": [("product_id", ["not_null", "unique"]), ("product_price", ["not_null"])],
    "order_items": [("order_id", ["not_null"]), ("product_id", ["not_null"])],
    "stg_orders": [("order_id", ["not_null", "unique"]), ("customer_id", ["not_null"])],
    "mart_order_metrics": [
        ("order_date", ["not_null", "unique"]),
        ("gross_revenue", ["not_null"]),
    ],
}
ACCEPTED_VALUES = {("orders", "order_status"): STATUSES}


def schema_tests(tables: Tables) -> DataFrame:
    """One row per declared test: dataset, column, test, failures.

    not_null counts NULL rows, unique counts non-NULL values that occur more than
    once, accepted_values counts distinct non-NULL values outside the list.
    """
    parts = []
    for name, columns in SCHEMA_TESTS.items():
        df = tables[name]
        measures = []
        for column, tests in columns:
            if "not_null" in tests:
                measures.append((column, "not_null", F.count(F.when(F.col(column).isNull(), 1))))
            if "accepted_values" in tests:
                strange = ~F.col(column).isin(ACCEPTED_VALUES[name, column])
                measures.append(
                    (column, "accepted_values", F.countDistinct(F.when(strange, F.col(column))))
                )
            if "unique" in tests:
                parts.append(_unique_failures(df, name, column))
        counted = df.agg(*[m.alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("dataset"),
                    F.lit(column).alias("column_name"),
                    F.lit(test).alias("test"),
                    F.col(f"m{i}").alias("failures"),
                )
                for i, (column, test, _) in enumerate(measures)
            ]
        )
        parts.append(counted.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def _unique_failures(df: DataFrame, name: str, column: str) -> DataFrame:
    repeated = duplicate_keys(df.where(F.col(column).isNotNull()), column)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("dataset"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"),
        "failures",
    )


def require_schema_tests(
    results: DataFrame, excused: Mapping[tuple[str, str, str], DataFrame] | None = None
) -> None:
    """Raise when a declared test has failed.

    excused has the rows that may fail a test, by its dataset, column and name: more
    failures than these raise.  They are counted when the test has failed, else not.
    """
    # Eighteen rows at most.
    failed = results.where(F.col("failures") > 0).orderBy("dataset", "column_name", "test").collect()
    unexcused = []
    for r in failed:
        rows = (excused or {}).get((r.dataset, r.column_name, r.test))
        if rows is None or r.failures > rows.count():
            unexcused.append(r)
        else:
            log.warning("%s.%s %s: %d failures, all excused", r.dataset, r.column_name, r.test, r.failures)
    if unexcused:
        names = ", ".join(f"{r.dataset}.{r.column_name} {r.test} ({r.failures})" for r in unexcused)
        raise SchemaTestError(f"schema tests failed: {names}")
