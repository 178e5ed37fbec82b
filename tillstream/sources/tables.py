"""Layered tables (raw, staging, marts) and their reads and writes."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.evolve import conform
from tillstream.schemas import RAW_TABLES

BATCH = "batch_id"
PLACED_ITEMS = "placed_items"  # items under the period of their order
PERIOD_COLUMNS = {"day": "order_date", "month": "order_month"}


def table_name(layer: str, name: str) -> str:
    """A model's layer is its namespace, as is."""
    return f"{layer.strip()}.{name}"


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str,
    lower: int | str,
    upper: int | str,
    splits: int,
) -> DataFrame:
    """A database table read in parallel by ranges of split_column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **properties)
        .option("partitionColumn", split_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", splits)
        .load()
    )


def save_mart(df: DataFrame, name: str) -> None:
    """Rebuild a catalog table of the marts layer whole."""
    df.sparkSession.sql("CREATE DATABASE IF NOT EXISTS marts")
    df.write.mode("overwrite").saveAsTable(table_name("marts", name))


def save_colocated(df: DataFrame, layer: str, name: str, key: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by key.

    Orders and items saved with the same number of buckets on order_id are grouped and
    joined on it without a shuffle.  Meant for tables whose key is not skewed: a
    bucket is read by one task.
    """
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(
        table_name(layer, name)
    )


def side_by_side(spark: SparkSession, actions: list[Callable[[], None]]) -> None:
    """Run independent writes as concurrent jobs, so that small ones fill idle cores."""
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    for write in running:
        write.result()


@dataclass(frozen=True)
class Lake:
    """Tables as parquet folders under one root, one folder per layer.

    Appends belong to a batch id, which is a partition of the table: writing a batch
    again replaces its own rows and nothing else, so a replayed batch changes nothing.
    Raw orders are laid out by day, or by month, within it, for reports over a time
    range.
    """

    spark: SparkSession
    root: str
    order_period: str = "day"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def batches(self, name: str, schema: T.StructType | None = None, layer: str = "raw") -> DataFrame:
        """The table with its batch_id column; empty when nothing was written yet."""
        full = T.StructType((schema or RAW_TABLES[name]).fields + self._layout(name))
        try:
            return self.spark.read.schema(full).parquet(self.path(layer, name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return conform(self.spark.range(0), full)

    def read(self, name: str, schema: T.StructType | None = None, layer: str = "raw") -> DataFrame:
        return self.batches(name, schema, layer).drop(BATCH)

    def other_batches(
        self, name: str, batch_id: str, schema: T.StructType | None = None, layer: str = "raw"
    ) -> DataFrame:
        """What the table holds apart from this batch's own earlier attempt."""
        return self.batches(name, schema, layer).where(F.col(BATCH) != batch_id)

    def write_batch(
        self,
        df: DataFrame,
        name: str,
        batch_id: str,
        schema: T.StructType | None = None,
        layer: str = "raw",
        created_at: str | None = None,
    ) -> None:
        """Write df as this batch's rows, with created_at filled where the table has it."""
        schema = schema or RAW_TABLES[name]
        if "created_at" in schema.names:
            given = F.col("created_at") if "created_at" in df.columns else F.lit(None)
            now = F.lit(created_at).cast("timestamp_ntz") if created_at else F.localtimestamp()
            df = df.withColumn("created_at", F.coalesce(given.cast("timestamp_ntz"), now))
        out = conform(df, schema)
        path = f"{self.path(layer, name)}/{BATCH}={batch_id}"
        if name == PLACED_ITEMS:
            column = PERIOD_COLUMNS[self.order_period]
            out = conform(df, T.StructType([*schema.fields, T.StructField(column, T.DateType())])).hint("rebalance", column)
            out.write.mode("overwrite").partitionBy(column).parquet(path)
        elif name == "orders":
            # Gather each period in few files; a crowded one is split over tasks.
            column = PERIOD_COLUMNS[self.order_period]
            period = F.to_date(F.trunc("order_purchase_ts", "month"))
            if self.order_period == "day":
                period = F.to_date("order_purchase_ts")
            out = out.withColumn(column, period).hint("rebalance", column)
            out.write.mode("overwrite").partitionBy(column).parquet(path)
        else:
            # Rows come from large splits or from a shuffle that Spark coalesced.
            out.write.mode("overwrite").parquet(path)

    def rebuild(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace a table whole.  Readers see the old one until the new one is complete.

        Two folders take turns: the new rows overwrite the one that is not in use, then
        a line of the table's version list says that it is.  A run that dies while it
        writes leaves the table as it was.
        """
        version = self.version(layer, name) + 1
        df.write.mode("overwrite").parquet(f"{self.path(layer, name)}/slot{version % 2}")
        line = self.spark.range(1).select(F.lit(version).cast("long").alias("version"))
        line.write.mode("append").parquet(f"{self.path(layer, name)}/versions")

    def rebuilt(self, layer: str, name: str) -> DataFrame:
        """The table as last rebuilt."""
        return self.spark.read.parquet(f"{self.path(layer, name)}/slot{self.version(layer, name) % 2}")

    def version(self, layer: str, name: str) -> int:
        try:
            found = self.spark.read.schema("version long").parquet(f"{self.path(layer, name)}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return found.agg(F.max("version")).first()[0] or 0

    def compact(self, name: str, into: str, schema: T.StructType | None = None, layer: str = "raw") -> None:
        """Write all batches of a table as the one batch `into` of the table name + '_compacted'.

        The table itself is not touched: swap the folders when no job runs on it.  A stream
        that has closed batches inside `into` must not run them again, so compact after
        its last micro-batch was committed.
        """
        rows = self.read(name, schema, layer)
        schema = schema or RAW_TABLES[name]
        out = conform(rows, schema)
        path = f"{self.path(layer, name)}_compacted/{BATCH}={into}"
        if name == "orders":
            column = PERIOD_COLUMNS[self.order_period]
            out = rows.select(*schema.names, column).hint("rebalance", column)
            out.write.mode("overwrite").partitionBy(column).parquet(path)
        else:
            out.hint("rebalance").write.mode("overwrite").parquet(path)

    def _layout(self, name: str) -> list[T.StructField]:
        batch = T.StructField(BATCH, T.StringType())
        if name not in ("orders", PLACED_ITEMS):
            return [batch]
        return [T.StructField(PERIOD_COLUMNS[self.order_period], T.DateType()), batch]
