"""Keys that a stream has not carried before, known from its state store.

The state of a stream holds each key once, in RocksDB, so what a micro-batch costs does
not grow with the stream's history, and no table is read to find out.  There is no
watermark: a key is remembered for good, however late it comes again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.keyed import first_per_key

KIND, KEY = "_new_kind", "_new_key"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State in RocksDB: it may exceed an executor's memory.  A provider that was set stays."""
    if spark.conf.get(PROVIDER, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)


def with_new_keys(rows: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """A stream's rows, and one marker for each key that it carries for the first time.

    keys names the kinds of keys; NULL is no key.  One state serves all kinds.  A
    micro-batch that is run again sees the state of its first run, so it gets the same
    markers.  new_rows takes a micro-batch apart.

    The rows are dealt out by all their columns before they part.  So both sides read one
    and the same shuffle: what makes the rows (parsing, say) runs once.
    """
    keep_state_on_disk(rows.sparkSession)
    rows = rows.repartition(*rows.columns)
    told = F.array(*[F.struct(F.lit(kind).alias(KIND), column.cast("string").alias(KEY)) for kind, column in keys.items()])
    markers = rows.select(F.inline(told)).where(F.col(KEY).isNotNull()).dropDuplicates([KIND, KEY])
    marked = rows.withColumns({KIND: F.lit(None).cast("string"), KEY: F.lit(None).cast("string")})
    return marked.unionByName(markers, allowMissingColumns=True)


@contextmanager
def held(micro_batch: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch of with_new_keys, kept while it is taken apart.

    It is computed by one job before others read it: jobs that met it unfinished would
    wait for each other's tasks, or run its parsing and its state twice.
    """
    kept = micro_batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept.count()
        yield kept
    finally:
        kept.unpersist()


def rows_of(micro_batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch of with_new_keys."""
    return micro_batch.where(F.col(KIND).isNull()).drop(KIND, KEY)


def new_keys(micro_batch: DataFrame, kind: str) -> DataFrame:
    """The new keys of a kind, one column."""
    return micro_batch.where(F.col(KIND) == kind).select(KEY)


def new_rows(micro_batch: DataFrame, kind: str, key: str, arrival: Sequence[str] = ()) -> DataFrame:
    """The rows that bring a new key, for each key the first by the arrival columns."""
    first = first_per_key(rows_of(micro_batch), key, arrival)
    fresh = new_keys(micro_batch, kind)
    return first.join(fresh, F.col(key).cast("string") == F.col(KEY), "left_semi")
