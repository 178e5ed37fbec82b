"""An index of the keys a table holds, so that a batch finds out which of its keys are new
without a scan of the table.

Keys lie in folders by a hash of the key, one file a batch and folder, sorted, with a
Parquet Bloom filter.  A lookup opens only the folders its keys fall into; a small one
also sends its keys to the scan, where min-max values and Bloom filters leave out files
that cannot hold any of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.keyed import BROADCAST_KEY_LIMIT, first_per_key

FEW_KEYS = 500  # so many keys are sent to the scan as literals
IN_LIMIT = "spark.sql.parquet.pushdown.inFilterThreshold"


@dataclass(frozen=True)
class KeyIndex:
    """Keys (strings) under root; `buckets` must not change once there are keys.

    Choose buckets so that a folder holds some millions of keys.  Each key belongs to the
    batch that brought it: adding a batch again replaces its keys.
    """

    spark: SparkSession
    root: str
    buckets: int = 64
    expected: int = 1_000_000  # different keys of a file, for the size of its Bloom filter

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def add(self, keys: DataFrame, key: str, batch_id: str) -> None:
        """Remember the non-NULL keys of a batch."""
        placed = keys.where(F.col(key).isNotNull()).select(
            F.col(key).cast("string").alias("key"), self.bucket(F.col(key).cast("string")).alias("bucket")
        )
        (
            placed.distinct()
            .repartition("bucket")
            .sortWithinPartitions("bucket", "key")
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#key", "true")
            .option("parquet.bloom.filter.expected.ndv#key", str(self.expected))
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option("parquet.enable.dictionary#key", "false")
            .partitionBy("bucket")
            .parquet(f"{self.root}/batch_id={batch_id}")
        )

    def scan(self) -> DataFrame:
        """All keys: key, bucket, batch_id."""
        schema = "key string, bucket int, batch_id string"
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def candidates(
        self, keys: DataFrame, key: str, but: str | None = None, batches: DataFrame | None = None, few: int = FEW_KEYS
    ) -> DataFrame:
        """The part of the index that may hold some of keys (one column, distinct, no NULL).

        Folders are chosen by number, of which there are `buckets` at most.  The batch
        `but` is left out; with batches (batch_id), all that are not among them.
        """
        wanted = keys.groupBy(self.bucket(F.col(key).cast("string")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
        found = self.scan().where(F.col("bucket").isin([r["bucket"] for r in wanted]))
        if but is not None:
            found = found.where(F.col("batch_id") != but)
        if sum(r["n"] for r in wanted) <= few:
            if int(self.spark.conf.get(IN_LIMIT)) < few:
                self.spark.conf.set(IN_LIMIT, few)
            found = found.where(F.col("key").isin([r[0] for r in keys.select(F.col(key).cast("string")).collect()]))
        if batches is not None:
            found = found.join(batches.select("batch_id").distinct(), "batch_id", "left_semi")
        return found

    def new_rows(
        self,
        incoming: DataFrame,
        key: str,
        arrival: Sequence[str] = (),
        but: str | None = None,
        rows: int | None = None,
        batches: DataFrame | None = None,
    ) -> DataFrame:
        """Of incoming the first row of each key that the index does not hold.

        incoming is read several times: persist it.  With few rows its keys are broadcast
        to the index, which is then filtered where it is scanned.
        """
        keys = incoming.where(F.col(key).isNotNull()).select(key).distinct()
        held = self.candidates(keys, key, but, batches).select(F.col("key").alias("_held"))
        if rows is not None and rows <= BROADCAST_KEY_LIMIT:
            held = held.join(F.broadcast(keys.select(F.col(key).cast("string").alias("_held"))), "_held", "left_semi")
        fresh = first_per_key(incoming, key, arrival)
        return fresh.join(held.distinct(), F.col(key).cast("string") == F.col("_held"), "left_anti")

    def compact(self, into: str) -> None:
        """Write all keys as the one batch `into` beside the index; swap the folders when no
        job runs on it."""
        KeyIndex(self.spark, f"{self.root}_compacted", self.buckets, self.expected).add(self.scan().select("key"), "key", into)
