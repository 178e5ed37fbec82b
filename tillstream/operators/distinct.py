"""Exact distinct counts that can be merged: bitmaps over dense numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.keyed import BROADCAST_KEY_LIMIT
from tillstream.schemas import LONG, STRING, columns
from tillstream.sources.tables import Lake

NUMBERS = columns(key=STRING, number=LONG)


def numbered(keys: DataFrame, key: str, after: int, parts: int) -> DataFrame:
    """key and number: distinct keys numbered from after + 1 without a gap.

    Keys are ranked inside the parts of their hash, and a part begins where the parts
    before it end, so no task ranks all; the table of parts has `parts` rows.
    """
    dealt = keys.select(F.col(key).cast("string").alias("key")).distinct().withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("key"))
    ranked = dealt.withColumn("_rank", rank).join(F.broadcast(begins), F.col("_part") == F.col("_of"))
    return ranked.select("key", (F.lit(after) + F.col("_begin") + F.col("_rank")).cast("long").alias("number"))


class NumberedKeys:
    """A dictionary of keys that gives each a number, from 1 without gaps, in order of arrival.

    Kept as a table of a lake, by batch: a batch that is run again gives the same keys the
    same numbers as long as no later batch has been written.
    """

    def __init__(self, lake: Lake, name: str, parts: int = 64):
        self.lake, self.name, self.parts = lake, name, parts

    def take_in(self, keys: DataFrame, key: str, batch: str) -> DataFrame:
        """Number the new ones of keys and return key and number of all of them.

        The batch's distinct keys are found once and kept while they are numbered.  Of the
        dictionary only they are kept where it is scanned, if they are few enough to be
        broadcast.
        """
        wanted = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key")).distinct()
        held = self.lake.other_batches(self.name, batch, NUMBERS, "staging").select("key", "number")
        last = held.agg(F.max("number")).first()[0] or 0
        wanted = wanted.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            few = wanted.count() <= BROADCAST_KEY_LIMIT
            known = held.join(F.broadcast(wanted) if few else wanted, "key", "left_semi")
            unknown = wanted.join(known, "key", "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self.lake.write_batch(numbered(unknown, "key", last, self.parts), self.name, batch, NUMBERS, "staging")
            finally:
                unknown.unpersist()
        finally:
            wanted.unpersist()
        stored = self.lake.batches(self.name, NUMBERS, "staging").where(F.col("batch_id") == batch)
        return known.unionByName(stored.select("key", "number"))


def bitmaps(rows: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """by, bucket, bitmap: the different numbers of each group, 32,768 to a bitmap of 4 KB."""
    at = F.col(number)
    return rows.groupBy(*by, F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")
    )


def merged(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of bitmaps per group of by: also of several batches, or hours of a day."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many different numbers each group of by has."""
    return merged(maps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))
