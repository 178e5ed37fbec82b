"""Primary-key operators: first row per key, insert-if-absent, key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most this many keys are broadcast against a large table.
BROADCAST_KEY_LIMIT = 1_000_000


def only_keys_of(df: DataFrame, few: DataFrame, key: str, limit: int = BROADCAST_KEY_LIMIT) -> DataFrame:
    """Rows of df whose key occurs in few, if few is small; else df as it is.

    For reports over a short time: the keys in question are counted, and broadcast to
    filter the scan of df if there are at most `limit`.  Beyond it df is not filtered,
    because a shuffled join would move all of its rows; the caller joins on the key
    anyway, after reducing df.
    """
    keys = few.where(F.col(key).isNotNull()).select(key)
    if keys.count() > limit:
        return df
    return df.join(F.broadcast(keys.distinct()), key, "left_semi")


def first_per_key(df: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """The earliest row of each non-NULL key by the arrival columns, unknown ones last.

    An aggregate rather than a ranked window: copies of a key are reduced on the map
    side, so a key that holds a large share of the rows does not land in one task.
    Equal arrivals fall back to the smallest whole row, which keeps the choice fixed.
    """
    others = [c for c in df.columns if c != key]
    order = [c for name in arrival for c in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))]
    ranked = F.struct(*order, F.struct(*others).alias("_row"))
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ranked)["_row"].alias("_row"))
    return first.select(*[key if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def insert_if_absent(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    arrival: Sequence[str] = (),
    incoming_rows: int | None = None,
) -> DataFrame:
    """Rows of incoming to append: first per key, and only keys not in existing.

    When the caller knows that the batch is small (incoming_rows), its keys are
    broadcast to filter the scan of the existing keys, and that table is not
    shuffled.  Otherwise both sides meet in a shuffled anti join; existing keys are
    made distinct first, on the same partitioning.
    """
    fresh = first_per_key(incoming, key, arrival)
    keys = existing.where(F.col(key).isNotNull()).select(key)
    if incoming_rows is not None and incoming_rows <= BROADCAST_KEY_LIMIT:
        batch_keys = incoming.where(F.col(key).isNotNull()).select(key).distinct()
        keys = keys.join(F.broadcast(batch_keys), key, "left_semi")
    return fresh.join(keys.distinct(), key, "left_anti").select(*incoming.columns)


def missing_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row per key of child: key, rows, missing (no parent has the key).

    Children are counted per key before the join, so a parent with very many
    children, or very many NULL keys, is one row in the shuffle output of each task.
    A NULL key has no parent.
    """
    parents = parent.where(F.col(key).isNotNull()).select(key).distinct()
    return (
        child.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(parents.withColumn("_found", F.lit(True)), key, "left")
        .select(key, "rows", F.col("_found").isNull().alias("missing"))
    )
