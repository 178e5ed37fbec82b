"""As-of join: the latest reading of a key, not older than a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.clock import epoch_micros

# Left rows of one (key, slot) are spread over tasks of about this many rows.
ROWS_PER_TASK = 1_000_000
FREE_SALTS = 4096
SLOTS_PER_TOLERANCE = 300


def latest_within(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    tolerance_seconds: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """left plus `reading`, the newest right row with right_ts <= left_ts.

    `reading` is a struct of the right columns other than the key, NULL when there is
    none within the tolerance.  Of several readings of one key at one instant the
    largest is taken.

    No pairs are formed.  Time is cut into slots; each slot sees its own readings and
    one reading carried in from the slots before it, and a running `last` over the
    merged timeline answers every left row in one pass.  What one task holds is bounded
    for any distribution of keys: a slot has at most one reading per microsecond and
    key after reduction, and the left rows of a crowded slot are spread over several
    salts, each with a copy of that slot's readings.  Rows without key or time have no
    answer and are spread freely.
    """
    slot_micros = max(tolerance_seconds // SLOTS_PER_TOLERANCE, 1) * 1_000_000
    slots_back = -(-tolerance_seconds * 1_000_000 // slot_micros)
    fields = [c for c in right.columns if c != key]

    events = left.withColumn("_at", epoch_micros(F.col(left_ts)))
    events = events.withColumn("_slot", F.floor(F.col("_at") / slot_micros))
    readings = (
        right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
        .groupBy(key, F.col(right_ts).alias("_ts"))
        .agg(F.max(F.struct(*fields)).alias("_reading"))
        .withColumn("_at", epoch_micros(F.col("_ts")))
        .withColumn("_slot", F.floor(F.col("_at") / slot_micros))
        .select(key, "_slot", "_at", "_reading")
    )

    crowds = (
        events.where(F.col(key).isNotNull() & F.col("_slot").isNotNull())
        .groupBy(key, "_slot")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # At most (all rows / rows_per_task) slots are crowded, so this side is small.
    crowded = crowds.where(F.col("_rows") > rows_per_task).select(
        key, "_slot", F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts")
    )
    crowded = F.broadcast(crowded)

    def salted_copies(df: DataFrame) -> DataFrame:
        return (
            df.join(crowded, [key, "_slot"], "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
            .drop("_salts")
        )

    carried = _carried_in(crowds, readings, key, slots_back)
    reading_type = readings.schema["_reading"].dataType
    seen_type = f"struct<_at: bigint, _reading: {reading_type.simpleString()}>"
    known = salted_copies(readings.unionByName(carried)).select(
        key, "_slot", "_salt", "_at",
        F.struct("_at", "_reading").alias("_seen"),
        F.lit(None).cast(left.schema).alias("_row"),
    )
    unanswerable = F.col(key).isNull() | F.col("_slot").isNull()
    salts = F.coalesce("_salts", F.when(unanswerable, F.lit(FREE_SALTS)), F.lit(1))
    # The input partition is hashed too, or equal rows would all get the same salt.
    # It does not depend on row order, so a retried task assigns the same salts.
    spread = F.xxhash64(F.spark_partition_id(), *_hashable(left))
    asked = (
        events.join(crowded, [key, "_slot"], "left")
        .withColumn("_salt", F.pmod(spread, salts).cast("int"))
        .select(
            key, "_slot", "_salt", "_at",
            F.lit(None).cast(seen_type).alias("_seen"),
            F.struct(*left.columns).alias("_row"),
        )
    )

    timeline = Window.partitionBy(key, "_slot", "_salt").orderBy("_at", F.col("_row").isNotNull())
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answered = (
        known.unionByName(asked)
        .withColumn("_seen", F.last("_seen", ignorenulls=True).over(so_far))
        .where(F.col("_row").isNotNull())
    )
    fresh = F.col("_at") - F.col("_seen._at") <= tolerance_seconds * 1_000_000
    return answered.select("_row.*", F.when(fresh, F.col("_seen._reading")).alias("reading"))


def _carried_in(crowds: DataFrame, readings: DataFrame, key: str, slots_back: int) -> DataFrame:
    """Per slot with left rows: the newest reading of the slots_back slots before it.

    The same running `last`, one level up, over blocks of slots_back slots.  A block
    has at most slots_back askers and 2 * slots_back readings per key.
    """
    newest = readings.groupBy(key, "_slot").agg(
        F.max(F.struct("_at", "_reading")).alias("_newest")
    )
    block = F.floor(F.col("_slot") / slots_back)
    offers = newest.select(
        key, "_slot", F.explode(F.array(block, block + 1)).alias("_block"), "_newest",
        F.lit(True).alias("_offer"),
    )
    asks = crowds.select(
        key, "_slot", block.alias("_block"),
        F.lit(None).cast(newest.schema["_newest"].dataType).alias("_newest"),
        F.lit(False).alias("_offer"),
    )
    # An ask sorts before the offer of its own slot: that one is not carried in.
    before = (
        Window.partitionBy(key, "_block")
        .orderBy("_slot", "_offer")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        offers.unionByName(asks)
        .withColumn("_newest", F.last("_newest", ignorenulls=True).over(before))
        .where(~F.col("_offer") & F.col("_newest").isNotNull())
        .select(key, "_slot", "_newest._at", "_newest._reading")
    )


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
