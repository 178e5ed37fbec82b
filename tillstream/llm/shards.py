"""K-d tree shards: split at weighted medians along the widest dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.store import gapless, shuffle_parts, written

DIMENSIONS = ("n_chars", "lang", "source")
TIE_BITS, SCALE_BITS = 32, 31
HOT = 1000  # values of a text dimension that are broadcast, at most
CLOSE = 0.0005  # a cut is near enough when what lies in its bin is that share of the node


def _coordinate(name: str, kind: str) -> Column:
    """A dimension as a number in the order of its values; texts are ranked later."""
    if kind == "string":
        return F.col(name)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def _ranked(points: DataFrame, name: str) -> DataFrame:
    """points with the text column name as the rank of its value among the different values, from 0.

    Ranks are counted over ranges of values.  Values of a large share of the rows, at most
    HOT, are broadcast, so that no task holds the rows of one; the others meet in a shuffle.
    """
    spark = points.sparkSession
    values = points.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    ranged = values.repartitionByRange(shuffle_parts(spark), name).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "values")
    begins, n, total = [], 0, 0
    for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("d"), F.sum("_n").alias("n")).orderBy("_part").collect():
        begins.append((r["_part"], n))
        n, total = n + r["d"], total + r["n"]
    table = spark.createDataFrame(begins, "_part int, _begin long")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(name)) - 1
    ranks = ranged.withColumn("_rank", rank).join(F.broadcast(table), "_part")
    ranks = ranks.select(name, (F.col("_begin") + F.col("_rank")).cast("double").alias("_x"), "_n")
    columns = [F.col("_x").alias(name) if c == name else F.col(c) for c in points.columns]
    if n <= HOT:
        return points.join(F.broadcast(ranks.drop("_n")), name, "left").select(*columns)
    ranks = written(ranks, "ranks")
    hot = F.col("_n") * HOT > total
    some = points.join(F.broadcast(ranks.where(hot).drop("_n")), name, "left")
    rest = F.col("_x").isNull() & F.col(name).isNotNull()
    others = some.where(rest).drop("_x").join(ranks.where(~hot).drop("_n").hint("shuffle_merge"), name)
    return some.where(~rest).select(*columns).unionByName(others.select(*columns))


def _key(dims: list[str], chosen: Column) -> Column:
    """The coordinate of the chosen dimension, then the tie-break, as one ascending number."""
    value = F.lit(None).cast("long")
    for k, name in enumerate(dims):
        value = F.when(chosen == k, F.col(name)).otherwise(value)
    return F.shiftleft(value, TIE_BITS) + F.col("tie")


def kd_shards(docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None,
              dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of docs (doc_id, text and metadata columns).

    size is the text's UTF-8 bytes and 1, a null text has none.  The tree has so many
    leaves that each has about target_bytes, or as many as shards says; a node with k
    leaves is cut where floor(k / 2) / k of its bytes lie below.  The cut is found by
    histograms of the node's rows, refined until the bin that holds it is a negligible
    share; rows with equal coordinates are parted by a random tie-break that is stored
    with them, so ties and repeated rows spread and one hot value can be cut.  A null
    coordinate comes first, texts count by the rank of their value; dimensions that docs lacks or that are constant are not used.
    Every row gets a shard; slots number a shard from 0 without a gap.  A null doc_id
    stays null, repeated rows are rows of their own, other columns are ignored, and an
    empty table gives no row.  The driver sees one row a node at a time.
    """
    spark = docs.sparkSession
    names = [d for d in dimensions if d in docs.columns]
    kinds = dict(docs.dtypes)
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    raw = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[_coordinate(d, kinds[d]).alias(f"x{k}") for k, d in enumerate(names)],
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << TIE_BITS)).alias("tie"),
    )
    raw = written(raw, "points")
    texts = [f"x{k}" for k, d in enumerate(names) if kinds[d] == "string"]
    for name in texts:
        raw = _ranked(raw, name)
    if texts:
        raw = written(raw, "points")
    low_high = [f(f"x{k}").alias(f"{n}{k}") for k in range(len(names)) for n, f in (("lo", F.min), ("hi", F.max))]
    whole = raw.agg(F.sum("size").alias("size"), *low_high).first()
    total = whole["size"] or 0
    leaves = shards or max(1, math.ceil(total / target_bytes))
    dims = []
    columns = []
    for k in range(len(names)):
        lo, hi = whole[f"lo{k}"], whole[f"hi{k}"]
        if lo is None:
            continue
        scale = ((1 << SCALE_BITS) - 2) / (hi - lo) if hi > lo else 0.0
        columns.append(F.coalesce(F.floor((F.col(f"x{k}") - lo) * scale) + 1, F.lit(0)).cast("long").alias(f"c{k}"))
        dims.append(f"c{k}")
    if not dims:
        dims, columns = ["c0"], [F.lit(0).cast("long").alias("c0")]
    points = raw.select("doc_id", "size", "text_crc32", "tie", *columns, F.lit(0).alias("node"))

    nodes = {0: (0, leaves)}  # node: first leaf and number of leaves; a node is named by its first leaf
    level = 0
    while any(n > 1 for _, n in nodes.values()) and total:
        splitting = {node: n for node, (_, n) in nodes.items() if n > 1}
        spread = points.groupBy("node").agg(
            F.sum("size").alias("size"), *[(F.max(d) - F.min(d)).alias(f"s_{d}") for d in dims]
        )
        state = {}
        for r in spread.collect():  # one row a node
            if r["node"] in splitting:
                n = splitting[r["node"]]
                widest = max(range(len(dims)), key=lambda k, r=r: r[f"s_{dims[k]}"])
                state[r["node"]] = {
                    "dim": widest, "want": r["size"] * (n // 2) / n, "size": r["size"], "below": 0, "lo": 0,
                    "bits": SCALE_BITS + TIE_BITS,
                }
        step = max(8, 17 - max(1, len(state)).bit_length())
        active = dict(state)
        while active:
            rows = [
                (node, s["dim"], s["lo"], max(0, s["bits"] - step), s["bits"], float(s["want"] - s["below"]))
                for node, s in active.items()
            ]
            table = spark.createDataFrame(rows, "node int, dim int, lo long, shift int, bits int, wanted double")
            key = _key(dims, F.col("dim")) - F.col("lo")
            inside = points.join(F.broadcast(table), "node").withColumn("key", key)
            inside = inside.where((F.col("key") >= 0) & (F.expr("shiftright(key, bits) = 0")))
            counted = inside.groupBy("node", "wanted", F.expr("shiftright(key, shift)").alias("bin")).agg(F.sum("size").alias("size"))
            # Of a node's bins, 2 ** step at most, the first up to which there is enough.
            running = counted.withColumn("upto", F.sum("size").over(Window.partitionBy("node").orderBy("bin")))
            enough = F.when(F.col("upto") >= F.col("wanted"), F.struct("bin", "upto", "size"))
            chosen = running.groupBy("node").agg(F.min(enough).alias("hit"), F.max(F.struct("bin", "upto")).alias("last"))
            found = {r["node"]: r for r in chosen.collect()}  # one row a node
            for node, s in list(active.items()):
                shift = max(0, s["bits"] - step)
                below, at, size = s["below"], s["lo"], 0
                if node in found:
                    hit, last = found[node]["hit"], found[node]["last"]
                    at += (hit or last)["bin"] << shift
                    size = hit["size"] if hit else 0
                    below += (hit or last)["upto"] - size
                s.update(below=below, lo=at, bits=shift)
                if shift == 0 or size <= CLOSE * s["size"]:
                    # The cut is before or behind this bin, whichever is nearer.
                    s["cut"] = at if s["want"] - below <= below + size - s["want"] else at + (1 << shift)
                    del active[node]
        cuts = [(node, s["dim"], s["cut"], node + splitting[node] // 2) for node, s in state.items()]
        table = spark.createDataFrame(cuts, "node int, dim int, cut long, upper int")
        moved = points.join(F.broadcast(table), "node", "left")
        upper = F.coalesce(_key(dims, F.col("dim")) >= F.col("cut"), F.lit(False))
        points = moved.withColumn("node", F.when(upper, F.col("upper")).otherwise(F.col("node"))).drop("dim", "cut", "upper")
        following = {}
        for node, (first, n) in nodes.items():
            half = n // 2
            if n > 1:
                following[node] = (first, half)
                following[node + half] = (first + half, n - half)
            else:
                following[node] = (first, n)
        nodes = following
        level += 1
        if level % 4 == 0:
            points = written(points, "points")
    done = points.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))
    slots = gapless(done, ["shard"], ["doc_id", "text_crc32", "tie"], "slot", shuffle_parts(spark))
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")
