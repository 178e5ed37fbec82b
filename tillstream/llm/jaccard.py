"""Similarity join of word-shingle sets by parity sketches.

Two documents link when 100 * |A and B| >= 80 * |A or B| for their sets of 5-word shingles.

A sketch has one bit a shingle hash may flip; equal shingles flip the same bit, so the
Hamming distance of two sketches is at most the symmetric difference of the sets.  A
sketch is cut into more cells than the sets of a size band may differ in, so linked sets
agree in whole cells.  If D is the largest difference of a set to any partner and more
than D of its cells are not empty, it agrees with each partner in a cell that is among
the first D + 1 of both in one common order of cells; only these are sent, those with most
shingles first.  Documents meet on equal cells.

Shingles that are frequent in a bounded sample are left out of these sketches, which only
lowers the difference, so that documents do not meet on what very many share.  Sets with
too few cells left are sketched again from all shingles, with other seeds if need be; of
two linked sets one that had enough cells is enough, so these meet among themselves.

Equal sets are one class from the start.  A group of classes that meet on a cell is
verified as a star around its first class, and each class with a few members of its
largest group.  What is still apart is compared block by block in full, once for all
groups that overlap.  So copies are never multiplied into pairs, and no
link between components is lost.  A pair whose whole sketches are too far apart is
dropped, the others are verified on their sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.graph import components
from tillstream.llm.store import ship_code, shuffle_parts, written
from tillstream.llm.textblock import Texts, blocks, mix, shingles

WIDTH = 5
SEEDS = 24  # sketches of a set with too many empty cells; after them its empty cells count, too
CELL_BITS = 12
FLUSH_KEYS = 1_000_000
PARTNERS = 8  # members of its largest group that a class is tried with at first
BLOCK = 2048  # classes of a block that are compared with those of another
GATHER = 20_000  # classes that overlapping groups may have together
SAMPLE = 4096  # different texts that frequent shingles are taken from, about
OFTEN = 4  # texts of the sample that have a frequent shingle
MOST_FREQUENT = 1_000_000  # frequent shingles, at most
_U = np.uint64


@lru_cache(maxsize=1)
def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band starts, and for the joint of bands j and j + 1: largest difference, cells.

    A partner of a set of n shingles has at most 1.25 n: it lies in the same band or the
    next.  Linked sets differ in at most a quarter of the smaller set.
    """
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 5 // 4)))
    starts_ = np.array(starts, np.int64)
    differ = (starts_[1:] - 1) // 4
    return starts_, differ, differ + 2 + differ // 4


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each text's begin."""
    low = texts.lower()
    starts, ends, firsts = low.words()
    h, at = shingles(low.hashes(starts, ends), firsts, WIDTH)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[at[:-1][at[:-1] < at[1:]]] = True
    return h[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def classes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; equal sets have equal names."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(h ^ _U(0x5851F42D4C957F2D)))])
    return mix((sums[at[1:]] - sums[at[:-1]]) + mix(np.diff(at).astype(_U))).view(np.int64)


def sketches(h: np.ndarray, at: np.ndarray) -> list[bytes]:
    """A bit sketch of each set, of a power of two of bits and at least twice its size."""
    size = np.diff(at)
    bits = np.left_shift(1, np.maximum(6, np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64)))
    begin = np.concatenate([[0], np.cumsum(bits)])
    who = np.repeat(np.arange(len(size)), size)
    flips = begin[who] + (mix(h + _U(0x1B873593)) & (bits[who] - 1).astype(_U)).astype(np.int64)
    raw = np.packbits(np.bincount(flips, minlength=begin[-1]).astype(np.uint8) & 1).tobytes()
    cut = (begin // 8).tolist()
    return [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def may_link(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """Whether sets of these sketches and sizes can be similar enough."""
    if 100 * min(n_a, n_b) < 80 * max(n_a, n_b):
        return False
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    # 100 * (n_a + n_b - d) / 2 >= 80 * (n_a + n_b + d) / 2
    return 180 * int(np.bitwise_count(x ^ y).sum()) <= 20 * (n_a + n_b)


class Frequent:
    """Shingles that many texts have: a bounded table."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(_U))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes >> _U(44)).astype(np.int64)] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        out = self.bits[(h >> _U(44)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            place = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
            out[some] = self.hashes[place] == h[some]
        return out


def cell_keys(h: np.ndarray, at: np.ndarray, frequent: Frequent | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells of each set's sketches that are sent, and the set each belongs to."""
    starts, differ, cells = _bands()
    size = np.diff(at)
    band = np.searchsorted(starts, size, side="right") - 1
    rare = None if frequent is None or not len(frequent.hashes) else ~frequent.among(h)
    keys, owners = [], []
    for lower in (0, 1):
        joint = band - lower
        live = np.flatnonzero((size > 0) & (joint >= 0))
        for seed in range(0 if rare is not None else 1, SEEDS + 1):
            if not len(live):
                break
            n = size[live]
            begin = np.concatenate([[0], np.cumsum(n)])
            who = np.repeat(np.arange(len(live)), n)
            source = at[live][who] + np.arange(begin[-1]) - begin[:-1][who]
            if seed == 0:
                keep = rare[source]
                source, who = source[keep], who[keep]
            many = cells[joint[live]].astype(_U)
            x = h[source] if seed < 2 else mix(h[source] + _U(seed))
            # The bit a hash flips: its cell, and the place inside the cell.
            cell = ((x >> _U(32)) * many[who]) >> _U(32)
            bit = mix(x) >> _U(64 - CELL_BITS)
            where = (who.astype(_U) << _U(40)) | cell
            if seed > 1:
                order = np.argsort(where, kind="stable")
                where, bit = where[order], bit[order]
            most = np.minimum(differ[joint[live]], n // 4)  # the largest difference to a partner
            if len(where):
                first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
                place = where[first]
                whose, number = (place >> _U(40)).astype(np.int64), place & _U((1 << 40) - 1)
                word = mix(((where & _U((1 << 40) - 1)) << _U(CELL_BITS)) + bit + _U(1))
                tag = mix((joint[live][whose].astype(_U) << _U(32)) + _U(seed) * _U(0x100000001B3) + mix(number))
                key = mix(np.bitwise_xor.reduceat(word, first) ^ tag)
                fat = np.diff(np.append(first, len(where)))
                order = np.lexsort((key, -fat, whose))
                rank = np.arange(len(order)) - np.searchsorted(whose[order], whose[order])
                order = order[rank <= most[whose[order]]]
                keys.append(key[order])
                owners.append(live[whose[order]])
            else:
                whose, number = np.zeros(0, np.int64), np.zeros(0, _U)
            poor = np.bincount(whose, minlength=len(live)) <= most
            if seed == SEEDS and poor.any():
                for k in np.flatnonzero(poor):
                    held = set(number[whose == k].tolist())
                    empty = np.array([c for c in range(int(many[k])) if c not in held], _U)
                    keys.append(mix(mix(_U(joint[live[k]]) + (empty << _U(20))) + _U(3)))
                    owners.append(np.full(len(empty), live[k]))
            live = live[poor]
    if not keys:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


_PACKED = "bucket int, keys binary, which binary, names binary, sizes binary"


def _emit_keys(parts: int, frequent: Frequent):
    """Tasks' cells, packed: a row for each bucket with its keys, sets and their sizes."""

    def pack(keys, owner, names, sizes) -> pa.RecordBatch:
        bucket = (keys % _U(parts)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, owner = keys[order], owner[order]
        cut = np.searchsorted(bucket[order], np.arange(parts + 1))
        rows: dict = {"bucket": [], "keys": [], "which": [], "names": [], "sizes": []}
        for k in np.flatnonzero(np.diff(cut)):
            a, b = cut[k], cut[k + 1]
            seen, which = np.unique(owner[a:b], return_inverse=True)
            rows["bucket"].append(int(k))
            rows["keys"].append(keys[a:b].tobytes())
            rows["which"].append(which.astype(np.uint32 if len(seen) > 1 << 16 else np.uint16).tobytes())
            rows["names"].append(names[seen].tobytes())
            rows["sizes"].append(sizes[seen].astype(np.uint32).tobytes())
        kinds = [pa.int32(), *[pa.binary()] * 4]
        return pa.record_batch({n: pa.array(v, t) for (n, v), t in zip(rows.items(), kinds, strict=True)})

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        n_keys = n_sets = 0
        for _, texts in blocks(batches, "text"):
            h, at = shingle_sets(texts)
            names = classes(h, at)
            _, first = np.unique(names, return_index=True)  # copies in a block meet here
            first = first[np.diff(at)[first] > 0]
            sizes = np.diff(at)[first]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            who = np.repeat(np.arange(len(first)), sizes)
            keys, owner = cell_keys(h[at[first][who] + np.arange(begin[-1]) - begin[:-1][who]], begin, frequent)
            held.append((keys, owner + n_sets, names[first], sizes))
            n_keys, n_sets = n_keys + len(keys), n_sets + len(first)
            if n_keys > FLUSH_KEYS:
                yield pack(*[np.concatenate(x) for x in zip(*held, strict=True)])
                held, n_keys, n_sets = [], 0, 0
        if n_keys:
            yield pack(*[np.concatenate(x) for x in zip(*held, strict=True)])

    return emit


def _meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different groups of sets that meet on a cell in this partition: as sorted members."""
    keys, names, sizes = [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            k = np.frombuffer(row["keys"], _U)
            name, size = np.frombuffer(row["names"], np.int64), np.frombuffer(row["sizes"], np.uint32)
            which = np.frombuffer(row["which"], np.uint32 if len(name) > 1 << 16 else np.uint16)
            keys.append(k)
            names.append(name[which])
            sizes.append(size[which])
    if not keys:
        return
    key, name, size = np.concatenate(keys), np.concatenate(names), np.concatenate(sizes)
    del keys, names, sizes
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    order, key = order[same], key[same]
    name, size = name[order], size[order]
    order = np.lexsort((name, key))
    key, name, size = key[order], name[order], size[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name, size = key[fresh], name[fresh], size[fresh]
    if not len(key):
        return
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    many = np.diff(np.append(first, len(key)))
    sign = np.add.reduceat(mix(name.view(_U)), first)
    _, take, times = np.unique(sign, return_index=True, return_counts=True)
    for k, count in zip(take, times, strict=True):
        if many[k] > 1:
            a, b = first[k], first[k] + many[k]
            yield pa.record_batch(
                {
                    "sign": pa.array([sign[k]]).view(pa.int64()),
                    "times": pa.array([count], pa.int64()),
                    "members": pa.array([name[a:b].tolist()], pa.list_(pa.int64())),
                }
            )


def _frequent(docs: DataFrame) -> Frequent:
    """Shingles that OFTEN texts of a sample have.  Which they are changes the work, not the result."""
    every = max(1, docs.count() // SAMPLE)
    picked = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct().repartition(1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [shingle_sets(texts)[0] for _, texts in blocks(batches, "text")]
        if found:
            h, n = np.unique(np.concatenate(found), return_counts=True)
            often = np.flatnonzero(n >= OFTEN)
            often = often[np.argsort(-n[often], kind="stable")][:MOST_FREQUENT]
            yield pa.record_batch({"h": pa.array(h[often].view(np.int64))})

    rows = picked.mapInArrow(count, "h long").toArrow()  # MOST_FREQUENT at most
    return Frequent(np.asarray(rows["h"].combine_chunks()).view(_U) if rows.num_rows else np.zeros(0, _U))


def _fetch_sets(docs: DataFrame, meta: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, hashes) of the wanted classes, from the text of one document each."""
    first = meta.join(wanted, "name", "left_semi").groupBy("name").agg(F.min("row").alias("row"))
    first = written(first.select("row").distinct(), "wanted")  # its size is known: a small one is broadcast
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    found = rows.join(first, "row", "left_semi").select("text")

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, "text"):
            h, at = shingle_sets(texts)
            raw, cut = h.tobytes(), (8 * at).tolist()
            yield pa.record_batch(
                {
                    "name": pa.array(classes(h, at)),
                    "hashes": pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                }
            )

    return written(found.mapInArrow(sets, "name long, hashes binary").dropDuplicates(["name"]), "sets")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets of different hashes are similar enough."""
    if 100 * min(len(a), len(b)) < 80 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _near(pairs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches (name, n, sketch) are near enough."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("x", "n_x", "y", "n_y")]
            good = [may_link(*row) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = drawn.select(F.col("name").alias("a"), F.col("n").alias("n_x"), F.col("sketch").alias("x"))
    right = drawn.select(F.col("name").alias("b"), F.col("n").alias("n_y"), F.col("sketch").alias("y"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(check, "a long, b long")


def _apart(flat: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of groups (sign, name) that are not in one component yet: also comp, and main
    (whether comp has most of the group's members)."""
    named = flat.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("comp", F.coalesce("root", "name"))
    sizes = named.groupBy("sign", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("sign").agg(F.max(F.struct("n", "comp")).alias("m"), F.count(F.lit(1)).alias("comps"))
    main = main.where("comps > 1").select("sign", F.col("m.comp").alias("main"))
    return named.join(main, "sign").select("sign", "name", "comp", (F.col("comp") == F.col("main")).alias("main"))


def _partners(flat: DataFrame) -> DataFrame:
    """(a, b): each class with some members of the largest group it is in, the first by hash."""
    hashes = [F.xxhash64("name", F.lit(k)) for k in range(PARTNERS)]
    first = [F.min(F.struct(h.alias("h"), "name"))["name"].alias(f"p{k}") for k, h in enumerate(hashes)]
    hubs = flat.groupBy("sign").agg(F.count(F.lit(1)).alias("n"), *first)
    found = F.max(F.struct("n", *[f"p{k}" for k in range(PARTNERS)])).alias("hub")
    chosen = flat.select("sign", "name").join(hubs, "sign").groupBy("name").agg(found)
    partners = F.array_distinct(F.array(*[F.col(f"hub.p{k}") for k in range(PARTNERS)]))
    return chosen.select(F.explode(partners).alias("a"), F.col("name").alias("b")).where("a <> b")


def _near_in_blocks(apart: DataFrame, drawn: DataFrame) -> DataFrame:
    """All pairs of different components that meet in a group and have near sketches.

    Groups that share components overlap, so they are put together first and each pair is
    looked at once; where that gathers more than GATHER classes the groups stay as they
    are.  A unit of work holds two blocks: some classes outside the largest component, and
    some of all.  Sketches are compared as arrays and only near pairs come out.
    """
    comps = apart.select("sign", "comp").distinct()
    least = comps.groupBy("sign").agg(F.min("comp").alias("least"))
    joined = components(comps.join(least, "sign").select(F.col("comp").alias("a"), F.col("least").alias("b")).where("a <> b"))
    classes_ = apart.select("name", "comp").distinct().join(joined.withColumnRenamed("node", "comp"), "comp")
    counted = classes_.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    whole = classes_.join(counted.where(f"members <= {GATHER}").select("root"), "root")
    main = whole.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.max(F.struct("n", "comp"))["comp"].alias("m"))
    whole = whole.join(main, "root").select(F.col("root").alias("unit"), "name", "comp", (F.col("comp") == F.col("m")).alias("main"))
    large = counted.where(f"members > {GATHER}").select("root")
    single = apart.join(joined.withColumnRenamed("node", "comp"), "comp").join(large, "root", "left_semi")
    rows = written(whole.unionByName(single.select(F.col("sign").alias("unit"), "name", "comp", "main")), "units")
    sizes = rows.groupBy("unit").agg(
        F.ceil(F.count(F.when(~F.col("main"), 1)) / BLOCK).alias("xs"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("ys")
    )
    dealt = rows.join(sizes, "unit").withColumn("h", F.xxhash64("name"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = dealt.where("not main").select("unit", "name", "comp", F.lit(True).alias("left"), F.pmod("h", "xs").alias("i"), each("ys").alias("j"))
    right = dealt.select("unit", "name", "comp", F.lit(False).alias("left"), each("xs").alias("i"), F.pmod("h", "ys").alias("j"))

    def check(unit: pa.Table) -> pa.Table:
        name, comp = np.asarray(unit["name"]), np.asarray(unit["comp"])
        n, side = np.asarray(unit["n"]), np.asarray(unit["left"])
        drawn_ = [np.frombuffer(x, _U) for x in unit["sketch"].to_pylist()]
        words = np.array([len(x) for x in drawn_])
        found: list = []
        for width in np.unique(words[side]):
            x = np.flatnonzero(side & (words == width))
            # Partners have sketches as wide, or half or twice as wide; the wider are folded.
            for other in (width, width // 2, width * 2):
                y = np.flatnonzero(~side & (words == other))
                if not len(y):
                    continue
                p, q = np.array([drawn_[k] for k in x]), np.array([drawn_[k] for k in y])
                if other > width:
                    q = q[:, :width] ^ q[:, width:]
                elif other < width:
                    p = p[:, :other] ^ p[:, other:]
                for r, k in enumerate(x):
                    fits = (100 * np.minimum(n[k], n[y]) >= 80 * np.maximum(n[k], n[y])) & (comp[y] != comp[k])
                    at = np.flatnonzero(fits)
                    apart_ = np.bitwise_count(q[at] ^ p[r]).sum(axis=1, dtype=np.int64)
                    at = at[180 * apart_ <= 20 * (n[k] + n[y[at]])]
                    found += [(int(name[k]), int(name[y[t]])) for t in at]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    units = left.unionByName(right).join(drawn, "name").groupBy("unit", "i", "j").applyInArrow(check, "a long, b long")
    return units.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verify(pairs: DataFrame, docs: DataFrame, meta: DataFrame) -> DataFrame:
    """Links (a, b) among the pairs: those of a task join what all its pairs that link join.

    A pair whose ends the task has joined already adds nothing and is not compared, so many
    pairs of one group leave a task as links of a tree.
    """
    pairs = written(pairs, "near")
    sets = _fetch_sets(docs, meta, pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct())

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(i: int) -> int:
            while (up := root.setdefault(i, i)) != i:
                root[i] = root[up]
                i = up
            return i

        for batch in batches:
            good = []
            for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                p, q = find(a), find(b)
                good.append(p != q and bool(linked(np.frombuffer(x, _U), np.frombuffer(y, _U))))
                if good[-1]:
                    root[p] = q
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("name").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("name").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(check, "a long, b long")


def _placed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, root) of docs: row is a hash of id and text, root names the component."""
    spark = docs.sparkSession
    ship_code(spark)
    parts = shuffle_parts(spark)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            h, at = shingle_sets(texts)
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"], "row": batch["row"], "n": pa.array(np.diff(at)), "name": pa.array(classes(h, at)),
                    "sketch": pa.array(sketches(h, at), pa.binary()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    full = written(rows.mapInArrow(describe, "doc_id long, row long, n long, name long, sketch binary"), "classes")
    meta = full.drop("sketch")

    packed = docs.select("text").mapInArrow(_emit_keys(parts, _frequent(docs)), _PACKED)
    met = packed.repartitionById(parts, F.col("bucket")).mapInArrow(_meet, "sign long, times long, members array<long>")
    groups = written(met, "groups")
    wanted = groups.select(F.explode("members").alias("name")).distinct()
    drawn = full.select("name", "n", "sketch").join(wanted, "name", "left_semi").groupBy("name").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    drawn = written(drawn, "sketches")

    flat = groups.select("sign", F.explode("members").alias("name")).distinct()
    flat = written(flat, "members")

    # Each class with the first class of a group that it meets most often, and with some
    # members of its largest group.
    stars = groups.select(F.get("members", 0).alias("a"), F.explode(F.slice("members", 2, F.size("members") - 1)).alias("b"), "times")
    counted = stars.groupBy("a", "b").agg(F.sum("times").alias("times"))
    best = counted.groupBy("b").agg(F.max(F.struct("times", "a"))["a"].alias("a")).select("a", "b")
    tried = best.unionByName(_partners(flat)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = written(_verify(_near(tried, drawn), docs, meta), "verified")

    # Groups whose members are still apart.
    linked = components(links)
    apart = written(_apart(flat, linked), "apart")
    more = _verify(_near_in_blocks(apart, drawn), docs, meta)
    # What was linked so far goes on as stars, which are fewer links than made them.
    known = linked.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(known.unionByName(more)).withColumnRenamed("node", "name")
    root = F.when(F.col("n") > 0, F.coalesce("root", "name")).alias("root")
    return meta.join(roots, "name", "left").select("row", "doc_id", "n", root)


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of docs (doc_id, text).

    A text of fewer than WIDTH words has its whole sequence as the only shingle; a null
    text or one without words has none and links with nothing.  Repeated rows and equal
    texts are linked.  A null doc_id is never the smallest of a component with others.
    Other columns are ignored; an empty table gives an empty one.  Shingles and sets are
    named by 64-bit hashes.
    """
    placed = _placed(docs)
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each_component(docs: DataFrame) -> DataFrame:
    """docs without those that are linked, over any number of links, to one that stays.

    The row with the smallest doc_id stays, nulls last; of rows with equal id and text
    one stays.  Texts without words are linked with nothing and all stay.
    """
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    placed = _placed(docs).where("root is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("_row")
    chosen = placed.groupBy("root").agg(first).select("_row")
    rows = docs.where(has_word).withColumn("_row", F.xxhash64("doc_id", "text"))
    kept = rows.join(chosen, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.select(*docs.columns).unionByName(docs.where(~has_word))
