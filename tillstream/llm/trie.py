"""Prefix trie of conversations from the common prefixes of neighbours in sorted order.

Each partition of the sorted conversations builds its own forest with a union-find over
the edges between neighbours, the longest common prefix first.  A node that reaches past
the edge of its partition is open: its parts are named by the prefix and added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.store import ship_code, shuffle_parts, written

TURN = 16  # bytes that stand for a turn
RANGE_TURNS = 64  # turns by which conversations are dealt to partitions
PARTITION_TURNS = 500_000  # about so many turns are in a partition

FOREST = (
    "depth long, name binary, parent_name binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (digest of role and text, 16 bytes, and the text's code points) in order.

    Turns of conversations (conv_id, turn, role, text) are sorted by turn, nulls first, then
    role and digest; repeated rows are turns of their own; a null role or text is empty.
    Rows without a conv_id belong to no conversation and are left out; other columns are
    ignored.  Texts are not moved: 16 bytes a turn are, and the turns of one conversation
    meet in one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN))
    told = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(role, 1, 16).alias("role"),
            digest.alias("digest"),
            F.length(text).alias("size"),
        ).alias("t"),
    )
    whole = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pair = F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return whole.select("conv_id", pair.alias("turns"))


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sequence, conv_id): the digest of each sequence's ids, taken as they pass."""
    name, digest = None, None
    for batch in batches:
        names, hashes = [], []
        for s, c in zip(batch["sequence"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
            if s != name:
                if digest is not None:
                    names.append(name)
                    hashes.append(digest.hexdigest())
                name, digest = s, hashlib.sha256(b"%d" % c)
            else:
                digest.update(b",%d" % c)
        yield _ended(names, hashes)
    if digest is not None:
        yield _ended([name], [digest.hexdigest()])


def _ended(names: list[bytes], hashes: list[str]) -> pa.RecordBatch:
    return pa.record_batch({"sequence": pa.array(names, pa.binary()), "ends_sha256": pa.array(hashes, pa.string())})


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    most = min(len(a), len(b)) // TURN
    if a[: most * TURN] == b[: most * TURN]:
        return most
    least = 0
    while least + 1 < most:  # the first `least` turns are equal, the first `most` are not
        middle = (least + most) // 2
        if a[: middle * TURN] == b[: middle * TURN]:
            least = middle
        else:
            most = middle
    return least


class Forest:
    """The nodes over the sequences of one partition.

    left and right are the turns that the first and the last sequence share with their
    neighbours outside (-1: there is none).  A node belongs to the partition where its
    first sequence lies, so that what counts nodes counts each of them once.
    """

    def __init__(self, rows: list[tuple], left: int, right: int):
        self.keys = [r[0] for r in rows]
        self.sizes = [r[1] for r in rows]
        self.left, self.right = left, right
        m = len(rows)
        # Components: top node of each root, and the sequences it spans.
        self.root = list(range(m))
        self.first, self.last, self.top = list(range(m)), list(range(m)), list(range(m))
        # Nodes: one for the end of each sequence, others are made by merges.
        self.depth = [len(k) // TURN for k in self.keys]
        self.n = [r[2] for r in rows]
        self.least = [r[3] for r in rows]
        self.ends = [r[4] for r in rows]
        self.spans = [(i, i) for i in range(m)]
        self.children = [0] * m
        self.leaves = [0] * m
        self.saved = [0] * m
        self.out: list[list] = []
        edges = [common(a, b) for a, b in zip(self.keys[:-1], self.keys[1:], strict=True)]
        for i in range(m):
            follows = edges[i] if i + 1 < m else right
            self.leaves[i] = int(follows < self.depth[i])
        # Equal ones from left to right: then the right one of two components is never a node of
        # that depth itself, as all inside it share more.
        for i in sorted(range(m - 1), key=edges.__getitem__, reverse=True):
            self._merge(self._find(i), self._find(i + 1), edges[i])
        if m:
            self._close(self.top[self._find(0)], -1, None)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Two neighbouring components share depth turns: their tops get a node there."""
        node = self.top[a]
        if self.depth[node] != depth:
            node = len(self.depth)
            for values, new in (
                (self.depth, depth), (self.n, 0), (self.least, None), (self.ends, None), (self.spans, None),
                (self.children, 0), (self.leaves, 0), (self.saved, 0),
            ):
                values.append(new)
            self._close(self.top[a], depth, node)
        self._close(self.top[b], depth, node)
        # The larger component takes the smaller one in.
        keep, gone = (a, b) if self.last[a] - self.first[a] >= self.last[b] - self.first[b] else (b, a)
        self.root[gone] = keep
        self.first[keep], self.last[keep] = self.first[a], self.last[b]
        self.top[keep] = node
        self.spans[node] = (self.first[keep], self.last[keep])

    def _add(self, node: int, part: int) -> None:
        self.n[node] += self.n[part]
        found = [x for x in (self.least[node], self.least[part]) if x is not None]
        self.least[node] = min(found, default=None)
        self.leaves[node] += self.leaves[part]
        self.saved[node] += self.saved[part]

    def _reaches(self, span: tuple[int, int], depth: int) -> tuple[bool, bool]:
        """Whether a node goes on to the left and to the right of this partition."""
        return span[0] == 0 and depth <= self.left, span[1] == len(self.keys) - 1 and depth <= self.right

    def _close(self, node: int, above: int, parent: int | None) -> None:
        """All members of node are known: it and the single-child nodes between it and depth
        above are told, and the last one of them is added to parent."""
        span, sizes = self.spans[node], self.sizes[self.spans[node][0]]
        children, ends = self.children[node], self.ends[node]
        for depth in range(self.depth[node], above, -1):
            goes_left, goes_right = self._reaches(span, depth)
            size = sizes[depth - 1] if depth else 0
            self.saved[node] += self.n[node] * size - (0 if goes_left else size)
            row = [depth, parent if depth == above + 1 else node, span[0], goes_left or goes_right]
            row += [self.least[node], self.n[node], children, self.leaves[node], self.saved[node], ends]
            self.out.append(row)
            children, ends = int(not goes_left), None
        if parent is not None:
            self._add(parent, node)
            self.children[parent] += children

    def rows(self) -> Iterator[tuple]:
        """FOREST rows.  A node whose parent is open has the parent's name and not its id."""
        for depth, above, at, is_open, least, n, children, leaves, saved, ends in self.out:
            key = self.keys[at]
            parent_name = parent_id = None
            if depth and any(self._reaches(self.spans[above], depth - 1)):
                parent_name = _name(key, depth - 1)
            elif depth:
                parent_id = self.least[above]
            name = _name(key, depth) if is_open else None
            yield depth, name, parent_name, least, parent_id, n, children, leaves, saved, ends


def _name(key: bytes, depth: int) -> bytes:
    return hashlib.blake2b(key[: depth * TURN], digest_size=16).digest()


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the ends of partitions share with their neighbours."""
    for batch in batches:
        columns = (batch[n].to_pylist() for n in ("before", "first", "last", "after"))
        shared = [
            (-1 if w is None else common(w, x), -1 if z is None else common(y, z)) for w, x, y, z in zip(*columns, strict=True)
        ]
        yield pa.record_batch(
            {
                "part": batch["part"],
                "left": pa.array([x for x, _ in shared], pa.int64()),
                "right": pa.array([x for _, x in shared], pa.int64()),
            }
        )


def _forest(table: pa.Table) -> pa.Table:
    columns = (table[n].to_pylist() for n in ("key", "sizes", "n", "conv_id", "ends_sha256"))
    rows = sorted(zip(*columns, strict=True))
    found = Forest(rows, table["left"][0].as_py(), table["right"][0].as_py())
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in FOREST.split(", "))])
    told = list(zip(*found.rows(), strict=True))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(told, schema, strict=True)], schema=schema)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie over sequences (conv_id, turns as turn_sequences gives them), one row each:

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over its subtree, what its members but one need not hold again of each
    node's last text) and ends_sha256 (of the ids that end there).  Each prefix of each
    sequence is a node, the root too.  conv_ids are different.  An empty table has no node.

    Equal sequences count as one, with their number, before they are sorted, so neither
    copies nor a common first turn make a partition large.  Sequences are dealt by their
    first 64 turns; those that share all of them meet in one task, which holds 20 bytes a
    turn.  A digest of ids is taken in their order, by one task as a stream.
    """
    spark = sequences.sparkSession
    ship_code(spark)
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    named = sequences.select("conv_id", F.unhex(hexed).alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    named = written(named.withColumn("sequence", F.unhex(F.sha2("key", 256))), "sequences")
    turns = named.agg(F.sum(F.size("sizes"))).first()[0] or 0
    parts = max(shuffle_parts(spark), turns // PARTITION_TURNS + 1)

    ids = named.select("sequence", "conv_id").repartition(parts, "sequence").sortWithinPartitions("sequence", "conv_id")
    ends = ids.mapInArrow(_ends, "sequence binary, ends_sha256 string")
    different = named.groupBy("sequence").agg(
        F.any_value("key").alias("key"), F.any_value("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")
    )
    dealt = different.join(ends, "sequence").drop("sequence").repartitionByRange(parts, F.substring("key", 1, RANGE_TURNS * TURN))
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "dealt")

    limits = dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    by_part = Window.orderBy("part")  # one row a partition
    limits = limits.select("part", "first", "last", F.lag("last").over(by_part).alias("before"), F.lead("first").over(by_part).alias("after"))
    edges = limits.mapInArrow(_edges, "part int, left long, right long")
    forest = dealt.join(edges, "part").groupBy("part").applyInArrow(_forest, FOREST)
    forest = written(forest, "forest")

    sums = [F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    opened = (
        forest.where("name is not null")
        .groupBy("depth", "name", "parent_name")
        .agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"))
    )
    above = opened.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("parent_conv_id"))
    inside = forest.where("name is null and parent_name is null")
    fringe = forest.where("name is null and parent_name is not null").drop("parent_conv_id").join(above, "parent_name")
    opened = opened.join(above, "parent_name", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns.append(F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    return inside.select(columns).unionByName(fringe.select(columns)).unionByName(opened.select(columns))
