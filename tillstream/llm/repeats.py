"""Removal of byte strings that occur again anywhere in the corpus.

A byte goes if a string of LENGTH bytes covers it that also starts at another place.

Every window of LENGTH bytes has a key, the smallest hash of the K-byte strings inside it,
so equal windows have equal keys.  A run of windows with one key is a chunk; a text is cut
into few chunks.  Tasks send each chunk's key and content hash, not its bytes, and chunks
meet by key: a key that occurs once cannot repeat (but for periodic text, which is told by
its chunk); contents that occur twice repeat as a whole; what is left is one chunk of each
different content under a key that others have, too.  Only these are fetched, and in each task a Burrows-Wheeler transform of them is
expanded breadth-first up to LENGTH (bwt.py), which tells exactly which windows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.bwt import repeated_places
from tillstream.llm.store import ship_code, shuffle_parts, written
from tillstream.llm.textblock import Texts, blocks, give_back, mix

LENGTH = 200
K = 40
PIECE = 500_000  # longer texts are cut into pieces of so many windows; blocks of texts have about so many bytes
LONGEST = 4096  # windows of a chunk
FLUSH = 300_000  # chunks a task holds before it sends them
TOGETHER = 500_000  # bytes of several keys that share a transform
CROWD = 500_000  # bytes of one key that go into a transform; beyond, its windows are counted by digest
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
CHUNK = np.dtype(
    [("key", "<u8"), ("c1", "<u8"), ("c2", "<u4"), ("row", "<i8"), ("check", "<u4"), ("start", "<u4"), ("n", "<u2"), ("state", "u1"), ("loops", "u1")]
)
NEW, TWICE, DONE = 0, 1, 2  # state: seen once by its task, seen again there, only to be passed on


@lru_cache(maxsize=1)
def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for base in _BASES:
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(n, b, _U)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=_U))
        out.append(tuple(pair))
    return out


def _sums(data: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Prefix sums of two polynomial hashes, and the factors that bring a span to the front."""
    size = 1 << max(16, int(len(data) + 1).bit_length())
    out = []
    value = data.astype(_U) + _U(1)
    for power, inverse in _powers(size):
        total = np.zeros(len(data) + 1, _U)
        np.cumsum(value * power[: len(data)], out=total[1:])
        out.append((total, inverse))
    return out


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width neighbouring values."""
    n = len(h) - width + 1
    padded = np.full(-(-len(h) // width) * width, np.iinfo(_U).max, _U)
    padded[: len(h)] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def chunks(texts: Texts, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of texts as an array of CHUNK (row: index of the text), their windows in order."""
    data, begins = texts.data, texts.begins
    windows = np.maximum(np.diff(begins) - length + 1, 0)
    if not windows.any():
        return np.zeros(0, CHUNK)
    (s1, i1), (s2, i2) = _sums(data)
    h = mix((s1[k:] - s1[:-k]) * i1[: len(data) - k + 1])
    key = _smallest(h, length - k + 1)
    # Two windows of a chunk can only be equal if a window but the last begins with the key.
    led = np.concatenate([[0], np.cumsum(h[: len(key)] == key, dtype=np.int32)])
    del h
    edge = np.zeros(len(data) + 1, np.int8)
    some = windows > 0
    np.add.at(edge, begins[:-1][some], 1)
    np.add.at(edge, (begins[:-1] + windows)[some], -1)
    inside = np.cumsum(edge[: len(key)], dtype=np.int8) > 0
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    first[begins[:-1][some]] = True
    at = np.flatnonzero(first & inside)
    text = np.searchsorted(begins, at, side="right") - 1
    to = np.minimum(np.append(at[1:], len(data)), (begins[:-1] + windows)[text])
    many = -(-(to - at) // LONGEST)
    if (many > 1).any():
        place = np.repeat(np.arange(len(at)), many)
        step = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
        at, to, text = at[place] + step * LONGEST, np.minimum(at[place] + (step + 1) * LONGEST, to[place]), text[place]
    end = to + length - 1
    out = np.zeros(len(at), CHUNK)
    out["key"], out["row"], out["start"], out["n"] = key[at], text, at - begins[text], to - at
    out["loops"] = led[to - 1] > led[at]
    size = (end - at).astype(_U)
    out["c1"] = mix((s1[end] - s1[at]) * i1[at] + size)
    out["c2"] = (mix((s2[end] - s2[at]) * i2[at] + size) >> _U(32)).astype(np.uint32)
    return out


def _pieces(batches) -> Iterator[tuple[np.ndarray, int, Texts]]:
    """Rows, place in the text, and texts; a very long text in pieces that overlap by a window."""
    for batch, texts in blocks(batches, "text", PIECE):
        rows = np.zeros(batch.num_rows, [("row", "<i8"), ("check", "<u4")])
        rows["row"] = batch["row"]
        rows["check"] = np.asarray(batch["check"]).view(np.uint32)
        if len(rows) > 1 or len(texts.data) <= PIECE + LENGTH:
            yield rows, 0, texts
            continue
        for a in range(0, max(1, len(texts.data) - LENGTH + 1), PIECE):
            part = texts.data[a : a + PIECE + LENGTH - 1]
            yield rows, a, Texts(part, np.array([0, len(part)]))


def _sorted(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks by key and content, and the index of each content's first chunk."""
    c = c[np.lexsort((c["c2"], c["c1"], c["key"]))]
    new = np.ones(len(c), bool)
    new[1:] = (c["key"][1:] != c["key"][:-1]) | (c["c1"][1:] != c["c1"][:-1]) | (c["c2"][1:] != c["c2"][:-1])
    return c, np.flatnonzero(new)


def _send(parts: int):
    """Tasks' chunks, packed by bucket.  What a task has twice it settles: one chunk goes on."""

    def pack(c: np.ndarray) -> pa.RecordBatch:
        c, first = _sorted(c)
        many = np.diff(np.append(first, len(c)))
        twice = np.repeat(many > 1, many)
        c["state"][twice] = DONE
        c["state"][first[many > 1]] = TWICE
        # What is only passed on does not gather at its key.
        goes = np.where(c["state"] == DONE, mix(c["row"].view(_U)), c["key"])
        bucket = (goes % _U(parts)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        c = c[order]
        cut = np.searchsorted(bucket[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.record_batch(
            {
                "bucket": pa.array(full.astype(np.int32)),
                "chunks": pa.array([c[cut[k] : cut[k + 1]].tobytes() for k in full], pa.binary()),
            }
        )

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for rows, place, texts in _pieces(batches):
            c = chunks(texts)
            of = rows[c["row"]]
            c["row"], c["check"] = of["row"], of["check"]
            c["start"] += np.uint32(place)
            held.append(c)
            n += len(c)
            if n > FLUSH:
                yield pack(np.concatenate(held))
                held, n = [], 0
        if n:
            yield pack(np.concatenate(held))

    return send


_FOUND = "key long, row long, check int, start long, n int, settled boolean, left boolean"


def _meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of this partition that repeat as a whole (settled), and one of each content that
    has company under its key or may repeat in itself (left)."""
    held = [np.frombuffer(x, CHUNK) for batch in batches for x in batch["chunks"].to_pylist()]
    if not held:
        return
    c = np.concatenate(held)
    del held

    def rows(c: np.ndarray, settled: np.ndarray, left: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(c), 100_000):
            part = c[a : a + 100_000]
            yield pa.record_batch(
                {
                    "key": pa.array(part["key"].view(np.int64)), "row": pa.array(part["row"]),
                    "check": pa.array(part["check"].view(np.int32)), "start": pa.array(part["start"].astype(np.int64)), "n": pa.array(part["n"].astype(np.int32)), "settled": pa.array(settled[a : a + 100_000]),
                    "left": pa.array(left[a : a + 100_000]),
                }
            )

    done = c[c["state"] == DONE]
    yield from rows(done, np.ones(len(done), bool), np.zeros(len(done), bool))
    c = c[c["state"] != DONE]
    if not len(c):
        return
    c, first = _sorted(c)
    many = np.diff(np.append(first, len(c)))
    settled = np.repeat((many > 1) | (np.maximum.reduceat(c["state"], first) == TWICE), many)
    key = c["key"][first]
    alone = np.ones(len(first), bool)
    alone[1:] &= key[1:] != key[:-1]
    alone[:-1] &= key[1:] != key[:-1]
    left = np.zeros(len(c), bool)
    left[first[~alone | (c["loops"][first] > 0)]] = True
    keep = settled | left
    yield from rows(np.ascontiguousarray(c[keep]), settled[keep], left[keep])


_SPANS = "row long, check int, `from` long, `to` long"


def _window_spans(flags: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Byte spans of runs of flagged windows, the first of which begins at start."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(start + int(a), start + int(b) - 1 + LENGTH) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows in the chunks of this partition, which come by key."""

    def solve(held: list) -> Iterator[pa.RecordBatch]:
        text = np.full(sum(len(x["content"]) + 1 for x in held), 0, np.int16)
        places, at = [], 0
        for x in held:
            size = len(x["content"])
            text[at : at + size] = np.frombuffer(x["content"], np.uint8).astype(np.int16) + 1
            places.append(at)
            at += size + 1
        flags = repeated_places(text, LENGTH)
        spans = [
            (x["row"], x["check"], a, b)
            for x, at in zip(held, places, strict=True)
            if not x["settled"]
            for a, b in _window_spans(flags[at : at + len(x["content"]) - LENGTH + 1], x["start"])
        ]
        columns = list(zip(*spans, strict=True)) or [[], [], [], []]
        yield _span_batch(*columns)

    held, size, last = [], 0, None
    for batch in batches:
        for x in batch.to_pylist():
            if size > TOGETHER and x["key"] != last:
                yield from solve(held)
                held, size = [], 0
            held.append(x)
            size += len(x["content"])
            last = x["key"]
    if held:
        yield from solve(held)
    give_back()


def _span_batch(row, check, begin, end) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "row": pa.array(row, pa.int64()), "check": pa.array(check, pa.int32()),
            "from": pa.array(begin, pa.int64()), "to": pa.array(end, pa.int64()),
        }
    )


def _crowded(chunks_: DataFrame) -> DataFrame:
    """Spans in chunks whose key has too many contents for one task: equal windows are counted."""

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, check, start, content in zip(*[batch[n].to_pylist() for n in ("row", "check", "start", "content")], strict=True):
                digests = [hashlib.blake2b(content[i : i + LENGTH], digest_size=16).digest() for i in range(len(content) - LENGTH + 1)]
                yield pa.record_batch(
                    {
                        "digest": pa.array(digests, pa.binary()),
                        "row": pa.array([row] * len(digests), pa.int64()),
                        "check": pa.array([check] * len(digests), pa.int32()),
                        "from": pa.array(range(start, start + len(digests)), pa.int64()),
                    }
                )

    each = chunks_.mapInArrow(windows, "digest binary, row long, check int, `from` long")
    again = each.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return each.join(again, "digest").select("row", "check", "from", (F.col("from") + LENGTH).alias("to"))


def repeat_spans(rows: DataFrame) -> DataFrame:
    """(row, check, from, to): byte spans to remove in rows (row, check, text); row and check name a text."""
    spark = rows.sparkSession
    parts = shuffle_parts(spark)
    sent = rows.mapInArrow(_send(parts), "bucket int, chunks binary").repartitionById(parts, F.col("bucket"))
    found = written(sent.mapInArrow(_meet, _FOUND), "chunks")
    settled = found.where("settled").select(
        "row", "check", F.col("start").alias("from"), (F.col("start") + F.col("n") - 1 + LENGTH).alias("to")
    )
    per_key = found.where("left").groupBy("key").agg(F.sum(F.col("n") + LENGTH).alias("bytes"))
    left = found.where("left").join(per_key, "key").groupBy("row", "check").agg(
        F.collect_list(F.struct("start", "n", "key", "settled", "bytes")).alias("wanted")
    )

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            data = texts.data
            out: dict = {n: [] for n in ("key", "row", "check", "start", "settled", "bytes", "content")}
            named = zip(*[batch[n].to_pylist() for n in ("row", "check", "wanted")], strict=True)
            for i, (row, check, wanted) in enumerate(named):
                base = int(texts.begins[i])
                for w in wanted:
                    out["row"].append(row)
                    out["check"].append(check)
                    for n in ("key", "start", "settled", "bytes"):
                        out[n].append(w[n])
                    a = base + w["start"]
                    out["content"].append(data[a : a + w["n"] - 1 + LENGTH].tobytes())
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
            yield pa.record_batch({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds, strict=True)})

    kind = "key long, row long, check int, start long, settled boolean, bytes long, content binary"
    one_each = rows.join(left, ["row", "check"]).dropDuplicates(["row", "check"])
    contents = written(one_each.mapInArrow(fetch, kind), "contents")
    small = contents.where(f"bytes <= {CROWD}").repartition(parts, "key").sortWithinPartitions("key")
    expanded = small.mapInArrow(_expand, _SPANS)
    return settled.unionByName(expanded).unionByName(_crowded(contents.where(f"bytes > {CROWD}")))


def _free(name: str, taken: list[str]) -> str:
    """A column name like name that no column has."""
    taken = [t.lower() for t in taken]
    while name in taken:
        name = f"_{name}"
    return name


def cut_repeats(docs: DataFrame, *, whole_characters: bool = False) -> DataFrame:
    """docs and columns cut_bytes, cut_removed, cut_spans, cut_text (binary), whose names must be free.

    With whole_characters, a character of which a byte goes is removed as a whole, so that
    what is left is UTF-8 and holds no character that the text did not have.

    Strings are judged on the input.  A null text is empty; a text shorter than LENGTH
    keeps all; repeated rows are copies of each other and lose all.  Other columns, null
    ids too, are kept as they are.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship_code(spark)
    named = ["doc_id", "text"] if "doc_id" in docs.columns else ["text"]
    row = F.xxhash64(*named)
    check = F.hash(*[F.reverse(F.col(n).cast("string")) for n in reversed(named)])
    text = F.coalesce("text", F.lit(""))
    spans = repeat_spans(docs.select(row.alias("row"), check.alias("check"), text.alias("text")))
    # Names that docs does not have.
    at, of, by = (_free(n, docs.columns) for n in ("spans", "row", "check"))
    listed = spans.groupBy(F.col("row").alias(of), F.col("check").alias(by)).agg(F.collect_list(F.struct("from", "to")).alias(at))
    joined = docs.select("*", row.alias(of), check.alias(by)).join(listed, [of, by], "left").select(*[F.col(f"`{c}`") for c in docs.columns], at)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text"):
            spans = batch[at].to_pylist()
            size, removed, runs, kept = [], [], [], []
            for i, found in enumerate(spans):
                data = texts.data[texts.begins[i] : texts.begins[i + 1]]
                gone = np.zeros(len(data) + 1, np.int32)
                for s in found or ():
                    gone[s["from"]] += 1
                    gone[s["to"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                if whole_characters and gone.any():
                    first = np.flatnonzero((data & 0xC0) != 0x80)
                    gone = np.repeat(np.logical_or.reduceat(gone, first), np.diff(np.append(first, len(data))))
                size.append(len(data))
                removed.append(int(gone.sum()))
                runs.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                kept.append(data[~gone].tobytes())
            out = batch.drop_columns(at)
            for name, values in (("cut_bytes", size), ("cut_removed", removed), ("cut_spans", runs)):
                out = out.append_column(name, pa.array(values, pa.int64()))
            yield out.append_column("cut_text", pa.array(kept, pa.binary()))

    added = T.StructType.fromDDL("cut_bytes long, cut_removed long, cut_spans long, cut_text binary")
    return joined.mapInArrow(cut, T.StructType(docs.schema.fields + added.fields))
