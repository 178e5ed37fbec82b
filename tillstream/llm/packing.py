"""Best-fit packing of token pieces under several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.store import gapless, ship_code, shuffle_parts, written
from tillstream.llm.textblock import blocks
from tillstream.llm.tokens import vocabulary_file, word_tokenizer


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold: tokens, pieces, and attention cost (sum of squared lengths)."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"  # or "dot"

    def __post_init__(self):
        if min(self.tokens, self.documents, self.cost) < 1 or self.score not in ("norm", "dot"):
            raise ValueError("a piece must fit a sequence, and score is norm or dot")


def plan(counts: dict[int, int], capacity: Capacity) -> np.ndarray:
    """Where pieces go: rows (length, first rank, pieces, first sequence, offset).

    Pieces of one length are alike, so the plan works on the number of pieces of each
    length, and on groups of sequences with the same residual capacities: its size
    depends on the capacity and not on the number of pieces.  Lengths go from long to
    short.  Of the groups that can hold one more piece under every constraint, the one
    with the best score is taken: the smallest weighted norm of what would be left, or
    the smallest weighted dot-product of demand and residual; among equals the earliest.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    weights = np.array(capacity.weights)
    left = np.zeros((0, 3))
    first, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    slices, n_sequences = [], 0
    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, length * length], float)
        rank, todo = 0, counts[length]
        while todo:
            fits = np.flatnonzero((left >= demand).all(axis=1))
            if len(fits):
                rest = (left[fits] - demand) / full
                value = (rest * rest) @ weights if capacity.score == "norm" else (left[fits] / full) @ (weights * demand / full)
                k = fits[np.lexsort((first[fits], value))[0]]
                n = min(todo, int(many[k]))
                at = int(first[k])
            else:
                # Open as many sequences as the pieces of this length fill by themselves.
                each = int(min(capacity.tokens // max(length, 1), capacity.documents, capacity.cost // max(length * length, 1)))
                n, at = -(-todo // each), n_sequences
                left = np.vstack([left, full])
                first, many = np.append(first, at), np.append(many, n)
                n_sequences += n
                k = len(many) - 1
            slices.append((length, rank, n, at, capacity.tokens - int(left[k, 0])))
            rank, todo = rank + n, todo - n
            if n < many[k]:
                left = np.vstack([left, left[k]])
                first, many = np.append(first, at + n), np.append(many, many[k] - n)
                many[k] = n
            left[k] = left[k] - demand
        smallest = min((x for x in counts if x < length), default=0)
        keep = (left >= [max(smallest, 1), 1, max(smallest, 1) ** 2]).all(axis=1)
        left, first, many = left[keep], first[keep], many[keep]
    return np.array(slices, np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, most: int, *, tokenizer_path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of docs (doc_id, text).

    A document is its ids and end_id; a longer one than most ids is cut, the last piece
    may be shorter.  A null text is empty: one piece that holds the end id alone.
    """
    ship_code(docs.sparkSession)
    file = vocabulary_file(tokenizer, tokenizer_path)
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_tokenizer(file)
        end = np.array([end_id], "<u4").tobytes()
        for batch, texts in blocks(batches, "text", 1_000_000):
            ids, begins = tool.encode(texts)
            raw, at = ids.astype("<u4").tobytes(), begins.tolist()
            out: dict = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for i, doc in enumerate(batch["doc_id"].to_pylist()):
                data = raw[4 * at[i] : 4 * at[i + 1]] + end
                for p, a in enumerate(range(0, len(data), 4 * most)):
                    one = data[a : a + 4 * most]
                    out["doc_id"].append(doc)
                    out["piece"].append(p)
                    out["start"].append(a // 4)
                    out["length"].append(len(one) // 4)
                    out["ids_crc32"].append(zlib.crc32(one))
                    out["ids"].append(one)
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "ids": pa.binary()}
            names = list(out) if with_ids else list(out)[:-1]
            yield pa.record_batch({k: pa.array(out[k], types.get(k, pa.int64())) for k in names})
        tool.forget()

    return docs.select("doc_id", "text").mapInArrow(cut, kind)


def pack(found: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """found (with doc_id, piece, start, length) and sequence_id and offset for each row.

    Every row is placed, repeated rows and null doc_ids too.  Lengths are from 1 to
    capacity.tokens, and the square of the longest is at most capacity.cost.  An empty
    table gives an empty one.
    """
    spark = found.sparkSession
    held = written(found, "pieces")  # ranks must see the same rows each time
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity.tokens:
        raise ValueError(f"lengths must be from 1 to {capacity.tokens}")
    if counts and max(counts) ** 2 > capacity.cost:
        raise ValueError(f"a piece of {max(counts)} costs more than {capacity.cost}")
    slices = plan(counts, capacity)  # at most capacity.tokens lengths
    slices = slices[np.lexsort((slices[:, 1], slices[:, 0]))]
    keys, sequences, offsets = (slices[:, 0] << 44) + slices[:, 1], slices[:, 3], slices[:, 4]
    ranked = gapless(held, ["length"], ["doc_id", "piece", "start"], "rank", shuffle_parts(spark))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch["length"]), np.asarray(batch["rank"])
            k = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            done = batch.drop_columns("rank")
            done = done.append_column("sequence_id", pa.array(sequences[k] + rank - (keys[k] & ((1 << 44) - 1))))
            yield done.append_column("offset", pa.array(offsets[k]))

    columns = [F.col(c) for c in held.columns]
    out = T.StructType([*held.schema.fields, *T.StructType.fromDDL("sequence_id long, `offset` long").fields])
    return ranked.select(*columns, "rank").mapInArrow(place, out)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian unsigned 32 bits) of rows of pack() that carry ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids")
    )
