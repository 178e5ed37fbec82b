"""Token ids as independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames, each of at most frame_bytes of ids, then the table
of documents in a skippable frame, then the seek table in another.  Any zstandard tool
can unpack it; a reader that knows the seek table unpacks only the frames a document
lies in, and checks each against the checksum in the table.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.store import filesystem, ship_code, shuffle_parts, work_area, written
from tillstream.llm.textblock import Texts, blocks
from tillstream.llm.tokens import vocabulary_file, word_tokenizer

# Fixed values of the public zstandard seekable format.
SEEK_FRAME = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
# A skippable frame of our own for the table of documents, and how it begins.
DOCS_FRAME = 0x184D2A50
DOCS_MAGIC = b"tokdocs1"


class Writer:
    """Writes one file; documents come in order."""

    def __init__(self, out, width: int, frame_bytes: int = 1 << 18, level: int = 3):
        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self.press = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held: list[bytes] = []
        self.n_held = 0
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // self.width))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.frame_bytes:
            data = b"".join(self.held)
            full = len(data) - len(data) % self.frame_bytes
            for i in range(0, full, self.frame_bytes):
                self._frame(data[i : i + self.frame_bytes])
            self.held, self.n_held = [data[full:]], len(data) - full

    def _frame(self, data: bytes) -> None:
        packed = self.press.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.n_held:
            self._frame(b"".join(self.held))
        table = np.array(self.docs, np.int64).reshape(-1, 3)
        body = self.press.compress(np.ascontiguousarray(table.T).tobytes())
        docs = DOCS_MAGIC + struct.pack("<BQI", self.width, len(table), zlib.crc32(body)) + body
        frame = struct.pack("<II", DOCS_FRAME, len(docs)) + docs
        self.out.write(frame)
        self.entries.append((len(frame), 0, 0))
        seek = b"".join(struct.pack("<III", *e) for e in self.entries)
        seek += struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(seek)) + seek)


class Reader:
    """Reads documents of one file; only the frames they lie in are unpacked."""

    def __init__(self, path: str):
        store, inside = filesystem(path)
        self.file = store.open_input_file(inside)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        raw = self.file.read_at(12 * count, size - 9 - 12 * count)
        self.frames = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.begins = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        frame = self.file.read_at(int(self.frames[-1, 0]), int(self.places[-2]))
        if frame[8:16] != DOCS_MAGIC:
            raise ValueError(f"{path} has no table of documents")
        self.width, n, crc = struct.unpack("<BQI", frame[16:29])
        if zlib.crc32(frame[29:]) != crc:
            raise ValueError(f"{path}: table of documents is damaged")
        self.unpack = zstandard.ZstdDecompressor()
        table = np.frombuffer(self.unpack.decompress(frame[29:]), np.int64).reshape(3, n)
        self.doc_ids, self.has_id, self.sizes = table
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.n_unpacked = 0
        self._last = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            packed, size, checksum = (int(x) for x in self.frames[k])
            data = self.unpack.decompress(self.file.read_at(packed, int(self.places[k])), max_output_size=size)
            if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} is damaged")
            self.n_unpacked += 1
            self._last = (k, data)
        return self._last[1]

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file."""
        a, b = int(self.starts[i]) * self.width, int(self.starts[i + 1]) * self.width
        parts = []
        k = int(np.searchsorted(self.begins, a, side="right")) - 1
        while a < b:
            data, begin = self.frame(k), int(self.begins[k])
            parts.append(data[a - begin : b - begin])
            a = min(b, begin + len(data))
            k += 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}").astype("<u4")


def _shard_bounds(docs: DataFrame, shards: int) -> list[int]:
    """doc_ids that part the documents into shards of about equal counts."""
    found = docs.select("doc_id").approxQuantile("doc_id", [k / shards for k in range(1, shards)], 0.2 / shards)
    return sorted({int(x) for x in found})


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    *,
    tokenizer_path: str | None = None,
    shards: int | None = None,
    frame_bytes: int = 1 << 18,
) -> DataFrame:
    """Encode docs (doc_id, text) and write one file a shard, in ascending doc_id order.

    Returns the manifest: shard, path, n_docs, n_tokens, start (ids before the shard).
    Each document ends with end_id.  A null text is empty and holds the end id alone; a
    null doc_id comes first; rows with the same doc_id follow one another.  Other columns
    are ignored.  An empty table gives no file.  A task that is run again writes a file
    with another name, and only the files of the tasks that counted are in the manifest.
    """
    spark = docs.sparkSession
    ship_code(spark)
    file = vocabulary_file(tokenizer, tokenizer_path)
    width = 2 if word_tokenizer(file).library.get_vocab_size() <= 1 << 16 else 4
    n = shards or shuffle_parts(spark)
    bounds = np.array(_shard_bounds(docs, n), np.int64)
    folder = work_area(spark, "tokens")
    end = np.array([end_id], f"<u{width}").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_tokenizer(file)
        for batch, texts in blocks(batches, "text", 1_000_000):
            ids, begins = tool.encode(texts)
            raw, at = ids.astype(f"<u{width}").tobytes(), (begins * width).tolist()
            key = batch.column("doc_id").cast(pa.int64())
            whole = np.asarray(key.fill_null(np.iinfo(np.int64).min))
            yield pa.record_batch(
                {
                    "shard": pa.array(np.searchsorted(bounds, whole, side="left").astype(np.int32)),
                    "doc_id": key,
                    "ids": pa.array([raw[a:b] + end for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                }
            )
        tool.forget()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict = {}

        def finish():
            if open_:
                open_["writer"].close()
                open_["out"].close()
                sizes = [d[2] for d in open_["writer"].docs]
                row = {"shard": [open_["shard"]], "path": [open_["path"]], "n_docs": [len(sizes)], "n_tokens": [sum(sizes)]}
                open_.clear()
                yield pa.RecordBatch.from_pydict(row, pa.schema(kinds))

        kinds = [("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
        for batch in batches:
            raw = Texts.of(batch.column("ids"))
            data, at = raw.data.tobytes(), raw.begins.tolist()
            for i, (shard, doc) in enumerate(zip(batch["shard"].to_pylist(), batch["doc_id"].to_pylist(), strict=True)):
                if open_.get("shard") != shard:
                    yield from finish()
                    path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
                    store, inside = filesystem(path)
                    store.create_dir(inside.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(inside, compression=None)
                    open_.update(shard=shard, path=path, out=out, writer=Writer(out, width, frame_bytes))
                open_["writer"].add(doc, data[at[i] : at[i + 1]])
        yield from finish()

    rows = docs.select("doc_id", "text").mapInArrow(encode, "shard int, doc_id long, ids binary")
    dealt = rows.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    files = written(dealt.mapInArrow(write, "shard int, path string, n_docs long, n_tokens long"), "tokenfiles")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start, n_tokens, ids_crc32, read back from them."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["path"])
                n = len(reader.sizes)
                for a in range(0, n, 4096):
                    part = range(a, min(n, a + 4096))
                    crc = [zlib.crc32(reader.ids(i).tobytes()) for i in part]
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(reader.doc_ids[a : part.stop], mask=reader.has_id[a : part.stop] == 0),
                            "start": pa.array(reader.starts[a : part.stop] + row["start"]),
                            "n_tokens": pa.array(reader.sizes[a : part.stop]),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    spark = manifest.sparkSession
    each = manifest.select("path", "start").repartition(shuffle_parts(spark))
    return each.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
