"""SentencePiece encoding that says which bytes of a text each piece stands for."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillstream.llm.charmap import SPACE, CharMap, Spec
from tillstream.llm.store import ship_code
from tillstream.llm.textblock import Texts, blocks
from tillstream.llm.tokens import WordTokenizer, vocabulary_file

ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>"
DECODED = "doc_id long, n_tokens long, packed binary, decoded string"
BLOCK = 500_000  # bytes of text at a time


class PieceEncoder(WordTokenizer):
    """Ids and byte spans of texts.

    A text is normalised by the model's compiled character map, which records where each
    byte came from.  A copy of the model without a normaliser cuts the result into pieces;
    as pieces lie end to end there, their sizes give each one's place in it, and the record
    its place in the text.  A character that is no piece becomes byte pieces, of which the
    last one has the character's span and the others an empty one before it.

    Merges never cross the border before a space if no piece has a space behind another
    character, so each different word (with the spaces before it) is encoded once; words
    are found by a 64-bit hash.  Other models get whole texts.
    """

    def __init__(self, file: str):
        import sentencepiece

        self.forget()
        with open(file, "rb") as f:
            spec, plain = Spec.read(f.read())
        self.map = CharMap(spec)
        self.tool = sentencepiece.SentencePieceProcessor(model_proto=plain)
        n = self.tool.get_piece_size()
        self.by_words = spec.bpe and spec.byte_fallback and spec.escape and not spec.inner_space
        self.by_text = not spec.byte_fallback  # only the text of an unknown piece tells its size
        self.widths = np.array([len(p.encode()) for p in self.tool.id_to_piece(list(range(n)))], np.int64)
        self.widths[[i for i in range(n) if self.tool.is_byte(i)]] = 1
        self.begin, self.end = self.tool.bos_id(), self.tool.eos_id()

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tool.encode(words, num_threads=1)
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), sizes

    def _pieces(self, normal: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, where each text begins in them, and the pieces' sizes."""
        if self.by_words:
            ids, begins = self.encode_spans(normal, *_words(normal))
            return ids, begins, self.widths[ids]
        raw, at = normal.data.tobytes(), normal.begins.tolist()
        texts = [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]
        ids, sizes = self._encode(texts)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        if not self.by_text:
            return ids, begins, self.widths[ids]
        said = self.tool.encode(texts, out_type=str, num_threads=1)
        return ids, begins, np.array([len(p.encode()) for x in said for p in x], np.int64)

    def encode_blocks(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's ids begin (one more at the end), the ids, with begin and end ids,
        and the bytes of its text at which each id's span starts and ends."""
        normal, source, stop = self.map.normalise_all(texts)
        ids, begins, width = self._pieces(normal)
        to = np.cumsum(width)
        if (to[-1] if len(to) else 0) != len(normal.data):
            raise ValueError("pieces do not cover the normalised texts")
        n = np.diff(begins)
        many = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(ids)) + 2 * many + 1
        offsets = begins + 2 * np.arange(len(begins))
        size = np.diff(texts.begins)
        out = [np.empty(int(offsets[-1]), np.int32) for _ in range(3)]
        if len(ids):
            after = np.append(source, 0)[to]
            some = n > 0
            after[begins[1:][some] - 1] = stop[some]
            for values, found in zip(out, (ids, source[to - width], after), strict=True):
                values[place] = found
        for values, head, tail in zip(out, (self.begin, 0, 0), (self.end, size, size), strict=True):
            values[offsets[:-1]] = head
            values[offsets[1:] - 1] = tail
        return offsets, *out

    def encode(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """encode_blocks, as lists of one array a text."""
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        offsets, *out = self.encode_blocks(Texts(np.frombuffer(b"".join(texts), np.uint8), begins))
        return tuple(np.split(values, offsets[1:-1]) for values in out)


def _words(normal: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first of each text's words, each with the spaces before it."""
    data, begins = normal.data, normal.begins
    n = len(data)
    space = np.zeros(n + 3, bool)
    if n >= len(SPACE):
        space[3 : n + 1] = (data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])
    # space[i + 3]: a space stands at i.  A word begins at a space that has none before it.
    first = space[3:] & ~space[:n]
    full = begins[:-1][np.diff(begins) > 0]
    first[full] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], n), np.searchsorted(starts, begins)


@lru_cache(maxsize=1)
def encoder(file: str) -> PieceEncoder:
    """One per worker process; words are forgotten at the end of a task."""
    return PieceEncoder(file)


@lru_cache(maxsize=1)
def _library(file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file)


def encode_pieces(docs: DataFrame, model: str, *, model_path: str | None = None) -> DataFrame:
    """doc_id, ids, starts, ends of docs (doc_id, text) by a sentencepiece model.

    ids begin with the begin id and end with the end id; starts and ends are the bytes of
    the UTF-8 text that each id stands for (empty spans for those two).  A text is encoded
    whole.  A null or empty text has the two ids only.  Repeated rows each have a row, a
    null doc_id stays null, other columns are ignored whatever their names, and an empty
    table gives no row.  A text has to be smaller than 2 GB, as any Spark string.
    """
    ship_code(docs.sparkSession)
    file = vocabulary_file(model, model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(file)
        for batch, texts in blocks(batches, "text", BLOCK):
            offsets, *found = tool.encode_blocks(texts)
            begins = pa.array(offsets.astype(np.int32))
            lists = [pa.ListArray.from_arrays(begins, pa.array(x)) for x in found]
            yield pa.record_batch({"doc_id": batch["doc_id"], **dict(zip(("ids", "starts", "ends"), lists, strict=True))})
        tool.forget()

    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, ENCODED)


def decode_pieces(encoded: DataFrame, model: str, *, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, packed (ids as little-endian 32-bit integers) and decoded text of
    encoded (doc_id, ids).  Null ids are no ids; other columns are ignored."""
    ship_code(encoded.sparkSession)
    file = vocabulary_file(model, model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _library(file)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n = part["ids"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = part["ids"].flatten().to_numpy(zero_copy_only=False).astype("<u4")
                ends = np.cumsum(n)
                ids, packed = flat.tolist(), flat.tobytes()
                at = list(zip((ends - n).tolist(), ends.tolist(), strict=True))
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"],
                        "n_tokens": pa.array(n, pa.int64()),
                        "packed": pa.array([packed[4 * a : 4 * b] for a, b in at], pa.binary()),
                        "decoded": pa.array(tool.decode([ids[a:b] for a, b in at], num_threads=1) if at else [], pa.string()),
                    }
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)
