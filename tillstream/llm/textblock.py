"""Words and hashes of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LONG_WORD = 512  # longer words are hashed one by one
_U = np.uint64
_M1, _M2, _STEP = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53), _U(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(*bytes_: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(bytes_)] = True
    return table


SPACES = separators(0x20, *range(0x09, 0x0E))  # words are [^\x20\x09-\x0D]+


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> _U(33))
    x *= _M1
    x ^= x >> _U(33)
    x *= _M2
    x ^= x >> _U(33)
    return x


class Texts:
    """Texts end to end: bytes, and where each begins and the last ends."""

    def __init__(self, data: np.ndarray, begins: np.ndarray):
        self.data = data
        self.begins = begins

    @staticmethod
    def of(array: pa.Array) -> Texts:
        """Of a string array; null is empty."""
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        if array.null_count:
            array = array.fill_null("")
        wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
        kind = np.dtype(np.int64 if wide else np.int32)
        _, places, data = array.buffers()
        if len(array) == 0:
            return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        begins = np.frombuffer(places, kind, len(array) + 1, array.offset * kind.itemsize).astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        return Texts(raw[begins[0] : begins[-1]], begins - begins[0])

    def lower(self) -> Texts:
        """A-Z in lower case."""
        return Texts(_LOWER[self.data], self.begins)

    def words(self, apart: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and for each text the index of its first word (one more at the end)."""
        if not len(self.data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.begins), np.int64)
        inside = ~apart[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = self.begins[:-1] < self.begins[1:]
        at, to = self.begins[:-1][full], self.begins[1:][full] - 1
        first[at], last[to] = inside[at], inside[to]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.begins)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span, none of them empty; one to one for spans of up to 8 bytes that do not end in NUL.

        Zero bytes fill up the last eight, so the size of a span that ends in NUL goes in too.
        """
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
        size = ends - starts
        h = mix(eights[starts] & _MASK[np.minimum(size, 8)])
        rest = np.flatnonzero((size > 8) & (size <= LONG_WORD))
        k = 8
        while len(rest):
            at = starts[rest] + k
            h[rest] = mix((h[rest] * _STEP) ^ (eights[at] & _MASK[np.minimum(size[rest] - k, 8)]))
            k += 8
            rest = rest[size[rest] > k]
        nul = np.flatnonzero(self.data[ends - 1] == 0)
        h[nul] = mix((h[nul] * _STEP) ^ size[nul].astype(_U))
        for i in np.flatnonzero(size > LONG_WORD):
            digest = hashlib.blake2b(self.data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
            h[i] = int.from_bytes(digest, "little")
        return h


def shingles(h: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width words inside a text, and each text's first run (one more at the end).

    A text of fewer words, but at least one, has its whole sequence as the only run.
    """
    counts = np.diff(firsts)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    places = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(places[-1], _U)
    long = counts >= width
    if long.any():
        value = np.zeros(max(len(h) - width + 1, 0), _U)
        for j in range(width):
            value = value * _STEP + h[j : len(h) - width + 1 + j]
        value = mix(value)
        keep = np.zeros(len(h) + 1, np.int64)
        np.add.at(keep, firsts[:-1][long], 1)
        np.add.at(keep, firsts[:-1][long] + runs[long], -1)
        inside = np.cumsum(keep[:-1]) > 0
        where = np.repeat(long, runs)
        out[where] = value[np.flatnonzero(inside)]
    for i in np.flatnonzero((counts > 0) & ~long):
        v = _U(counts[i])
        for x in h[firsts[i] : firsts[i + 1]]:
            v = mix(np.array([v], _U) * _STEP + x)[0]
        out[places[i]] = v
    return out, places


def blocks(batches, column: str, most_bytes: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of record batches that hold about most_bytes of text, a longer text alone.

    At the end of a task the worker gives freed memory back, as it lives on for the tasks
    of later stages.
    """
    for batch in batches:
        texts = Texts.of(batch.column(batch.schema.get_field_index(column)))
        begins = texts.begins
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(begins, begins[i] + most_bytes, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield (
                batch.slice(i, j - i),
                Texts(texts.data[begins[i] : begins[j]], begins[i : j + 1] - begins[i]),
            )
            i = j
    give_back()


def give_back() -> None:
    """Free memory goes back to the system at the end of a task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)
