"""Normalisation through a compiled character map that keeps where each byte came from.

The map is the one a sentencepiece model carries: a double-array trie over UTF-8 strings
whose values point into replacement strings.  At each place the longest string of the trie
is replaced; where none fits, one character stays as it is.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

from tillstream.llm.textblock import Texts

SPACE = "▁".encode()  # fixed value: what stands for a space in pieces
# Field numbers of the model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE, RULES = 2, 3, 4, 5, 6
MODEL_KIND, SUFFIX_SPACE, BYTE_FALLBACK = 3, 24, 35
BPE = 2
TEXT, SCORE, KIND = 1, 2, 3
USER_DEFINED = 4


def message(raw: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """Fields of a protocol buffer message: number, wire type, value."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            value: bytes | int = number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            value = raw[at : at + size]
            at += size
        yield key >> 3, kind, value


def _field(number: int, value: bytes | int) -> bytes:
    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


@dataclass
class Spec:
    """What a model file says about normalisation."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    drop_extra_spaces: bool = True
    escape: bool = True
    byte_fallback: bool = False
    bpe: bool = False
    own_symbols: list[bytes] = field(default_factory=list)  # kept as they stand in a text
    inner_space: bool = False  # some piece has a space behind another character

    @staticmethod
    def read(model: bytes) -> tuple[Spec, bytes]:
        """The specification, and the same model with a normaliser that changes nothing."""
        spec, plain = Spec(), []
        for number, kind, value in message(model):
            if number == NORMALIZER:
                said = {n: v for n, _, v in message(value)}
                spec.charsmap = said.get(CHARSMAP, b"")
                spec.dummy_prefix = bool(said.get(DUMMY_PREFIX, 1))
                spec.drop_extra_spaces = bool(said.get(EXTRA_SPACES, 1))
                spec.escape = bool(said.get(ESCAPE, 1))
                continue
            if number == TRAINER:
                said = {n: v for n, _, v in message(value)}
                if said.get(SUFFIX_SPACE):
                    raise ValueError("models with spaces behind words are not supported")
                spec.byte_fallback = bool(said.get(BYTE_FALLBACK, 0))
                spec.bpe = said.get(MODEL_KIND) == BPE
            if number == PIECES:
                said = {n: v for n, _, v in message(value)}
                piece = said.get(TEXT, b"")
                while piece.startswith(SPACE):
                    piece = piece.removeprefix(SPACE)
                spec.inner_space |= SPACE in piece
                if said.get(KIND) == USER_DEFINED:
                    spec.own_symbols.append(said[TEXT])
            plain.append(_field(number, value))
        keep = [(1, b"identity"), (CHARSMAP, b""), (DUMMY_PREFIX, 0), (EXTRA_SPACES, 0), (ESCAPE, 0)]
        plain.append(_field(NORMALIZER, b"".join(_field(n, v) for n, v in keep)))
        return spec, b"".join(plain)


class CharMap:
    """Longest-prefix replacement with the source of every byte of the result."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.units = np.zeros(0, np.uint32)
        self.values = b""
        if spec.charsmap:
            (size,) = struct.unpack_from("<I", spec.charsmap)
            self.units = np.frombuffer(spec.charsmap, "<u4", size // 4, 4)
            self.values = spec.charsmap[4 + size :]

    def matches(self, data: np.ndarray, places: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place the size of the longest string of the map that begins there, 0 if
        there is none, and where its replacement lies.  All places go down the trie together."""
        size, value = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        if not len(self.units) or not len(places):
            return size, value

        def below(unit: np.ndarray) -> np.ndarray:
            return ((unit >> 10) << ((unit & 512) >> 6)).astype(np.int64)

        alive = np.arange(len(places))
        node = np.full(len(places), below(self.units[:1])[0])
        depth = 0
        while len(alive):
            inside = places[alive] + depth < end
            alive, node = alive[inside], node[inside]
            byte = data[places[alive] + depth].astype(np.int64)
            node = node ^ byte
            fits = node < len(self.units)
            alive, node, byte = alive[fits], node[fits], byte[fits]
            unit = self.units[node]
            fits = (unit & np.uint32(0x800000FF)) == byte
            alive, node, unit = alive[fits], node[fits], unit[fits]
            node = node ^ below(unit)
            depth += 1
            leaf = ((unit >> 8) & 1).astype(bool)
            size[alive[leaf]] = depth
            value[alive[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
        return size, value

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes the byte of text it came from (one
        more at the end).  text is valid UTF-8; the empty text stays empty."""
        spec, data = self.spec, np.frombuffer(text, np.uint8)
        if self.changes_spaces_only:
            return self._spaces_only(text, data)
        first = np.flatnonzero((data & 0xC0) != 0x80)  # characters
        width = np.diff(np.concatenate([first, [len(data)]]))
        size, value = self.matches(data, first, len(data))
        own = self._own(text, first)
        changed = np.flatnonzero((size > 0) | (own > 0))
        # From left to right: a replaced string hides all that begins inside it.
        parts: list[tuple[int, int, bytes]] = []
        at = 0
        for k in changed.tolist():
            place = int(first[k])
            if place < at:
                continue
            if at < place:
                parts.append((at, place, b""))
            taken = int(own[k]) or int(size[k])
            if own[k]:
                new = text[place : place + taken]
            else:
                new = self.values[int(value[k]) : self.values.index(b"\0", int(value[k]))]
            parts.append((place, -taken, new))
            at = place + taken
        if at < len(data):
            parts.append((at, len(data), b""))
        out: list[np.ndarray] = []
        source: list[np.ndarray] = []
        owner = np.repeat(first, width)  # the character each byte belongs to
        for a, b, new in parts:
            if b >= 0:
                out.append(data[a:b])
                source.append(owner[a:b])
            elif new:
                out.append(np.frombuffer(new, np.uint8))
                source.append(np.full(len(new), a))
        flat = np.concatenate(out) if out else data[:0]
        came = np.concatenate(source) if source else np.zeros(0, np.int64)
        return self._spaces(flat, came, self._begin(data, parts), len(data))

    @staticmethod
    def _begin(data: np.ndarray, parts: list[tuple[int, int, bytes]]) -> int:
        """The first place of a text that does not turn into a space."""
        for a, b, new in parts:
            if b < 0 and new != b" ":
                return a
            solid = np.flatnonzero(data[a:b] != 0x20) if b >= 0 else ()
            if len(solid):
                return a + int(solid[0])
        return len(data)

    def _own(self, text: bytes, first: np.ndarray) -> np.ndarray:
        """Size of the longest own symbol that begins at each character."""
        size = np.zeros(len(first), np.int64)
        for symbol in sorted(self.spec.own_symbols, key=len):
            at = text.find(symbol)
            while at >= 0:
                k = int(np.searchsorted(first, at))
                if k < len(first) and first[k] == at:
                    size[k] = len(symbol)
                at = text.find(symbol, at + 1)
        return size

    def _spaces(self, flat: np.ndarray, came: np.ndarray, begin: int, end: int) -> tuple[bytes, np.ndarray]:
        """Leading, repeated and trailing spaces go if the model says so; others are marked."""
        if not end or (self.spec.drop_extra_spaces and begin == end):
            return b"", np.zeros(1, np.int64)
        space = flat == 0x20
        mark = SPACE if self.spec.escape else b" "
        if self.spec.drop_extra_spaces:
            keep = ~(space & np.concatenate([[True], space[:-1]]))
            flat, came, space = flat[keep], came[keep], space[keep]
        else:
            begin = 0
        wide = np.where(space, len(mark), 1)
        source, grown = np.repeat(came, wide), np.repeat(flat, wide)
        at = (np.cumsum(wide) - wide)[space]
        for i, byte in enumerate(mark):
            grown[at + i] = byte
        head = mark if self.spec.dummy_prefix else b""
        out = head + grown.tobytes()
        source = np.concatenate([np.full(len(head), begin), source, [end]]).astype(np.int64)
        if self.spec.drop_extra_spaces:
            size = len(out)
            while out.endswith(mark, 0, size):
                size -= len(mark)
            out, source = out[:size], source[: size + 1]
        return out, source

    def normalise_all(self, texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray]:
        """The normalised texts end to end, the byte of its text that each of their bytes came
        from, and for each text where its last byte's source ends."""
        if self.changes_spaces_only and len(texts.data):
            begins, data = texts.begins, texts.data
            place = np.arange(len(data))
            owner = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, place, 0))
            text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
            head = len(SPACE if self.spec.escape else b" ") if self.spec.dummy_prefix else 0
            space = data == 0x20
            mark = SPACE if self.spec.escape else b" "
            wide = np.where(space, len(mark), 1)
            full = np.flatnonzero(np.diff(begins))
            wide[begins[:-1][full]] += head
            at = np.cumsum(wide)
            # The head of a text comes before its first byte, with the same source.
            grown = np.repeat(data, wide)
            spread = np.repeat(owner - begins[text], wide)
            first = at - wide
            for where in (first[begins[:-1][full]] if head else (), (at - len(mark))[space]):
                for i, byte in enumerate(mark):
                    grown[np.asarray(where, np.int64) + i] = byte
            return Texts(grown, np.concatenate([[0], at])[begins]), spread, np.diff(begins)
        raw = texts.data.tobytes()
        found = [self.normalise(raw[a:b]) for a, b in zip(texts.begins[:-1].tolist(), texts.begins[1:].tolist(), strict=True)]
        sizes = np.array([len(n) for n, _ in found], np.int64)
        return (
            Texts(np.frombuffer(b"".join(n for n, _ in found), np.uint8), np.concatenate([[0], np.cumsum(sizes)])),
            np.concatenate([np.zeros(0, np.int64), *[s[:-1] for _, s in found]]),
            np.array([s[-1] for _, s in found], np.int64),
        )

    @property
    def changes_spaces_only(self) -> bool:
        return not (self.spec.charsmap or self.spec.own_symbols or self.spec.drop_extra_spaces)

    def _spaces_only(self, text: bytes, data: np.ndarray) -> tuple[bytes, np.ndarray]:
        owner = np.arange(len(data))
        owner = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, owner, 0)) if len(data) else owner
        return self._spaces(data, owner, 0, len(data))
