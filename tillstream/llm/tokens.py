"""Token ids of many texts by a tokenizer of the tokenizers library."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from tillstream.llm.textblock import Texts, separators

MOST_WORDS = 500_000  # cached words of a worker
_GAPS = separators(0x20, 0x0A)


def vocabulary_file(name: str, path: str | None = None) -> str:
    """path, or where this machine keeps the public vocabulary of that name."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Encodes each different word once and puts the ids of texts together from them.

    For tokenizers that never join what stands on two sides of a space or a line feed,
    and drop both: those whose pre-tokenizer takes matches free of white space and
    whose normalizer works on single characters.  Others are refused.  Words are found
    by a 64-bit hash, which is one to one up to 8 bytes.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.forget()

        kinds = _kinds(file)
        if not kinds:
            raise ValueError(f"{file} does not work word by word")
        self.library = Tokenizer.from_file(file)
        self.library.no_padding()
        self.library.no_truncation()
        self.mark, self.mark_id, suffix = kinds
        self.ends = None
        if suffix:  # which ids end a word
            self.ends = np.zeros(self.library.get_vocab_size(), bool)
            self.ends[[i for token, i in self.library.get_vocab().items() if token.endswith(suffix)]] = True

    def forget(self) -> None:
        """Drop the words known so far, as a worker does at the end of a task."""
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and each word's number of ids.

        Words of letters only go to the library many at a time with spaces between,
        and are told apart by their word-end tokens; others with a special token between.
        """
        found: list = [None] * len(words)
        letters, others = [], []
        for i, word in enumerate(words):
            if self.ends is not None and word.isalpha():
                letters.append(i)
            elif "<|" not in word and "|>" not in word:
                others.append(i)
        for group, between in ((letters, " "), (others, self.mark)):
            for k in range(0, len(group), 512):
                chunk = group[k : k + 512]
                ids = self._ids(between.join([words[i] for i in chunk]))
                if between == " ":
                    end = np.flatnonzero(self.ends[ids]) + 1
                    begin = np.concatenate([[0], end[:-1]])
                else:
                    cuts = np.flatnonzero(ids == self.mark_id)
                    begin, end = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
                if len(end) == len(chunk):
                    for i, a, b in zip(chunk, begin.tolist(), end.tolist(), strict=True):
                        found[i] = ids[a:b]
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self._ids(words[i])
        sizes = np.array([len(x) for x in found], np.int64)
        return (np.concatenate(found) if found else np.zeros(0, np.uint32)), sizes

    def _learn(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> None:
        """Encode the words (distinct, hashes h ascending) that are not known."""
        raw = texts.data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids, sizes = self._encode(words)
        if len(self.known) + len(h) > MOST_WORDS:
            self.known, self.place, self.size, self.ids = h[:0], sizes[:0], sizes[:0], ids[:0]
        place = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.known, h)
        self.known = np.insert(self.known, at, h)
        self.place = np.insert(self.place, at, place)
        self.size = np.insert(self.size, at, sizes)
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins (one more at the end)."""
        return self.encode_spans(texts, *texts.words(_GAPS))

    def encode_spans(
        self, texts: Texts, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """As encode, of texts whose words and whose first words are given."""
        h = texts.hashes(starts, ends)
        different, first, which = np.unique(h, return_index=True, return_inverse=True)
        if len(different) > MOST_WORDS:
            self.known = self.known[:0]  # so that all of one call fit
        at = np.searchsorted(self.known, different)
        fresh = np.ones(len(different), bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != different[inside]
        if fresh.any():
            if len(self.known) + int(fresh.sum()) > MOST_WORDS:
                self.known, fresh = self.known[:0], np.ones(len(different), bool)
            if not len(self.known):
                self.place, self.size, self.ids = self.place[:0], self.size[:0], self.ids[:0]
            new = first[fresh]
            self._learn(texts, starts[new], ends[new], different[fresh])
            at = np.searchsorted(self.known, different)
        place, size = self.place[at][which], self.size[at][which]
        to = np.cumsum(size)
        total = int(to[-1]) if len(to) else 0
        step = np.ones(total, np.int64)
        some = size > 0
        p, s, t = place[some], size[some], (to - size)[some]
        if total:
            step[t] = p
            step[t[1:]] -= p[:-1] + s[:-1] - 1
        source = np.cumsum(step)
        begins = np.concatenate([[0], to])[firsts]
        return self.ids[source], begins


@lru_cache(maxsize=8)
def _kinds(file: str) -> tuple[str, int, str | None] | None:
    """A special token to set words apart with, its id, and the suffix of tokens that end a
    word, if the tokenizer works word by word."""
    with open(file, encoding="utf-8") as f:
        said = json.load(f)
    parts = (said.get("normalizer") or {}).get("normalizers", [])
    first = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    fits = (
        {p["type"] for p in parts} <= {"NFC", "Replace", "Lowercase"}
        and all(p.get("content", " ") == " " for p in parts)
        and first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and first.get("invert")
        and said.get("post_processor") is None
    )
    marks = [t for t in said["added_tokens"] if not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])]
    if not fits or not marks or len(marks) < len(said["added_tokens"]):
        return None
    return marks[0]["content"], marks[0]["id"], said["model"].get("end_of_word_suffix")


@lru_cache(maxsize=2)
def word_tokenizer(file: str) -> WordTokenizer:
    """One per worker process, so that its cache serves all tasks of the worker."""
    return WordTokenizer(file)
