"""Plain statements of what the operators return, over lists of rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def raw(text: str | None) -> bytes:
    return (text or "").encode()


def words(text: str | None) -> list[bytes]:
    return WORD.findall(raw(text))


def lowered(text: str | None) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw(text))


def shingle_set(text: str | None) -> set:
    w = WORD.findall(lowered(text))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(docs: list[tuple]) -> list[tuple]:
    """op7 over (doc_id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in by[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)]


def quality_base(text: str | None) -> tuple:
    """op8: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = [x.decode() for x in words(text)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return (
        n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def cut(docs: list[tuple], length: int = 200) -> list[tuple]:
    """op10 over (doc_id, text)."""
    texts = [raw(t) for _, t in docs]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def crc_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def revisits(pages: list[tuple]) -> list[tuple]:
    """op6 over (page_id, html)."""
    keeper: dict = {}
    for p, h in pages:
        if len(raw(h)) >= 1000 and p is not None:
            keeper[raw(h)] = max(p, keeper.get(raw(h), p))
    out = []
    for p, h in pages:
        k = keeper.get(raw(h)) if len(raw(h)) >= 1000 else None
        again = k is not None and p != k
        out.append((p, len(raw(h)), hashlib.sha1(raw(h)).hexdigest(), "revisit" if again else "response", k if again else None))
    return out


def told(turns: list[tuple]) -> dict:
    """op1 over (conv_id, turn, role, text): n_turns, turns_sha256, loss_chars, loss_sha256."""
    by = defaultdict(list)
    for c, *t in turns:
        by[c].append(t)
    out = {}
    for c, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in rows)
        loss = "".join(t or "" for _, r, t in rows if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(rows), sha(whole), len(loss), sha(loss))
    return out
