"""Long repeats by breadth-first backward extension on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places (32 bits) of text (symbols below 512) in the order of at least their first depth symbols."""
    n = len(text)
    width = 7
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(width):
        key = (key << 9) | padded[j : j + n]
    while True:
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        step = np.zeros(n, np.int32)
        np.cumsum(key[1:] != key[:-1], out=step[1:])
        if width >= depth or step[-1] == n - 1:
            return order
        rank = np.empty(n, np.int32)
        rank[order] = step + 1
        key = rank * np.int64(n + 2)
        if width < n:
            key[: n - width] += rank[width:]
        width *= 2


def repeated_places(text: np.ndarray, length: int) -> np.ndarray:
    """For each place of text whether its next `length` symbols stand at another place, too.

    text is an array of symbols below 512.  Intervals of the suffix array are extended
    backwards, level by level: the intervals of level l are those of words of l symbols.
    Where an extended interval ends at a border that has no value yet, the common prefix
    of the two suffixes there is l; each border gets its value once, in ascending order of
    values, and only such intervals are extended further.  The expansion stops at
    `length`: borders without a value then have a longer common prefix.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, bool)
    # A last symbol below all others makes the transform one of suffixes.
    symbols = np.zeros(n + 1, np.int16)  # 16 bits are sorted by radix
    symbols[:-1] = text + 1
    order = sorted_suffixes(symbols, length + 1)
    before = symbols[order - 1]
    forward = np.empty(n + 1, np.int32)  # the place of a suffix that begins one symbol earlier
    forward[np.argsort(before, kind="stable")] = np.arange(n + 1, dtype=np.int32)
    value = np.full(n + 2, -1, np.int16)
    value[0] = value[n + 1] = 0
    begin, end = np.array([0], np.int32), np.array([n + 1], np.int32)
    for level in range(length):
        if not len(begin):
            break
        size = end - begin
        to = np.cumsum(size, dtype=np.int32)
        owner = np.repeat(np.arange(len(begin), dtype=np.int32), size)
        place = np.arange(to[-1], dtype=np.int32) + (begin - to + size)[owner]
        moved, symbol = forward[place], before[place]
        del place
        turn = np.argsort(moved).astype(np.int32)
        moved, owner, symbol = moved[turn], owner[turn], symbol[turn]
        del turn
        cut = np.flatnonzero((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]))
        begin = moved[np.concatenate([[0], cut + 1])]
        end = moved[np.concatenate([cut, [len(moved) - 1]])] + 1
        fresh = value[end] < 0
        begin, end = begin[fresh], end[fresh]
        value[end] = level
    long = value[: n + 2] < 0
    repeated = np.zeros(n + 1, bool)
    repeated[order] = long[:-1] | long[1:]
    return repeated[:n]
