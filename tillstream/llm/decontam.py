"""Benchmark decontamination: SimHash over windows of the size of an item.

A document leaks an item if a window with as many 5-word shingles as the item is similar
to it: the weighted Jaccard similarity of their shingle sets is at least SIMILAR.  A text
with fewer shingles than the item is one window as a whole.  Rare
shingles weigh more; one that no item has weighs most.

Windows are found by fingerprint.  A SimHash has 256 bits; at similarity 0.8 two of them
differ in some 36 to 47 bits on average, and 63 are allowed.  For items of few shingles it
is up to 63, as few signs make a sum, and 95 are allowed.  Of 32 blocks of 8 bits at least
one then differs in one bit (two bits) at most, so looking up each block and its neighbours
at that distance finds all fingerprints in the radius.  Only windows of which at least SIMILAR
of the shingles are known to items of their size are fingerprinted, by sums that slide.

A shingle that is repeated in a window counts once for the similarity and each time for
the fingerprint, so an exact supplement follows.  The heaviest shingles of an item that make
up more than 1 - SIMILAR of its weight are its anchors: a window without any of them cannot
reach the threshold.  Texts with an anchor are compared with the item by weight, and windows
that share enough weight are taken.  All that is found either way is verified by the exact
similarity, so no window is missed; found_by says which way found an item in a text.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.store import filesystem, ship_code, work_area, write_file, written
from tillstream.llm.textblock import Texts, blocks, mix, separators, shingles

WIDTH = 5
SIMILAR = (80, 100)
BITS, BLOCK_BITS = 256, 8
RADIUS, FEW, RADIUS_OF_FEW = 63, 16, 95  # bits that may differ, and those of an item of FEW shingles or less
STRETCH = 2048  # windows, or shingles, whose signs are held at once
ITEM_BLOCK, ITEM_BYTES = 20_000, 16_000_000  # items of one pass over the documents, at most
KNOWN_BLOCK = 2_000_000  # shingles of items whose weights go to the tasks at once, at most
WEIGHT = 1000  # weights are whole thousandths
# Words are runs of letters and digits; bytes of other scripts count as letters.
APART = separators(*(b for b in range(128) if not chr(b).isalnum()))
LEAKS = "array<struct<item_id: bigint, similarity: double, `from`: bigint, `to`: bigint, found_by: string>>"
_U = np.uint64


def _places(texts: Texts, width: int):
    """Shingle hashes of texts, where each text's begin, and word starts, ends and first words."""
    low = texts.lower()
    starts, ends, firsts = low.words(APART)
    h, at = shingles(low.hashes(starts, ends), firsts, width)
    if len(h):
        short = np.flatnonzero((np.diff(firsts) < width) & (np.diff(at) > 0))
        h[at[short]] = mix(h[at[short]] + _U(1))  # never equal to a shingle of that width
    return h, at, starts, ends, firsts


def _signs(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A row of BITS weights for each shingle, with the signs of its hash's bits."""
    wide = np.stack([mix(h ^ _U(0xA5A5A5A5A5A5A5A5 + 0x0101010101010101 * k)) for k in range(BITS // 64)], axis=1)
    bits = np.unpackbits(wide.view(np.uint8), axis=1)
    return (bits.astype(np.int64) * 2 - 1) * weight[:, None]


# What a sum of zero counts as: by bit, half of them each way.
_TIES = np.arange(BITS) * 37 % 64 < 32


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Rows of BITS / 8 bytes."""
    return np.packbits((sums > 0) | ((sums == 0) & _TIES), axis=1)


def _sum_of(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The sum of the shingles' signs, a stretch at a time."""
    return sum(
        (_signs(h[a : a + STRETCH], weight[a : a + STRETCH]).sum(axis=0) for a in range(0, len(h), STRETCH)),
        np.zeros(BITS, np.int64),
    )


def _window_prints(h: np.ndarray, weight: np.ndarray, first: int, last: int, m: int) -> Iterator[tuple[int, np.ndarray]]:
    """Fingerprints of the windows of m shingles that begin from first to last, by stretches
    with their first begin.  Sums slide: what enters is added and what leaves taken away."""
    held = _sum_of(h[first : first + m], weight[first : first + m])
    for a in range(first, last + 1, STRETCH):
        n = min(STRETCH, last + 1 - a)
        steps = np.zeros((n, BITS), np.int64)
        steps[0] = held
        out, into = slice(a, a + n - 1), slice(a + m, a + m + n - 1)
        steps[1:] = _signs(h[into], weight[into]) - _signs(h[out], weight[out])
        sums = np.cumsum(steps, axis=0)
        yield a, _fingerprints(sums)
        if a + n <= last:
            held = sums[-1] + _signs(h[a + m + n - 1 :][:1], weight[a + m + n - 1 :][:1])[0]
            held = held - _signs(h[a + n - 1 :][:1], weight[a + n - 1 :][:1])[0]


def _stretches(hits: np.ndarray, need: int, m: int, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last begins of runs of windows of m that hold at least need of the hits.

    A window that holds hits i to i + need - 1 begins from m - 1 before the latter to the
    former; all such windows together are those runs, so nothing as large as hits times m
    is formed.  lows and highs bound the text of each hit.
    """
    if len(hits) < need:
        return hits[:0], hits[:0]
    begin, end, low, high = hits[: len(hits) - need + 1], hits[need - 1 :], lows[: len(hits) - need + 1], highs[need - 1 :]
    same = low == lows[need - 1 :]
    first, last = np.maximum(end - m + 1, low)[same], np.minimum(begin, high - m)[same]
    first, last = first[first <= last], last[first <= last]
    if not len(first):
        return first, last
    # Both ascend, so runs that touch are merged by a look at the neighbour.
    apart = np.flatnonzero(first[1:] > np.maximum.accumulate(last)[:-1] + 1) + 1
    cut = np.concatenate([[0], apart, [len(first)]])
    return first[cut[:-1]], np.maximum.reduceat(last, cut[:-1])


def _weigh(items: int, n: np.ndarray) -> np.ndarray:
    """Weights of shingles that n of so many items have; 0 for one that none has."""
    return np.round(WEIGHT * (np.log((items + 1) / (n + 1)) + 1)).astype(np.int64)


def _items_by_width(texts: Texts) -> Iterator[tuple[int, dict[int, np.ndarray]]]:
    """For each width the shingles of the items that have it, by number of the item."""
    words = np.diff(texts.words(APART)[2])
    for width in range(1, WIDTH + 1):
        own = np.flatnonzero(words >= WIDTH if width == WIDTH else words == width)
        if len(own):
            h, at, *_ = _places(texts, width)
            yield width, {int(i): h[at[i] : at[i + 1]] for i in own}


class Weights:
    """Numbers of items by width, and a part of the shingles by width with their weights."""

    def __init__(self, items: dict[int, int], known: dict[int, np.ndarray], n: dict[int, np.ndarray]):
        order = {width: np.argsort(h) for width, h in known.items()}
        self.items = items
        self.known = {width: h[order[width]] for width, h in known.items()}
        self.weight = {width: _weigh(items[width], x[order[width]]) for width, x in n.items()}

    def of(self, width: int, h: np.ndarray) -> np.ndarray:
        """Weights of shingles, 0 for those that are not in this part."""
        known = self.known.get(width, np.zeros(0, _U))
        if not len(known):
            return np.zeros(len(h), np.int64)
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return np.where(known[place] == h, self.weight[width][place], 0)


class Index:
    """Items of one pass, by width of shingles and number of shingles.

    Weights are those of all items: without them, the items of this pass are all.
    """

    def __init__(self, ids: list[int | None], texts: list[str | None], weights: Weights | None = None):
        block = Texts.of(pa.array(texts, pa.string()))
        self.widths: dict[int, dict] = {}
        for width, sets in _items_by_width(block):
            known, n = np.unique(np.concatenate([np.unique(x) for x in sets.values()]), return_counts=True)
            many = weights.items[width] if weights else len(sets)
            top = int(_weigh(many, np.zeros(1))[0])
            weight = weights.of(width, known) if weights else _weigh(many, n)
            part = {"known": known, "weight": weight, "top": top, "sizes": {}}
            part["items"] = [(ids[i], x) for i, x in sets.items()]
            for k, (_, x) in enumerate(part["items"]):
                part["sizes"].setdefault(len(x), []).append((k, x))
            # Which sizes of items have each known shingle.
            sizes = sorted(part["sizes"])
            places = [np.searchsorted(known, np.unique(np.concatenate([x for _, x in part["sizes"][m]]))) for m in sizes]
            place, size = np.concatenate(places), np.repeat(np.arange(len(sizes)), [len(x) for x in places])
            order = np.argsort(place, kind="stable")
            part["of_size"] = (sizes, np.searchsorted(place[order], np.arange(len(known) + 1)), size[order])
            for m, items in part["sizes"].items():
                sums = np.array([_sum_of(x, weight[np.searchsorted(known, x)]) for _, x in items])
                part["sizes"][m] = (np.array([k for k, _ in items]), _fingerprints(sums))
            self._anchor(part)
            bits = np.zeros(1 << 20, bool)
            bits[(known >> _U(44)).astype(np.int64)] = True
            part["bits"] = bits
            self.widths[width] = part

    @staticmethod
    def _anchor(part: dict) -> None:
        """Places in known of each item's different shingles, its weight, and the items of each anchor."""
        known, weight, items = part["known"], part["weight"], part["items"]
        part["own"] = [np.searchsorted(known, np.unique(x)) for _, x in items]
        part["sums"] = np.array([int(weight[x].sum()) for x in part["own"]], np.int64)
        places, owners = [], []
        for k, x in enumerate(part["own"]):
            x = x[np.argsort(-weight[x], kind="stable")]
            before = np.cumsum(weight[x]) - weight[x]
            x = x[SIMILAR[1] * before <= (SIMILAR[1] - SIMILAR[0]) * part["sums"][k]]
            places.append(x)
            owners.append(np.full(len(x), k))
        place, owner = np.concatenate(places), np.concatenate(owners)
        order = np.argsort(place, kind="stable")
        part["anchors"] = (place[order], owner[order])

    def leaks(self, texts: Texts, others: dict[int, np.ndarray] | None = None) -> list[list[dict]]:
        """For each text the items it leaks, each with its most similar window.

        others are weights of all the texts' shingles by width, 0 where no item has one.
        """
        found: list[dict] = [{} for _ in range(len(texts.begins) - 1)]
        for width, part in self.widths.items():
            h, at, starts, ends, firsts = _places(texts, width)
            if not len(h):
                continue
            maybe = np.flatnonzero(part["bits"][(h >> _U(44)).astype(np.int64)])
            place = np.searchsorted(part["known"], h[maybe])
            place[place == len(part["known"])] = 0
            sure = part["known"][place] == h[maybe]
            hits, place = maybe[sure], place[sure]
            if not len(hits):
                continue
            weight = np.full(len(h), part["top"], np.int64)
            if others is not None:
                weight = np.where(others[width] > 0, others[width], part["top"])
            weight[hits] = part["weight"][place]
            text_of = np.searchsorted(at, hits, side="right") - 1
            lows, highs = at[text_of], at[text_of + 1]
            near = set()
            for m, mine in self._hits_by_size(hits, place, part):
                numbers, prints = part["sizes"][m]
                known, low, high = hits[mine], lows[mine], highs[mine]
                need = -(-SIMILAR[0] * m // SIMILAR[1])
                radius = RADIUS if m > FEW else RADIUS_OF_FEW
                for first, last in zip(*_stretches(known, need, m, low, high), strict=True):
                    for a, own in _window_prints(h, weight, int(first), int(last), m):
                        near.update((a + w, int(numbers[k])) for w, k in self._near(own, prints, radius))
                # Texts with fewer shingles than the item are one window.
                texts_of, many = np.unique(text_of[mine], return_counts=True)
                size = at[texts_of + 1] - at[texts_of]
                for text in texts_of[(size < m) & (many >= need)]:
                    whole = slice(at[text], at[text + 1])
                    own = _fingerprints(_sum_of(h[whole], weight[whole])[None, :])
                    near.update((int(at[text]), int(numbers[k])) for _, k in self._near(own, prints, radius))
            for a, k in sorted(near | set(self._sharing(hits, place, text_of, at, part))):
                item_id, shingle = part["items"][k]
                text = int(np.searchsorted(at, a, side="right")) - 1
                m = min(len(shingle), int(at[text + 1] - at[text]))
                value = self._similarity(h[a : a + m], weight[a : a + m], shingle, part)
                if value is None:
                    continue
                word = int(firsts[text] + a - at[text])
                base = int(texts.begins[text])
                row = {
                    "item_id": item_id, "similarity": value, "from": int(starts[word]) - base,
                    "to": int(ends[word + m + width - 2]) - base, "found_by": "anchors",
                }
                old = found[text].get(item_id)
                if (a, k) in near or (old and old["found_by"] == "fingerprint"):
                    row["found_by"] = "fingerprint"
                    if old:
                        old["found_by"] = "fingerprint"
                if old is None or (-value, row["from"]) < (-old["similarity"], old["from"]):
                    found[text][item_id] = row
        return [sorted(x.values(), key=lambda r: (r["item_id"] is not None, r["item_id"] or 0)) for x in found]

    @staticmethod
    def _hits_by_size(hits, place, part) -> Iterator[tuple[int, np.ndarray]]:
        """For each size of items those hits, in order, that an item of the size has."""
        sizes, begin, of = part["of_size"]
        many = begin[place + 1] - begin[place]
        hit = np.repeat(np.arange(len(hits)), many)
        size = of[np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[place], many)]
        order = np.argsort(size, kind="stable")
        cut = np.searchsorted(size[order], np.arange(len(sizes) + 1))
        for k, m in enumerate(sizes):
            if SIMILAR[1] * (cut[k + 1] - cut[k]) >= SIMILAR[0] * m:
                yield m, hit[order[cut[k] : cut[k + 1]]]

    @staticmethod
    def _sharing(hits, place, text_of, at, part) -> Iterator[tuple[int, int]]:
        """(window, item) that may share SIMILAR of the item's weight: all that can reach the threshold."""
        anchors, owners = part["anchors"]
        left = np.searchsorted(anchors, place, side="left")
        many = np.searchsorted(anchors, place, side="right") - left
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        n = len(part["items"])
        pair = np.unique(np.repeat(text_of, many) * n + owners[np.repeat(left, many) + step])
        key = text_of * len(part["known"]) + place
        order = np.argsort(key, kind="stable")
        key, where = key[order], hits[order]
        for text, k in zip((pair // n).tolist(), (pair % n).tolist(), strict=True):
            own = part["own"][k]
            lo = np.searchsorted(key, text * len(part["known"]) + own, side="left")
            many = np.searchsorted(key, text * len(part["known"]) + own, side="right") - lo
            need = SIMILAR[0] * int(part["sums"][k])
            if SIMILAR[1] * int(part["weight"][own[many > 0]].sum()) < need:
                continue
            m = min(len(part["items"][k][1]), int(at[text + 1] - at[text]))
            first, last = int(at[text]), int(at[text + 1]) - m
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            seen = where[np.repeat(lo, many) + step]
            order = np.argsort(seen)
            seen, sums = seen[order], np.concatenate([[0], np.cumsum(np.repeat(part["weight"][own], many)[order])])
            # What a window shares changes only where a shared shingle enters or leaves it.
            edge = np.unique(np.clip(np.concatenate([[first], seen - m + 1, seen + 1]), first, last))
            shared = sums[np.searchsorted(seen, edge + m)] - sums[np.searchsorted(seen, edge)]
            ends = np.append(edge[1:], last + 1)
            for a, b in zip(edge[SIMILAR[1] * shared >= need].tolist(), ends[SIMILAR[1] * shared >= need].tolist(), strict=True):
                yield from ((begin, k) for begin in range(a, b))

    @staticmethod
    def _near(own: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
        """(window, item) whose fingerprints are at most radius bits apart, each once.

        Some block differs in radius * BLOCK_BITS / BITS bits at most.
        """
        every = np.arange(1 << BLOCK_BITS, dtype=np.uint8)
        flips = every[np.bitwise_count(every) <= radius * BLOCK_BITS // BITS]
        step = max(1, 2_000_000 // max(len(prints), 1))  # pairs compared at once
        for a in range(0, len(own), step):
            part = own[a : a + step]
            pairs = []
            for block in range(BITS // BLOCK_BITS):
                value = prints[:, block]
                order = np.argsort(value, kind="stable")
                ordered = value[order]
                probe = (part[:, block, None] ^ flips[None, :]).ravel()
                left = np.searchsorted(ordered, probe, side="left")
                many = np.searchsorted(ordered, probe, side="right") - left
                who = np.repeat(np.arange(len(probe)) // len(flips), many)
                inside = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
                pairs.append(who * len(prints) + order[np.repeat(left, many) + inside])
            pair = np.unique(np.concatenate(pairs))
            who, k = pair // len(prints), pair % len(prints)
            for b in range(0, len(who), 200_000):
                x, y = who[b : b + 200_000], k[b : b + 200_000]
                close = np.bitwise_count(part[x] ^ prints[y]).sum(axis=1) <= radius
                yield from zip((x[close] + a).tolist(), y[close].tolist(), strict=True)

    @staticmethod
    def _similarity(window, weight, item, part) -> float | None:
        """The weighted Jaccard similarity of two runs of shingles as sets, or None below SIMILAR."""
        own, first = np.unique(window, return_index=True)
        other = np.unique(item)
        both = np.isin(other, own)
        item_weight = part["weight"][np.searchsorted(part["known"], other)]
        shared = int(item_weight[both].sum())
        union = int(weight[first].sum()) + int(item_weight.sum()) - shared
        return shared / union if SIMILAR[1] * shared >= SIMILAR[0] * union else None


def flag_leaks(docs: DataFrame, items: DataFrame, name: str = "leaks") -> DataFrame:
    """docs and an array column `name` (must be free) of the items (item_id, text) each leaks.

    An entry has item_id, similarity, the byte span of the most similar window, the
    earliest of equals, and found_by ('fingerprint' or 'anchors').  No shuffle: items go to the tasks, ITEM_BLOCK at most in one pass
    over the documents.  Items that share an id are one; items without words leak nowhere,
    an item of fewer than WIDTH words is one shingle of its own.  A null text leaks
    nothing; repeated rows each get their entries; other columns are kept; without items
    or without docs nothing leaks.  The number of passes changes nothing: weights are
    those of all items.  Memory grows with a text's and an item's length, not their product.
    """
    ship_code(docs.sparkSession)
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    passes = max(1, math.ceil(size["n"] / ITEM_BLOCK), math.ceil((size["bytes"] or 0) / ITEM_BYTES))
    kind = T.StructType([*docs.schema.fields, T.StructField(name, T.DataType.fromDDL(LEAKS))])
    type_ = pa.list_(
        pa.struct(
            [("item_id", pa.int64()), ("similarity", pa.float64()), ("from", pa.int64()), ("to", pa.int64()), ("found_by", pa.string())]
        )
    )
    # What a pass needs lies in a file that its tasks open, so the driver holds one at a time.
    area = work_area(docs.sparkSession, "items")
    out = docs.withColumn(name, F.array().cast(LEAKS))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    many: dict[int, int] = {}
    weighed = None
    if passes > 1:
        # Weights must not depend on the passes: each text gets those of all its shingles first.
        counted = written(_document_frequencies(items), "shingles")
        total = counted.where("h is null").collect()  # one row a width
        many = {r["width"]: r["n"] for r in total}
        weighed = _unused(docs.columns, name)
        out = out.withColumn(weighed, F.array().cast("array<binary>"))
        kind = T.StructType([*kind.fields, T.StructField(weighed, T.ArrayType(T.BinaryType()))])
        slices = max(1, math.ceil(counted.count() / KNOWN_BLOCK))
        for k in range(slices):
            weights = _weights(counted.where("h is not null").where(F.pmod(F.xxhash64("h"), F.lit(slices)) == k), many)
            path = f"{area}/weights-{k}"
            write_file(path, pickle.dumps(weights))
            del weights

            def weigh(batches: Iterable[pa.RecordBatch], path=path) -> Iterator[pa.RecordBatch]:
                weights = _opened(path)
                for batch, texts in blocks(batches, "text"):
                    yield _replaced(batch, weighed, pa.array(_add_weights(batch.column(weighed), texts, weights), pa.list_(pa.binary())))

            out = out.mapInArrow(weigh, kind)
    for k in range(passes):
        rows = items.where(part == k).orderBy("item_id", "text").collect()
        own = None
        if passes > 1:
            mine = _document_frequencies(items.where(part == k)).select("width", "h").where("h is not null")
            own = _weights(counted.join(mine, ["width", "h"], "left_semi"), many)
        path = f"{area}/items-{k}"
        write_file(path, pickle.dumps(Index([r[0] for r in rows], [r[1] for r in rows], own)))
        del rows, own

        def flag(batches: Iterable[pa.RecordBatch], path=path) -> Iterator[pa.RecordBatch]:
            index = _opened(path)
            for batch, texts in blocks(batches, "text"):
                others = _joined(batch.column(weighed), many) if weighed else None
                found = [a + b for a, b in zip(batch.column(name).to_pylist(), index.leaks(texts, others), strict=True)]
                yield _replaced(batch, name, pa.array(found, type_))

        out = out.mapInArrow(flag, kind)
    return out.drop(weighed) if weighed else out


@lru_cache(maxsize=1)
def _opened(path: str):
    """What a pass needs; a worker keeps the last one."""
    store, inside = filesystem(path)
    with store.open_input_stream(inside) as found:
        return pickle.loads(found.read())


def _unused(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in [*columns, name]}
    return next(c for c in (f"weights_{k}" for k in range(len(taken) + 1)) if c not in taken)


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), name, column)


def _document_frequencies(items: DataFrame) -> DataFrame:
    """width, h, n: how many items have a shingle; with null h, how many have shingles of that width."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, "text"):
            for width, sets in _items_by_width(texts):
                h = np.concatenate([np.unique(x) for x in sets.values()]).view(np.int64)
                h = pa.concat_arrays([pa.array(h), pa.nulls(len(sets), pa.int64())])
                yield pa.record_batch({"width": pa.array(np.full(len(h), width, np.int32)), "h": h})

    return items.select("text").mapInArrow(cut, "width int, h long").groupBy("width", "h").agg(F.count(F.lit(1)).alias("n"))


def _weights(counted: DataFrame, many: dict[int, int]) -> Weights:
    rows = counted.select("width", "h", "n").toArrow()
    width, h, n = (rows.column(k).to_numpy() for k in range(3))
    return Weights(many, {w: h[width == w].view(_U) for w in many}, {w: n[width == w] for w in many})


def _add_weights(column: pa.Array, texts: Texts, weights: Weights) -> list[list[bytes]]:
    """For each text and width a 32-bit weight of each shingle, those of this part added."""
    out: list[list[bytes]] = [[] for _ in range(len(column))]
    before = _joined(column, weights.items)
    for width in sorted(weights.items):
        h, at, *_ = _places(texts, width)
        weight = weights.of(width, h)
        if len(before[width]):
            weight = weight + before[width]
        raw = weight.astype("<i4").tobytes()
        for i, row in enumerate(out):
            row.append(raw[4 * at[i] : 4 * at[i + 1]])
    return out


def _joined(column: pa.Array, widths: Iterable[int]) -> dict[int, np.ndarray]:
    """Weights of the texts' shingles end to end, by width; empty where no part was added yet."""
    rows = column.to_pylist()
    return {
        width: np.frombuffer(b"".join(r[k] for r in rows if r), "<i4").astype(np.int64) for k, width in enumerate(sorted(widths))
    }
