"""Every query over the small tables against a plain statement of its result."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest
import sentencepiece
from given import DOCS, SMALL
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm import quality, queries

ALL = queries.queries()
NASTY = [None, "", " \n\t ", "one", "two words", "A b C d E", "x" * 5000, "aé" * 700, "ab " * 400]


def got(spark, name, folder):
    full = next(n for n in ALL if n.split("_")[0] == name)
    return [r.asDict() for r in ALL[full](spark, folder).collect()]


def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def nasty_docs():
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = list(NASTY)
    base, passage = prose(150), prose(60)
    for k in range(40):
        near = base.split()
        near[rng.randrange(150)] = f"edit{k}"
        texts.append(" ".join(near))
    texts += [base] * 12 + [prose(40) + " " + passage + " " + prose(40) for _ in range(25)]
    texts += [prose(n) for n in (5, 6, 7, 10, 60, 400)] + [prose(6)] * 2 + [prose(30) + "\n" + prose(30)] * 3
    docs = [(i * 3, t, "en", "s0", 1) for i, t in enumerate(texts)]
    docs += [docs[15], docs[15], (None, base, None, None, None), (None, "lonely words of no one at all", None, None, None)]
    rng.shuffle(docs)
    return docs


@pytest.fixture(params=["small", "nasty", "empty"])
def folder(request, make, nasty_docs, spark):
    """A folder and its rows (doc_id, text)."""
    if request.param == "small":
        rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
        return SMALL, rows
    docs = nasty_docs if request.param == "nasty" else []
    labels = [(d[0], 1, 0) for d in docs if d[0] is not None][::2]
    place = make(
        documents=(docs, DOCS),
        labels=(labels, "doc_id long, quality int, toxic int"),
        benchmark=([(1, NASTY[-1]), (2, None)], "item_id long, text string"),
    )
    return place, [d[:2] for d in docs]


def test_op3(spark, folder):
    place, docs = folder
    rows = got(spark, "op3", place)
    tool = library()
    want = Counter()
    for d, t in docs:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [0]
        for p, a in enumerate(range(0, len(ids), 2048)):
            want[d, p, a, len(ids[a : a + 2048]), brute.crc_ids(ids[a : a + 2048])] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    if rows:
        assert len(bins) <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_op4(spark, folder):
    place, docs = folder
    tool, start, want = library(), 0, []
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for d, t in order:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, len(ids), brute.crc_ids(ids)))
    rows = sorted(got(spark, "op4", place), key=lambda r: r["start"])
    assert Counter(want) == Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert [d for d, _, _ in want] == [r["doc_id"] for r in rows]
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]


def test_op5(spark, folder):
    place, docs = folder
    tool = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for d, t in docs:
        n = len(tool.encode(t or ""))
        want[d, len(brute.raw(t)), n, n > 4096] += 1
    rows = got(spark, "op5", place)
    assert want == Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows)
    # About an eighth of the texts had been counted before; equal texts agree.
    cached = {}
    texts = dict(docs)
    many = Counter(d for d, _ in docs)
    for r in (r for r in rows if many[r["doc_id"]] == 1):
        assert cached.setdefault(texts[r["doc_id"]], r["from_cache"]) == r["from_cache"]
    if len(docs) > 100:
        assert 0.02 < sum(r["from_cache"] for r in rows) / len(rows) < 0.4


def test_op7(spark, folder):
    place, docs = folder
    rows = got(spark, "op7", place)
    assert Counter(brute.components(docs)) == Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


def test_op8(spark, folder):
    place, docs = folder
    rows = got(spark, "op8", place)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((d, *brute.quality_base(t)) for d, t in docs) == Counter((r["doc_id"], *[r[n] for n in names]) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def plain_scores(docs, labels):
    """{(doc_id, text): (score, kept)} of op8 by plain Python: bucket counts, ratios, threshold."""
    mask = (1 << 64) - 1
    h = lambda data, seed: xxhash.xxh64_intdigest(data, seed)

    def grams(text):
        own = [h(w, 42) for w in brute.words(text)]
        pairs = [h(b.to_bytes(8, "little"), h(a.to_bytes(8, "little"), 42)) for a, b in zip(own, own[1:], strict=False)]
        return [x & mask & (quality.BUCKETS - 1) for x in own + pairs]

    quality_, toxic = defaultdict(list), defaultdict(list)
    for d, q, t in labels:
        quality_[d].append(q)
        toxic[d].append(t)
    trusted = {d for d in quality_ if d is not None and min(quality_[d]) == 1 and max(toxic[d]) == 0}
    raw, good = Counter(), Counter()
    for d, t in docs:
        raw.update(grams(t))
        if d in trusted:
            good.update(grams(t))
    n, m, prior = sum(raw.values()), sum(good.values()), quality.PRIOR
    share = {b: raw[b] / n for b in raw}
    ratio = {b: round(1e6 * (math.log((good[b] + prior * share[b]) / (m + prior)) - math.log(share[b]))) if m else 0 for b in raw}
    score = lambda t: (lambda g: sum(ratio[b] for b in g) / len(g) if g else None)(grams(t))
    known = sorted(s for s in (score(t) for d, t in docs if d in trusted) if s is not None)
    threshold = None
    if known:
        at = (len(known) - 1) * (1 - quality.KEEP_TRUSTED)
        low = math.floor(at)
        threshold = known[low] + (at - low) * (known[min(low + 1, len(known) - 1)] - known[low])
    out = {}
    for d, t in docs:
        s = score(t)
        fits = threshold is None or (s is not None and s >= threshold)
        out[d, t] = s, fits and not brute.quality_base(t)[-1], threshold is not None and s is not None and abs(s - threshold) < 2
    return out


def test_op8_scores_and_verdicts(spark, folder):
    place, docs = folder
    told = spark.read.parquet(f"{place}/labels.parquet")
    want = plain_scores(docs, [tuple(r) for r in told.select("doc_id", "quality", "toxic").collect()])
    table = spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "text")
    rows = quality.rate(table, told).select("doc_id", "text", "rated.score", "rated.kept").collect()
    assert len(rows) == len(docs)
    for r in rows:
        score, kept, edge = want[r["doc_id"], r["text"]]
        assert (r["score"] is None) == (score is None)
        assert score is None or abs(r["score"] - score) < 1e-3 * max(1, abs(score)) + 1
        assert edge or r["kept"] == kept
    if len(docs) > 100:
        assert {k for _, k, _ in want.values()} == {True, False}


@pytest.mark.parametrize("sent", [quality.SENT, 100])
def test_op8_trusts_all_good_labels(spark, sent):
    """More trusted documents than were once taken, by either way that marks them."""
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices([f"w{k}" for k in range(60)], k=rng.randrange(1, 5)))) for i in range(20_600)]
    labels = [(i, int(i % 50 > 0), 0) for i in range(20_600)]
    want = plain_scores(docs, labels)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality.trusted_ids(told).count() == 20_188
    rows = quality.rate(table, told, sent=sent).select("doc_id", "text", "rated.score").collect()
    assert len(rows) == len(docs)
    assert all(abs(r["score"] - want[r["doc_id"], r["text"]][0]) < 1e-3 * abs(r["score"]) + 1 for r in rows)


def test_op8_low_quantile(spark):
    values = [3.0, -1.5, 2.25, 2.25, 9.0, 4.5, 0.0]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    for share in (0.0, 0.002, 0.3, 0.5, 0.77, 1.0):
        assert quality.low_quantile(table, share) == pytest.approx(table.agg(F.percentile("v", F.lit(share))).first()[0])
    assert quality.low_quantile(table.limit(0), 0.5) is None


def test_op9(spark, folder):
    place, docs = folder
    rows = got(spark, "op9", place)
    want = Counter((d, len(brute.raw(t)) + 1, zlib.crc32(brute.raw(t))) for d, t in docs)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    shards = defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and 0 <= r["shard"] < 16 and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))
    if rows:
        sizes = Counter()
        for r in rows:
            sizes[r["shard"]] += r["size"]
        mean, largest = sum(sizes.values()) / 16, max(r["size"] for r in rows)
        assert all(abs(sizes[s] - mean) <= 0.02 * mean + 4 * largest for s in range(16))


def test_op10(spark, folder):
    place, docs = folder
    rows = got(spark, "op10", place)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(brute.cut(docs)) == Counter(tuple(r[n] for n in names) for r in rows)


def test_op2(spark, folder):
    """Passages that stand in a text word for word are found, and nothing unlike them."""
    place, docs = folder
    items = spark.read.parquet(f"{place}/benchmark.parquet").collect()
    flat = lambda t: b" " + b" ".join(brute.words((t or "").lower())) + b" "
    want = {(d, i) for d, t in docs for i, x in items if brute.words(x) and flat(x) in flat(t)}
    rows = got(spark, "op2", place)
    assert want <= {(r["doc_id"], r["item_id"]) for r in rows}
    assert all(0.8 <= r["similarity"] <= 1 and r["from_byte"] < r["to_byte"] for r in rows)
    texts = defaultdict(list)
    for d, t in docs:
        texts[d].append(brute.raw(t))
    item = {i: brute.shingle_set(x) for i, x in items}
    for r in rows:
        part = [t[r["from_byte"] : r["to_byte"]].decode(errors="replace") for t in texts[r["doc_id"]]]
        assert any(len(brute.shingle_set(p) & item[r["item_id"]]) >= 0.5 * len(item[r["item_id"]]) for p in part)


def pages_of(kind, spark):
    if kind == "small":
        return [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    long = "<p>copy</p>" * 200
    magic = "WARC/1.1\r\nContent-Length: 4\r\nWARC-Payload-Digest: sha1:x\r\nPayload-Length: 4\r\n\r\nabcd\r\n\r\n"
    rows = [(i, f"http://x/{i}", long) for i in range(30)] + [(40 + i, None, "short") for i in range(5)]
    rows += [(60, "http://x/\r\nEvil: 1", magic * 30), (61, "http://y", None), (62, "http://y", ""), (None, "u", long), (None, "v", "z" * 3000)]
    return rows + [(29, "http://x/29", long)]


@pytest.mark.parametrize("kind", ["small", "nasty", "empty"])
def test_op6(spark, make, kind):
    rows = [] if kind == "empty" else pages_of(kind, spark)
    place = SMALL if kind == "small" else make(pages=(rows, "page_id long, url string, html string"))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(brute.revisits([(p, h) for p, _, h in rows])) == Counter(tuple(r[n] for n in names) for r in got(spark, "op6", place))


@pytest.mark.parametrize("kind", ["small", "nasty", "empty"])
def test_op1(spark, make, kind):
    ddl = "conv_id long, turn long, role string, text string"
    tricky = "a\\b <|turn|>x<|says|> \\<|end|> <<SYS>> <</SYS>> <s></s> \\\\ <|en<|end|>d|> [INST]"
    rows = [
        (1, 0, "user", tricky), (1, 1, "assistant", tricky + "\n"), (1, 2, "user", None), (1, 2, "user", None),
        (2, 0, "user", "no answer"), (3, 0, "assistant", ""), (3, 1, "assistant", "é\n x"), (None, 0, "system", "s"),
        (None, None, None, None), (None, 1, "assistant", "y" * 50000), (4, 0, "assist<|end|>ant", "<"), (4, 1, "assistant", "|end|>"),
    ]
    if kind == "small":
        rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    elif kind == "empty":
        rows = []
    place = SMALL if kind == "small" else make(conversations=(rows, ddl))
    probe = "</s>[INST] ok [/INST]"
    want = brute.told([*rows, (-7, 0, "user", probe), (-7, 1, "assistant", probe)])
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert want == {r["conv_id"]: tuple(r[n] for n in names) for r in got(spark, "op1", place)}
