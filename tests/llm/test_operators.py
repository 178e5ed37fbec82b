"""What the operators do beyond their queries."""

from __future__ import annotations

import math
import random
import struct
import subprocess
import sys
import time
import uuid
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.llm import bwt, chat, counts, decontam, graph, jaccard, packing, quality, repeats, shards, tokenfile, tokens, warc
from tillstream.llm.store import gapless
from tillstream.llm.textblock import SPACES, Texts, blocks, shingles

settings.register_profile("llm", deadline=None)
settings.load_profile("llm")
PROSE = st.text(alphabet="abcAB é\n\t.,1'", max_size=60)


def texts_of(values):
    return Texts.of(pa.array(values, pa.string()))


@given(st.lists(st.none() | PROSE, max_size=6))
def test_words_and_shingles(values):
    block = texts_of(values)
    starts, ends, firsts = block.words(SPACES)
    raw = block.data.tobytes()
    found = [[raw[a:b] for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(firsts[:-1], firsts[1:], strict=True)]
    want = [(v or "").encode().split() for v in values]
    assert found == want
    h = block.hashes(starts, ends)
    flat = [w for ws in want for w in ws]
    assert len(set(h.tolist())) == len(set(flat))
    runs, at = shingles(h, firsts, 5)
    for k, ws in enumerate(want):
        n = len(ws)
        assert at[k + 1] - at[k] == (n - 4 if n >= 5 else min(n, 1))
    seen = {}
    for k, ws in enumerate(want):
        for i in range(at[k], at[k + 1]):
            words = tuple(ws[i - at[k] : i - at[k] + 5])
            assert seen.setdefault(int(runs[i]), words) == words


def test_trailing_nuls_are_part_of_a_word(spark):
    words = [w + "\0" * n for w in ("", "a", "abcdefg", "abcdefgh", "abcdefghi", "b" * 16, "c" * 509) for n in range(10) if w or n]
    block = texts_of([" ".join(words)])
    starts, ends, firsts = block.words(SPACES)
    assert len(set(block.hashes(starts, ends).tolist())) == len(words)
    five = texts_of(["a b c d e", "a b c d e\0", "a b\0 c d e", "a", "a\0"])
    starts, ends, firsts = five.words(SPACES)
    assert len(set(shingles(five.hashes(starts, ends), firsts, 5)[0].tolist())) == 5
    tool = tokens.word_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    values = ["a b", "a\0 b\0\0 b", "a\0", "abcdefghi\0 abcdefghi", "\0 \0\0"]
    ids, at = tool.encode(texts_of(values))
    for i, v in enumerate(values):
        assert ids[at[i] : at[i + 1]].tolist() == tool.library.encode(v, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a\0 b\0 c\0 d\0 e\0 f\0")], "doc_id long, text string")
    assert sorted(r.component_id for r in jaccard.similar_components(docs).collect()) == [1, 2]


@given(st.lists(PROSE | st.sampled_from(["<|endoftext|> x", "<|startoftext|>", "İstanbul naïve", "ΑΣ ας", "it's 12th", "a\u0301 \u00a0b"]), max_size=5))
def test_word_tokenizer_is_the_library(values):
    tool = tokens.word_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids, at = tool.encode(texts_of(values))
    for i, v in enumerate(values):
        assert ids[at[i] : at[i + 1]].tolist() == tool.library.encode(v, add_special_tokens=False).ids


def test_word_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    tool = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    for n in range(10):
        value = " ".join(f"w{n}x{k}" for k in range(30))
        ids, _ = tool.encode(texts_of([value]))
        assert ids.tolist() == tool.library.encode(value, add_special_tokens=False).ids
        assert len(tool.known) <= 60


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="word by word"):
        tokens.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))


# Token files.


def token_file(path, docs, frame_bytes=64):
    with open(path, "wb") as out:
        writer = tokenfile.Writer(out, 2, frame_bytes)
        for d, ids in docs:
            writer.add(d, np.array(ids, "<u2").tobytes())
        writer.close()


def test_reader_unpacks_only_the_frames_it_needs(tmp_path):
    docs = [(None, []), (1, [1, 2]), (2, list(range(100))), (2, [7]), (9, [])]
    token_file(tmp_path / "t.zst", docs)
    reader = tokenfile.Reader(str(tmp_path / "t.zst"))
    assert [reader.ids(i).tolist() for i in range(5)] == [ids for _, ids in docs]
    fresh = tokenfile.Reader(str(tmp_path / "t.zst"))
    assert fresh.ids(3).tolist() == [7] and fresh.n_unpacked == 1
    import zstandard

    data = (tmp_path / "t.zst").read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == b"".join(np.array(ids, "<u2").tobytes() for _, ids in docs)
    assert struct.unpack("<I", data[-4:])[0] == tokenfile.SEEK_MAGIC


def test_damage_is_found(tmp_path):
    token_file(tmp_path / "t.zst", [(1, list(range(200)))])
    data = bytearray((tmp_path / "t.zst").read_bytes())
    data[20] ^= 255
    (tmp_path / "t.zst").write_bytes(data)
    with pytest.raises(Exception):
        tokenfile.Reader(str(tmp_path / "t.zst")).ids(0)


# Token counts.


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_come_from_the_cache(spark, tmp_path, name):
    cache = str(tmp_path / "cache")
    ddl = "doc_id long, text string, n_tokens string"
    first = spark.createDataFrame([(1, "one two", "x"), (2, "one two", "x"), (3, None, "x")], ddl)
    got = {r.doc_id: r.n_tokens for r in counts.count_tokens(first, name, cache, limit=1).collect()}
    assert got[1] == got[2] > 0 and got[3] == 0
    assert spark.read.parquet(cache).count() == 2
    second = spark.createDataFrame([(4, "one two", None), (5, "three", None)], ddl)
    assert {r.doc_id: r.from_cache for r in counts.count_tokens(second, name, cache, limit=1).collect()} == {4: True, 5: False}
    assert spark.read.parquet(cache).count() == 3
    # A stored count is used, not computed anew.
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(cache + "2")
    assert {r.n_tokens for r in counts.count_tokens(second, name, cache + "2").collect()} == {77}


# Packing.


@given(
    st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12),
    st.integers(1, 6), st.sampled_from(["norm", "dot"]), st.integers(1600, 4000),
)
def test_every_constraint_holds(lengths, most, score, cost):
    capacity = packing.Capacity(40, most, cost, score=score)
    slices = packing.plan(lengths, capacity)
    placed, bins = Counter(), {}
    for length, rank, n, sequence, offset in slices.tolist():
        for k in range(n):
            placed[length, rank + k] += 1
            bins.setdefault(sequence + k, []).append((offset, length))
    assert placed == Counter({(length, k): 1 for length, n in lengths.items() for k in range(n)})
    for parts in bins.values():
        assert len(parts) <= most and sum(x * x for _, x in parts) <= cost
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_attention_cost_binds(spark, score):
    rng = random.Random(15)
    rows = [(i, 0, 0, rng.randint(1, 20)) for i in range(400)]
    found = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    sums = {}
    for cost in (500, 1600):
        placed = packing.pack(found, packing.Capacity(40, 40, cost, score=score)).collect()
        assert sorted((r.doc_id, r.length) for r in placed) == [(r[0], r[3]) for r in rows]
        used, lengths = Counter(), Counter()
        for r in placed:
            used[r.sequence_id] += r.length**2
            lengths[r.sequence_id] += r.length
        assert max(used.values()) <= cost and max(lengths.values()) <= 40
        sums[cost] = max(used.values()), len(used)
    assert sums[1600][0] > 500 and sums[500][1] > sums[1600][1]  # 500 is a limit that changes the packing
    with pytest.raises(ValueError, match="costs more"):
        packing.pack(found, packing.Capacity(40, 40, 399))


def test_sequences_are_put_together(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d e")], "doc_id long, text string")
    found = packing.pieces(docs, "word_bpe_49k.json", 0, 3, with_ids=True)
    rows = packing.sequences(packing.pack(found, packing.Capacity(3, 3, 9))).collect()
    flat = [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows]
    assert sum(map(len, flat)) == 4 + 1 + 3 and max(map(len, flat)) == 3
    with pytest.raises(ValueError):
        packing.pack(found, packing.Capacity(2, 2, 4))


def test_gapless_numbers(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.lit(1).alias("same"), "id")
    rows = gapless(df.unionByName(df.limit(20)), ["g"], ["same", "id"], "k", 7).collect()
    for g in range(3):
        own = sorted(r.k for r in rows if r.g == g)
        assert own == list(range(len(own)))


# Archives.


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("split", [37, 1000, 1 << 22])
def test_magic_inside_payloads_is_rejected(spark, tmp_path, zipped, split):
    inner = warc.record(99, "http://evil", b"x" * 50, None, __import__("hashlib").sha1(b"x" * 50).hexdigest())
    tool = zlib.compressobj(0, zlib.DEFLATED, 31)
    raw = tool.compress(inner) + tool.flush()
    html = [inner.decode(), "plain", raw.decode("latin-1"), "z" * 3000, None]
    pages = spark.createDataFrame([(i, f"http://p/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages.coalesce(1), zipped=zipped, file_bytes=1 << 20)
    files = manifest.collect()
    found = [c for f in files for a in range(0, f.size, split) for c in warc.candidates(f.path, f.size, a, min(f.size, a + split))]
    rows = warc.read_archives(manifest, split_bytes=split).collect()
    assert sorted(r.page_id for r in rows) == list(range(5))
    if not zipped:
        assert any(c["page_id"] == 99 for c in found)  # it was seen, and is not reachable


@pytest.mark.parametrize("plain", [None, "page_id % 2 = 0"])
def test_a_whole_table_with_records_in_its_payloads(spark, plain):
    """Every page holds records that look whole; the chain rejects each, in plain archives."""
    sha = lambda b: __import__("hashlib").sha1(b).hexdigest()
    pages = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    told = []
    for i, (p, u, h) in enumerate(pages):
        inner = b"".join(warc.record(10**6 + k, "http://evil", b"x" * k, None, sha(b"x" * k)) for k in range(i % 4))
        told.append((p, u, (h or "") + inner.decode() + "tail"))
    table = spark.createDataFrame(told, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(table, zipped=plain is not None, plain=F.expr(plain) if plain else None, file_bytes=1 << 18)
    rows = {r.page_id: r for r in warc.read_archives(manifest, split_bytes=40_000, count_rejected=True).collect()}
    assert len(rows) == len(told)
    bare = lambda p: plain is None or p % 2 == 0
    want = {p: (i % 4 if bare(p) and rows[p].record_type == "response" else 0) for i, (p, _, _) in enumerate(told)}
    assert {p: r.n_rejected for p, r in rows.items()} == want and sum(want.values()) >= 50
    assert all(rows[p].payload_digest == sha(h.encode()) for p, _, h in told)
    if plain:
        assert {f.path.endswith(".gz") for f in manifest.collect()} == {True, False}


def test_many_records_are_parsed_in_proportion(tmp_path):
    """A split full of small records: no candidate copies what follows it."""
    one = warc.record(1, "u", b"abc", None, __import__("hashlib").sha1(b"abc").hexdigest())
    path = tmp_path / "many.warc"
    seconds = []
    for n in (2_000, 8_000):
        path.write_bytes(one * n)
        began = time.process_time()
        assert sum(1 for _ in warc.candidates(str(path), n * len(one), 0, n * len(one))) == n
        seconds.append(time.process_time() - began)
    assert seconds[1] < 9 * seconds[0] + 0.2


def test_broken_chain_is_refused(spark, tmp_path):
    path = str(tmp_path / f"{uuid.uuid4().hex}.warc")
    good = warc.record(1, "u", b"abc", None, __import__("hashlib").sha1(b"abc").hexdigest())
    (tmp_path / path.rsplit("/", 1)[1]).write_bytes(good + b"junk" + good)
    manifest = spark.createDataFrame([(path, 2 * len(good) + 4)], "path string, size long")
    with pytest.raises(ValueError, match="chain"):
        warc.read_archives(manifest)


# Similarity.


def test_linked_sets_share_a_sent_cell():
    rng = random.Random(3)
    for trial in range(400):
        n = rng.choice([1, 2, 4, 5, 6, 9, 10, 25, 60, 200, 700])
        whole = [rng.getrandbits(64) for _ in range(2 * n + 4)]
        drop = rng.randint(0, n // 4)
        a, b = set(whole[:n]), set(whole[drop:n]) | set(whole[n : n + rng.randint(0, n // 8)])
        a, b = [np.sort(np.array(sorted(x), np.uint64)) for x in (a, b)]
        frequent = jaccard.Frequent(np.array(rng.sample(whole[:n], rng.randint(0, n)), np.uint64))
        h, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        keys, owner = jaccard.cell_keys(h, at, frequent)
        x, y = jaccard.sketches(h, at)
        if len(b) and jaccard.linked(a, b):
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (trial, n)
            assert jaccard.may_link(x, len(a), y, len(b))


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (9, 20), (7, 8), (8, 7), (6, 6)] + [(100 + k, 101 + k) for k in range(40)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {n: got[n] for n in (3, 4, 5, 9, 20)} == dict.fromkeys((3, 4, 5, 9, 20), 3)
    assert got[8] == got[7] == 7 and {got[100 + k] for k in range(41)} == {100}


@pytest.mark.parametrize("gather", [1000, 2])
def test_large_groups_go_block_by_block(spark, monkeypatch, gather):
    import brute

    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "GATHER", gather)
    monkeypatch.setattr(jaccard, "PARTNERS", 1)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(60)] = f"x{rng.randrange(30)}"
        docs.append((i, " ".join(own)))
    rows = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter(brute.components(docs)) == Counter(tuple(r) for r in rows)


# Repeats.


def test_a_crowded_key_stays_in_bounded_memory():
    """Keys up to the bound, each in a transform: the peak of a worker that solves them."""
    program = """
import os, resource
import pyarrow as pa
from tillstream.llm import repeats
size = 4295
def batches():
    for k in range(6):
        contents = [os.urandom(size - 300) + bytes(300) for _ in range(repeats.CROWD // size)]
        n = len(contents)
        yield pa.record_batch({"key": pa.array([k] * n), "row": pa.array(range(n)), "check": pa.array([0] * n, pa.int32()),
            "start": pa.array([0] * n), "settled": pa.array([False] * n), "content": pa.array(contents)})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows = sum(b.num_rows for b in repeats._expand(batches()))
assert rows == 6 * (repeats.CROWD // size), rows
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, cwd=root, check=True)
    assert int(out.stdout) < 200  # MB


@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 9))
def test_repeated_places(symbols, length):
    t = np.array(symbols, np.int64)
    words = [tuple(symbols[i : i + length]) for i in range(len(symbols) - length + 1)]
    count = Counter(words)
    want = [i < len(words) and count[words[i]] > 1 for i in range(len(symbols))]
    assert bwt.repeated_places(t, length).tolist() == want


@pytest.mark.parametrize("crowd", [3, 3000, 500_000])
def test_crowds_and_pieces(spark, monkeypatch, crowd):
    """A passage with very many surroundings, and a text longer than a piece."""
    import brute

    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "PIECE", 700)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(260)
    docs = [(i, noise(150) + passage + noise(150)) for i in range(12)] + [(20, noise(900) + passage + noise(3000))]
    docs += [(21, "ab" * 900), (22, None), (23, "z" * 2500)]
    rows = repeats.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string")).withColumn("sha", F.sha2("cut_text", 256))
    got = Counter((r.doc_id, r.cut_bytes, r.cut_removed, r.cut_spans, r.sha) for r in rows.collect())
    assert got == Counter(brute.cut(docs))


# Leaks.


def test_near_passages_are_found_and_others_left_alone(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([14, 20, 36, 60, 120])] + [(90, "short one"), (91, "")]
    prose = lambda n: " ".join(word() for _ in range(n))
    docs, want = [], set()
    for i, text in items[:5]:
        docs.append((len(docs), prose(50) + "\n" + text.upper() + ". " + prose(50)))
        want.add((docs[-1][0], i))
    changed = items[4][1].split()
    changed[60] = "changed"
    docs.append((len(docs), prose(9) + " " + " ".join(changed)))
    want.add((docs[-1][0], 4))
    half = items[3][1].split()[:30]
    docs += [(50, prose(20) + " " + " ".join(half) + " " + prose(30)), (51, prose(100)), (52, None), (53, "a short one here")]
    want.add((53, 90))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    out = decontam.flag_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, x.item_id) for r in out.collect() for x in r.leaks}
    assert got == want


def brute_leaks(docs, items):
    """{(doc_id, item_id): similarity} by all windows of texts without capitals or punctuation; items of 5 words or more."""
    cut = lambda t: [tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)]
    sets = {i: cut(t) for i, t in items}
    df = Counter(x for s in sets.values() for x in set(s))
    weigh = lambda xs: sum(round(1000 * (math.log((len(sets) + 1) / (df[x] + 1)) + 1)) for x in xs)
    out = {}
    for d, t in docs:
        own = cut(t)
        for i, s in sets.items():
            for a in range(len(own) - len(s) + 1):
                window = set(own[a : a + len(s)])
                if window & set(s):
                    value = weigh(window & set(s)) / weigh(window | set(s))
                    if value >= 0.8:
                        out[d, i] = max(value, out.get((d, i), 0))
    return out


def test_every_window_at_the_threshold_is_found():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, [word() for _ in range(rng.choice([6, 9, 14, 24, 40, 63, 104]))]) for i in range(70)]
    docs = []
    for i, own in items:
        for trial in range(6):
            new = list(own)
            for _ in range(trial % 3):
                new[rng.choice([0, 1, -1, -2, rng.randrange(len(new))])] = word()
            docs.append((10 * i + trial, [word() for _ in range(20)] + new[trial % 2 * rng.randint(0, 3) :] + [word() for _ in range(20)]))
    run = ["la"] * 12  # a run of one word is one shingle for the similarity, however long
    items.append((70, [word() for _ in range(30)] + run))
    docs.append((700, [word() for _ in range(9)] + items[70][1][:30] + ["lo"] * 12 + [word() for _ in range(9)]))
    items, docs = [(i, " ".join(t)) for i, t in items], [(d, " ".join(t)) for d, t in docs]
    want = brute_leaks(docs, items)
    assert sum(v < 0.9 for v in want.values()) > 50
    found = decontam.Index(*map(list, zip(*items, strict=True))).leaks(texts_of([t for _, t in docs]))
    got = {(d, r["item_id"]): r["similarity"] for (d, _), rows in zip(docs, found, strict=True) for r in rows}
    assert got == pytest.approx(want)


def test_shortened_items_leak(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate([12, 40, 40, 100])]
    docs = [(0, items[0][1][:-1]), (1, items[1][1][:-1]), (2, items[2][1][3:]), (3, items[3][1][:80]), (4, items[3][1][:90] + [word()])]
    docs += [(10, items[1][1][:20]), (11, items[3][1][:70]), (12, items[3][1][50:] + [word() for _ in range(40)])]
    frame = lambda rows, ddl: spark.createDataFrame([(i, " ".join(t)) for i, t in rows], ddl)
    out = decontam.flag_leaks(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    # All shingles are of one item, so those of an item weigh alike, and a little less than unknown ones.
    want = {(0, 0): 7 / 8, (1, 1): 35 / 36, (2, 2): 33 / 36}
    got = {(r.doc_id, x.item_id): x for r in out for x in r.leaks}
    assert {k: x.similarity for k, x in got.items() if k in want} == pytest.approx(want)
    assert set(got) == {*want, (4, 3)}
    assert (got[1, 1]["from"], got[1, 1].to) == (0, len(" ".join(docs[1][1])))


def test_several_passes_find_the_same(spark, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    flat = lambda: sorted((r.doc_id, x.item_id) for r in decontam.flag_leaks(docs, items).collect() for x in r.leaks)
    one = flat()
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 15)
    assert one and flat() == one


def test_several_passes_weigh_the_same(spark, monkeypatch):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared = [word() for _ in range(12)]
    items = [(i, [word() for _ in range(20)] + shared * (i % 2) + [word() for _ in range(20)]) for i in range(40)]
    items += [(100 + i, [word() for _ in range(i % 6)]) for i in range(12)]
    docs = [(i, [word()] * 3 + t[:-2] + [word() for _ in range(8)]) for i, t in items]
    # An item's window that runs on into the words of another item.
    docs += [(1000 + i, [word() for _ in range(9)] + t[:-2] + shared[:6] + [word()]) for i, t in items[:40]]
    frame = lambda rows, ddl: spark.createDataFrame([(i, " ".join(t)) for i, t in rows], ddl).withColumn("weights_0", F.lit(1))
    docs, items = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    flat = lambda: sorted((r.doc_id, *x) for r in decontam.flag_leaks(docs, items).collect() for x in r.leaks)
    one = flat()
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 9)
    monkeypatch.setattr(decontam, "KNOWN_BLOCK", 700)
    assert len(one) > 40 and flat() == one
    assert decontam.flag_leaks(docs, items).columns == [*docs.columns, "leaks"]


def test_fingerprints_in_the_radius_are_found():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 256, (300, 32), dtype=np.uint8)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    weight = rng.integers(1, 9, 5000)
    parts = list(decontam._window_prints(h, weight, 30, 4900, 100))
    assert [a for a, _ in parts] == list(range(30, 4901, decontam.STRETCH))
    own = np.concatenate([x for _, x in parts])
    plain = [decontam._fingerprints(decontam._signs(h[b : b + 100], weight[b : b + 100]).sum(axis=0)[None, :])[0] for b in range(30, 4901)]
    assert np.array_equal(own, np.array(plain))
    own = own[::17]
    for k in range(60):  # near ones, up to and beyond the radius
        prints[k] = own[k]
        for bit in rng.choice(256, 34 + k, replace=False):
            prints[k, bit // 8] ^= 1 << bit % 8
    apart = np.bitwise_count(own[:, None, :] ^ prints[None, :, :]).sum(axis=2)
    for radius in (decontam.RADIUS, decontam.RADIUS_OF_FEW):
        want = set(zip(*map(lambda x: x.tolist(), np.nonzero(apart <= radius)), strict=True))
        assert len(want) >= 30
        found = list(decontam.Index._near(own, prints, radius))
        assert set(found) == want and len(found) == len(want)


@given(st.lists(st.integers(0, 60), unique=True).map(sorted), st.integers(1, 12), st.integers(1, 60))
def test_stretches_are_all_windows_with_enough_hits(hits, m, split):
    """Two texts, cut at `split`."""
    hits = np.array(hits, np.int64)
    lows, highs = np.where(hits < split, 0, split), np.where(hits < split, split, 61)
    need = -(-80 * m // 100)
    want = [
        b
        for low, high in ((0, split), (split, 61))
        for b in range(low, high - m + 1)
        if ((hits >= b) & (hits < b + m)).sum() >= need
    ]
    first, last = decontam._stretches(hits, need, m, lows, highs)
    assert [b for x, y in zip(first, last, strict=True) for b in range(x, y + 1)] == want


@pytest.mark.parametrize("size", [10, 12, 15, 18, 24, 36, 59, 100, 200, 600, 2000])
def test_fingerprints_alone_find_similar_windows(size):
    """Recall at similarities from 0.8 on, without the anchors."""
    rng = random.Random(size)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(7))
    n = 60 if size > 500 else 150
    items = [(i, [word() for _ in range(size + 4)]) for i in range(n)]
    docs = []
    for _, own in items:
        new = list(own)
        # A changed word costs up to five shingles, at an end one to four.
        for _ in range(rng.randint(1, max(1, size // 45))):
            new[rng.randrange(len(new)) if size > 50 else rng.choice([0, -1])] = word()
        docs.append(" ".join([word() for _ in range(9)] + new + [word() for _ in range(9)]))
    index = decontam.Index([i for i, _ in items], [" ".join(t) for _, t in items])
    found = index.leaks(texts_of(docs))
    rows = [r for x in found for r in x]
    assert len(rows) >= n / 3 and all(r["similarity"] >= 0.8 for r in rows)
    assert min(r["similarity"] for r in rows) < 0.95
    assert sum(r["found_by"] == "fingerprint" for r in rows) >= 0.95 * len(rows)


def test_a_long_item_takes_memory_by_its_length():
    program = """
import random, resource
import pyarrow as pa
from tillstream.llm import decontam
from tillstream.llm.textblock import Texts
rng = random.Random(1)
word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
item = [word() for _ in range(20_000)]
index = decontam.Index([1], [" ".join(item)])
text = " ".join([word() for _ in range(500)] + item[:9000] + ["other"] + item[9001:] + [word() for _ in range(500)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = index.leaks(Texts.of(pa.array([text])))
assert [r["item_id"] for r in found[0]] == [1] and found[0][0]["found_by"] == "fingerprint", found
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, cwd=root, check=True)
    assert int(out.stdout) < 150  # MB


# Shards, quality, chat.


@pytest.mark.parametrize("shards_", [2, 5, 16])
def test_each_cut_is_the_weighted_median_of_the_widest_dimension(spark, shards_):
    """Nodes are rebuilt from the shards and held against plain sums over their rows."""
    rng = random.Random(shards_)
    rows = []
    for i in range(900):
        site = f"s{min(rng.randrange(30), rng.randrange(30)):02}" if i % 50 else None
        rows.append((i, "x" * rng.choice([1, 5, 40, 400]), rng.choice(["de", "en", "fr"]), site, rng.randrange(10_000)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    placed = {r.doc_id: r.shard for r in shards.kd_shards(docs, shards=shards_).collect()}

    def coordinates(values):
        known = sorted({v for v in values if v is not None})
        if isinstance(known[0], str):
            place = {v: k / max(len(known) - 1, 1) for k, v in enumerate(known)}
            return [-1e-9 if v is None else place[v] for v in values]
        lo, hi = known[0], known[-1]
        return [-1e-9 if v is None else (v - lo) / (hi - lo) for v in values]

    names = {"n_chars": 4, "lang": 2, "source": 3}
    dims = [coordinates([r[names[d]] for r in rows]) for d in shards.DIMENSIONS]

    def check(own, first, n):
        if n == 1:
            assert {placed[i] for i in own} == {first}
            return
        low = [i for i in own if placed[i] < first + n // 2]
        high = [i for i in own if placed[i] >= first + n // 2]
        widest = max(dims, key=lambda d: max(d[i] for i in own) - min(d[i] for i in own))
        assert max(widest[i] for i in low) <= min(widest[i] for i in high)
        size = lambda some: sum(len(rows[i][1]) + 1 for i in some)
        assert abs(size(low) - size(own) * (n // 2) / n) <= 401 / 2 + shards.CLOSE * size(own) + 1
        check(low, first, n // 2)
        check(high, first + n // 2, n - n // 2)

    check(list(range(900)), 0, shards_)


def test_no_documents_give_no_shards(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert shards.kd_shards(docs, shards=4).count() == 0


@pytest.mark.parametrize("hot", [1000, 3])
def test_shards_split_on_whole_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(shards, "HOT", hot)
    rng = random.Random(16)
    rows = [(i, "x" * 20, "en", f"https://site/{rng.randrange(40):03}", 20) for i in range(600)]
    rows += [(1000 + i, "x" * 20, "en", "https://site/039" if i % 4 else None, 20) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    placed = shards.kd_shards(docs, shards=4).collect()
    source = {r[0]: r[3] or "" for r in rows}
    assert sorted(r.doc_id for r in placed) == sorted(source)
    own = [sorted(source[r.doc_id] for r in placed if r.shard == k) for k in range(4)]
    assert all(a[-1] <= b[0] for a, b in zip(own, own[1:], strict=False))  # each shard is a range of sources


@pytest.mark.parametrize("n", [1, 3, 5])
def test_shards_of_hot_values(spark, n):
    rows = [(i, "x" * (i % 50), "en", "hot" if i % 3 else f"s{i}", None) for i in range(600)] + [(7, "same", "en", "hot", None)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = Counter()
    for r in shards.kd_shards(docs, shards=n).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == n and max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values())
    by_bytes = shards.kd_shards(docs, target_bytes=sum(sizes.values()) // 4 + 1)
    assert by_bytes.select("shard").distinct().count() == 4


def test_quality_parts_junk_from_trusted(spark):
    rng = random.Random(6)
    # Few repeated runs of three words: a long text of few words would fail the base.
    say = lambda words: " ".join(rng.choice(words) for _ in range(60))
    good, junk = lambda: say([f"river{k}" for k in range(12)]), lambda: say([f"click{k}" for k in range(12)])
    docs = [(i, good()) for i in range(400)] + [(1000 + i, junk()) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bucket", F.lit(1)).withColumn("kept", F.lit(2))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.rate(frame, labels).collect()
    right = [r.rated.kept == (r.doc_id < 1000) for r in rows if r.doc_id % 2]
    assert sum(right) >= 0.95 * len(right)
    nobody = quality.rate(frame, labels.limit(0)).collect()
    assert all(r.rated.kept for r in nobody)


@given(st.text(alphabet="\\<|>turnsayed/[INST]é", max_size=30))
@settings(max_examples=15)
def test_escapes_are_reversible(spark, text):
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e")).select("e", chat.unescape(F.col("e")).alias("u")).first()
    assert row.u == text and not any(mark in row.e for mark in chat.CONTROL)


def test_examples_show_what_came_before(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (1, 4, "assistant", "b"), (1, 5, "user", "w")]
    rows = chat.prefix_examples(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).orderBy("example").collect()
    assert [r.formatted[r.loss_start : r.loss_end] for r in rows] == ["a", "b", ""]
    assert [r.last for r in rows] == [False, False, True]
    assert rows[1].formatted.startswith(rows[0].formatted) and rows[2].formatted.startswith(rows[1].formatted)


def test_blocks_cut_batches():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 25, "c", ""], "n": [1, 2, 3, 4, 5]})
    got = [(b["n"].to_pylist(), len(t.data)) for b, t in blocks([batch], "text", 12)]
    assert [n for ns, _ in got for n in ns] == [1, 2, 3, 4, 5] and max(len(ns) for ns, _ in got) < 5
    assert list(blocks([batch.slice(0, 0)], "text")) == []
