"""The prefix trie against a plain statement of its nodes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from given import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import queries, trie

DDL = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((turn is not None, turn or 0, role[:16], sha(f"{len(role)}:{role}{text}")), (role, text)))
    return {c: tuple(t for _, t in sorted(turns, key=lambda x: x[0])) for c, turns in by.items()}


def rebuilt(told):
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = told.get(c - c % 100, ())[:h] + turns[h:]
    return out


def nodes(told):
    """Rows of NAMES for conv_id -> turns."""
    members = defaultdict(list)
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children.get(p)
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, ())), leaves[p], saved[p],
            sha(",".join(map(str, sorted(c for c in m if len(told[c]) == len(p))))),
        )
        for p, m in members.items()
    )


def got(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def key(row):
    return tuple((x is not None, x) for x in row)


def test_op11_over_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = nodes(rebuilt(ordered(rows)))
    assert got(queries.queries()["op11_neighbour_trie"](spark, SMALL)) == want


def nasty(seed=3):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(1000, 1260), 5000, -3, -100]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 9])):
            rows.append((c, rng.choice([t, t, None, t * 10**9]), rng.choice(["user", None, "a" * 30]), rng.choice(["x", "é🙂", "", None, "y" * 3000])))
    rows += rows[:5] + [(None, 1, "user", "no id"), (None, None, None, None)]
    for c in range(2000, 2100):  # a group of copies, and one that shares all but the end
        rows += [(c, t, "user", f"common {t}") for t in range(8)] + ([(c, 9, "user", str(c))] if c % 2 else [])
    return rows


def test_op11_on_nasty_rows(spark, make):
    rows = nasty()
    ddl = DDL + ", part long, name string, ends_sha256 string, key string"
    folder = make(conversations=([(*r, 1, "a", "b", "c") for r in rows], ddl))
    assert got(queries.queries()["op11_neighbour_trie"](spark, folder)) == nodes(rebuilt(ordered(rows)))
    assert queries.queries()["op11_neighbour_trie"](spark, make(conversations=([], ddl))).count() == 0


def test_forests_of_many_partitions_are_merged(spark, monkeypatch):
    monkeypatch.setattr(trie, "PARTITION_TURNS", 40)
    rows = nasty(8)
    found = trie.prefix_trie(trie.turn_sequences(spark.createDataFrame(rows, DDL).repartition(3)))
    assert got(found) == nodes(ordered(rows))


def test_turnless_sequences_belong_to_the_root(spark):
    made = spark.createDataFrame([(1, []), (2, []), (3, [(b"a" * 16, 5)])], "conv_id long, turns array<struct<digest binary, size int>>")
    found = {r.depth: r for r in trie.prefix_trie(made).collect()}
    assert (found[0].n_convs, found[0].n_children, found[0].ends_sha256) == (3, 1, sha("1,2"))
    assert (found[1].conv_id, found[1].parent_conv_id, found[1].saved_tokens) == (3, 1, 0)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.lists(st.integers(0, 2), max_size=5).map(tuple), min_size=1, max_size=14), st.data())
def test_any_cut_into_partitions_gives_the_same_nodes(sequences, data):
    """Forests cut anywhere, open nodes added up, against one node a prefix."""
    told = sorted(sequences)
    text = lambda t: "z" * (t + 1)
    turn = lambda t: hashlib.blake2b(bytes([t]), digest_size=16).digest()
    rows = sorted(
        (b"".join(map(turn, s)), [t + 1 for t in s], data.draw(st.integers(1, 3)), 10 * i, sha(str(i))) for i, s in enumerate(told)
    )
    cuts = sorted(data.draw(st.sets(st.integers(0, len(rows)), max_size=4)) | {0, len(rows)})
    parts = [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
    found = []
    for k, part in enumerate(parts):
        left = trie.common(parts[k - 1][-1][0], part[0][0]) if k else -1
        right = trie.common(part[-1][0], parts[k + 1][0][0]) if k + 1 < len(parts) else -1
        found += trie.Forest(part, left, right).rows()
    opened = {}
    for row in found:
        if row[1] is not None:
            old = opened.get(row[1])
            new = list(row)
            if old:
                new[3] = min(new[3], old[3])
                new[5:9] = [a + b for a, b in zip(new[5:9], old[5:9], strict=True)]
                new[9] = new[9] or old[9]
            opened[row[1]] = new
    flat = [list(r) for r in found if r[1] is None] + list(opened.values())
    for row in flat:
        if row[2] is not None:
            row[4] = opened[row[2]][3]
    number = {r[0]: r for r in rows}
    members = defaultdict(list)
    for key_, _, n, c, _ in rows:
        for d in range(len(key_) // 16 + 1):
            members[key_[: 16 * d]].append((c, n))
    size = {p: number[next(k for k in number if k.startswith(p))][1][len(p) // 16 - 1] if p else 0 for p in members}
    want = []
    for p, m in members.items():
        below = [q for q in members if q.startswith(p)]
        kids = [q for q in below if len(q) == len(p) + 16]
        want.append(
            [
                len(p) // 16, min(m)[0], min(members[p[:-16]])[0] if p else None, sum(n for _, n in m), len(kids),
                sum(not any(r.startswith(q) and r != q for r in members) for q in below),
                sum((sum(n for _, n in members[q]) - 1) * size[q] for q in below),
                number[p][4] if p in number else None,
            ]
        )
    short = [[r[0], r[3], r[4], *r[5:]] for r in flat]
    assert sorted(short, key=key) == sorted(want, key=key)
