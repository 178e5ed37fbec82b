"""Conversation repair against plain statements of its result."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

from given import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import queries, repair

DDL = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def cheapest(turns):
    """(cost, audit, repaired) of turns (initial, must go, truncated, role, text) by a plain
    recursion over what may come next, letter by letter."""
    n = len(turns)

    @lru_cache(None)
    def best(i, told):
        # told: the last initial, or "" at the start.
        found = []
        follows = "u" if told in ("", "s", "a") else "a"
        if i == n and told in ("", "a"):
            found.append((0, ""))
        if inserts[0] < 3:
            inserts[0] += 1
            c, a = best_after_insert(i, follows)
            found.append((c + 2, "I" + a))
            inserts[0] -= 1
        if i < n:
            initial, gone, cut, _, _ = turns[i]
            c, a = best(i + 1, told)
            found.append((c + 3, "D" + a))
            if not gone:
                if initial == follows or (initial == "s" and told == ""):
                    c, a = best(i + 1, initial)
                    found.append((c + cut, "K" + a))
                c, a = best(i + 1, follows)
                found.append((c + 2 + cut, "R" + a))
        return min(found)

    inserts = [0]

    def best_after_insert(i, told):
        # Bounded: more than three inserts in a row never pay.
        follows = "u" if told in ("s", "a") else "a"
        found = []
        if i == n and told == "a":
            found.append((0, ""))
        if inserts[0] < 3:
            inserts[0] += 1
            c, a = best_after_insert(i, follows)
            found.append((c + 2, "I" + a))
            inserts[0] -= 1
        if i < n:
            initial, gone, cut, _, _ = turns[i]
            held, inserts[0] = inserts[0], 0
            c, a = best(i + 1, told)
            found.append((c + 3, "D" + a))
            if not gone:
                if initial == follows:
                    c, a = best(i + 1, initial)
                    found.append((c + cut, "K" + a))
                c, a = best(i + 1, follows)
                found.append((c + 2 + cut, "R" + a))
            inserts[0] = held
        return min(found, default=(10**9, ""))

    cost, audit = best(0, "")
    told, last, i = [], "", 0
    for letter in audit:
        follows = "u" if last in ("", "s", "a") else "a"
        if letter == "I":
            told.append(({"u": "user", "a": "assistant"}[follows], ""))
            last = follows
            continue
        initial, _, _, role, text = turns[i]
        i += 1
        if letter == "K":
            told.append((role, text))
            last = initial
        if letter == "R":
            told.append(({"u": "user", "a": "assistant"}[follows], text))
            last = follows
    assert GRAMMAR.fullmatch("".join(r[0] for r, _ in told))
    return cost, audit, told


def report(rows):
    """conv_id -> the columns of op12, of rows (conv_id, turn, role, text) after damage."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
        seen, marked, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marked.append((role[:1], fault in (0, 1), int(fault == 2), role, text))
        initials = [m[0] for m in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        known = {t for t, _, _ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        cost, audit, told = cheapest(marked)
        lines = "\n".join(f"{r}:{t}" for r, t in told)
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def want(rows):
    found = report(damaged(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {c: found.get(c, nothing) for c in {r[0] for r in rows}}


def got(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_op12_over_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.queries()["op12_run_length_repair"](spark, SMALL)) == want(rows)


def test_op12_on_nasty_rows(spark, make):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "tool", "", None, "unknown", "s"]
    texts = ["ok.", "no end", "", " \t\n", None, "Really?", "why! \n", "é", "ok.", "x" * 10_000]
    rows = []
    for c in [None, 0, -3, *range(100, 160)]:
        for _ in range(rng.randint(1, 9)):
            turn = rng.choice([None, rng.randint(-2, 12), rng.randint(0, 10**12)])
            rows += [(c, turn, rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 2, 3])
    ddl = DDL + ", piece string, place string, text_ string, digest string"
    wide = [(*r, "a", "b", "c", "d") for r in rows]
    query = queries.queries()["op12_run_length_repair"]
    assert got(query(spark, make(conversations=(wide, ddl)))) == want(rows)
    assert query(spark, make(conversations=([], ddl))).count() == 0


@settings(max_examples=200)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.integers(0, 1)), max_size=7))
def test_runs_give_the_cheapest_and_first_audit(turns):
    marked = [(r, gone, 0 if gone else cut, r, "") for r, gone, cut in turns]
    symbols = ["suat".index(r) * 4 + (repair.AGAIN if gone else cut) for r, gone, cut, _, _ in marked]
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1] = (s, runs[-1][1] + 1)
        else:
            runs.append((s, 1))
    letters, told, q = repair.unroll(runs, repair.START, repair.END)
    letters += repair.closing(q)[0]
    cost, audit, _ = cheapest(marked)
    assert letters == audit
    import numpy as np

    matrix = np.frombuffer(repair.piece_matrix(runs), np.int64).reshape(4, 4)
    assert repair._apply(matrix, repair.END)[repair.START] == cost


def test_long_runs_equal_turn_by_turn():
    for symbol in range(16):
        for n in (1, 2, 3, 255, 1000, 5000):
            whole = repair.unroll([(symbol, n)], repair.START, repair.END)
            vectors = [repair.END]
            for _ in range(n - 1):
                vectors.append(repair._before(symbol, vectors[-1]))
            q, letters, told = repair.START, "", ""
            for after in reversed(vectors):
                a, b, q = repair._one(symbol, q, after)
                letters, told = letters + a, told + b
            assert whole == (letters, told, q)


def test_pieces_of_a_long_conversation_join(spark, monkeypatch):
    """One conversation over many tasks and pieces equals the same turns worked on whole."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "user", "assistant", "system"]), rng.choice(["a.", "b", f"t{i}."])) for i in range(3000)]
    rows += [(2, 5, "user", "same.")] * 700 + [(3, i, "user", f"{i}.") for i in range(400)]
    df = spark.createDataFrame(rows, DDL).repartition(4)
    edits, found = repair.repair_conversations(df)
    pieces = edits.where("conv_id = 1").select("piece").distinct().count()
    assert pieces > 1
    one = spark.createDataFrame(rows, DDL).coalesce(1)
    monkeypatch.setattr(repair, "shuffle_parts", lambda _: 1)
    same_edits, same = repair.repair_conversations(one)
    names = found.columns
    assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, same.select(names).collect()))
    digest = lambda e: sorted(map(tuple, repair.repaired_digests(e).collect()))
    assert digest(edits) == digest(same_edits)
    by = {r.conv_id: r for r in found.collect()}
    assert by[2].duplicate == 699 and by[2].audit.count("D") == 699
