"""Repair of conversations whose turns are damaged, by the cheapest edits.

A turn is a symbol: the initial of its role and its fault.  What an edit of a turn costs
depends on the symbol and on what was told before it (a state), so a turn is a matrix over
states in which costs add and the least counts.  Equal turns in a row are one run, whose
matrix is a product of cached binary powers.  Conversations are cut into pieces, so that a
long one is worked on by many tasks; only the pieces' matrices meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.store import ship_code, shuffle_parts, written

# What edits cost.  Kept and reroled turns that are truncated cost one more.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 3, 2, 0, 2, 1
FINE, CUT, AGAIN, BLANK = range(4)  # faults; the last two have to be deleted
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # initials of roles
# States: nothing told, or the last turn is the system's, the user's, the assistant's.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWS = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # state after the only role that may come next
NEVER = 1 << 40
PIECE = 65_536  # turns of a conversation in one piece
SPACES = " \t\n\x0b\f\r"
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

Vector = tuple[int, ...]  # cheapest way to the end from each state


def _closed(base: list[int]) -> list[int]:
    """With turns inserted before what base costs; two bring any state to any that can follow."""
    out = list(base)
    for _ in range(2):
        out = [min(out[q], INSERT + out[FOLLOWS[q]]) for q in range(4)]
    return out


END: Vector = tuple(_closed([0, NEVER, NEVER, 0]))  # nothing, or an answer, may be the end


def _edits(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a turn in state q, but inserts."""
    role, fault = divmod(symbol, 4)
    out = [("D", DELETE, q)]
    if fault >= AGAIN:
        return out
    more = TRUNCATED if fault == CUT else 0
    if role == SYSTEM and q == START:
        out.append(("K", KEEP + more, AFTER_S))
    elif role in (USER, ASSISTANT) and FOLLOWS[q] == role + 1:
        out.append(("K", KEEP + more, FOLLOWS[q]))
    out.append(("R", REROLE + more, FOLLOWS[q]))
    return out


def _before(symbol: int, after: Vector) -> Vector:
    """The vector before one turn."""
    return tuple(_closed([min(c + after[n] for _, c, n in _edits(symbol, q)) for q in range(4)]))


@lru_cache(maxsize=2048)
def power(symbol: int, k: int) -> np.ndarray:
    """The matrix of 2**k equal turns."""
    if k == 0:
        columns = [_before(symbol, tuple(0 if q == n else NEVER for q in range(4))) for n in range(4)]
        return np.minimum(np.array(columns, np.int64).T, NEVER)
    half = power(symbol, k - 1)
    return times(half, half)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def _apply(matrix: np.ndarray, after: Vector) -> Vector:
    return tuple(np.minimum((matrix + np.array(after, np.int64)).min(axis=1), NEVER).tolist())


@lru_cache(maxsize=16_384)
def run_matrix(symbol: int, n: int) -> np.ndarray:
    """The matrix of n equal turns, from the binary powers."""
    out = None
    for k in range(n.bit_length()):
        if n >> k & 1:
            out = power(symbol, k) if out is None else times(out, power(symbol, k))
    return out


@lru_cache(maxsize=16_384)
def _joined(left: bytes, symbol: int, n: int) -> bytes:
    return times(np.frombuffer(left, np.int64).reshape(4, 4), run_matrix(symbol, n)).tobytes()


def piece_matrix(runs: list[tuple[int, int]]) -> bytes:
    out = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64).tobytes()
    for symbol, n in runs:
        out = _joined(out, symbol, n)
    return out


def _one(symbol: int, q: int, after: Vector) -> tuple[str, str, int]:
    """Letters and roles told for one turn, inserts before it included, and the state behind it.

    Of the cheapest ways the one whose letters come first in ASCII: at each letter all ways
    from a state are compared by that letter, as it alone says the next state.
    """
    base = [min(c + after[n] for _, c, n in _edits(symbol, p)) for p in range(4)]
    best = _closed(base)
    letters = told = ""
    while True:
        found = [(letter, n) for letter, c, n in _edits(symbol, q) if c + after[n] == best[q]]
        if INSERT + best[FOLLOWS[q]] == best[q]:
            found.append(("I", FOLLOWS[q]))
        letter, n = min(found)
        letters += letter
        told += "-" if letter == "D" else "k" if letter == "K" else "ua"[n - AFTER_U]
        q = n
        if letter != "I":
            return letters, told, q


def _block(symbol: int, k: int, q: int, after: Vector) -> tuple[str, str, int]:
    """As _one, of 2**k equal turns: its halves, with the vector between them by a power."""
    if k == 0:
        return _one(symbol, q, after)
    half = _short if k <= 9 else _block
    between = _level(_apply(power(symbol, k - 1), after))
    a, x, q = half(symbol, k - 1, q, between)
    b, y, q = half(symbol, k - 1, q, after)
    return a + b, x + y, q


_short = lru_cache(maxsize=16_384)(_block)  # blocks of up to 256 turns: few kilobytes each


def _level(vector: Vector) -> Vector:
    """Less its least entry: the choices stay the same, and few different vectors are left."""
    least = min(vector)
    return tuple(min(v - least, NEVER) for v in vector)


def unroll(runs: list[tuple[int, int]], q: int, after: Vector) -> tuple[str, str, int]:
    """Letters and roles told of a piece that is entered in state q and followed by after."""
    parts = [(s, k) for s, n in runs for k in reversed(range(n.bit_length())) if n >> k & 1]
    vectors = []
    vector = _level(after)
    for symbol, k in reversed(parts):
        vectors.append(vector)
        vector = _level(_apply(power(symbol, k), vector))
    letters, told = [], []
    for (symbol, k), vector in zip(parts, reversed(vectors), strict=True):
        a, x, q = (_short if k <= 8 else _block)(symbol, k, q, vector)
        letters.append(a)
        told.append(x)
    return "".join(letters), "".join(told), q


def closing(q: int) -> tuple[str, str]:
    """Inserts behind the last turn."""
    letters = told = ""
    while q not in (START, AFTER_A):
        letters, told, q = letters + "I", told + "ua"[FOLLOWS[q] - AFTER_U], FOLLOWS[q]
    return letters, told


# Spark: turns to pieces, pieces to vectors, vectors to edits.

ROWS = "piece long, i int, conv_id long, turn long, role string, text string, symbol int, copies long"
RUNS = "conv_id long, piece long, symbols array<int>, sizes array<long>, many array<long>, n int, matrix binary"
SUFFIX = RUNS.replace("matrix binary", "after array<long>, cost long, last boolean")
UNROLLED = (
    "conv_id long, piece long, cost long, letters string, told string, many array<long>, n int, "
    "blank long, again long, cut long, illegal long"
)
EDITS = "conv_id long, piece long, place int, edit string, told string, i int"


def _digest() -> Column:
    """Of role and text, apart."""
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.unhex(F.sha2(both, 256))


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns with their piece and place in it.  A piece begins at a row of the task,
    whose number names it, so pieces of a conversation ascend in the order of its turns."""
    task = TaskContext.get().partitionId() << 33
    row, last, at = 0, None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        known = batch["conv_id"].is_valid().to_numpy(zero_copy_only=False)
        conv = batch["conv_id"].fill_null(0).to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (conv[1:] != conv[:-1]) | (known[1:] != known[:-1])
        new[0] = last != (conv[0], known[0])
        rows = np.arange(row, row + n)
        begin = np.maximum.accumulate(np.where(new, rows, 0))
        inside = np.where(np.cumsum(new) > 0, rows - begin, rows - row + at)
        i = inside % PIECE
        yield pa.RecordBatch.from_arrays(
            [pa.array(task + rows - i), pa.array(i.astype(np.int32)), *batch.columns], names=["piece", "i", *batch.schema.names]
        )
        row, last, at = row + n, (conv[-1], known[-1]), int(inside[-1]) + 1


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {name: [] for name in ("symbols", "sizes", "many", "n", "matrix")}
        for turns in batch["turns"].to_pylist():
            runs: list[list[int]] = []

            def add(symbol: int, n: int, runs=runs) -> None:
                if runs and runs[-1][0] == symbol:
                    runs[-1][1] += n
                else:
                    runs.append([symbol, n])

            many = []
            for t in turns:
                symbol, copies = t["symbol"], t["copies"]
                add(symbol, 1)
                if copies > 1:
                    add(symbol // 4 * 4 + max(symbol % 4, AGAIN), copies - 1)
                    many += [t["i"], copies]
            out["symbols"].append([s for s, _ in runs])
            out["sizes"].append([n for _, n in runs])
            out["many"].append(many)
            out["n"].append(len(turns))
            out["matrix"].append(piece_matrix([(s, n) for s, n in runs]))
        yield _record(batch, out, RUNS)


def _record(batch: pa.RecordBatch, out: dict[str, list], ddl: str) -> pa.RecordBatch:
    """Columns of the batch that ddl names, and those of out."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    told = [x.split(" ") for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(out[n], kinds[k]) if n in out else batch[n] for n, k in told], names=[n for n, _ in told]
    )


def _suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from the last to the first of each conversation: the vector behind each."""
    conv, vector, first = None, END, True
    for batch in batches:
        out = {"after": [], "cost": [], "last": []}
        for c, matrix in zip(batch["conv_id"].to_pylist(), batch["matrix"].to_pylist(), strict=True):
            last = first or c != conv
            if last:
                conv, vector, first = c, END, False
            out["last"].append(last)
            out["after"].append(vector)
            vector = _apply(np.frombuffer(matrix, np.int64).reshape(4, 4), vector)
            out["cost"].append(vector[START])
        yield _record(batch, out, SUFFIX)


def _unrolled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces from the first to the last of each conversation: what is done to each turn."""
    conv, q, last, first = None, START, None, True
    for batch in batches:
        out = {n: [] for n in ("letters", "told", "blank", "again", "cut", "illegal")}
        columns = (batch[n].to_pylist() for n in ("conv_id", "symbols", "sizes", "after", "last"))
        for c, symbols, sizes, after, ends in zip(*columns, strict=True):
            if first or c != conv:
                conv, q, last, first = c, START, None, False
            runs = list(zip(symbols, sizes, strict=True))
            letters, told, q = unroll(runs, q, tuple(after))
            illegal, faults = 0, [0, 0, 0, 0]
            for symbol, n in runs:
                role, fault = divmod(symbol, 4)
                illegal += n - 1 + (last is not None and (last, role) not in LEGAL)
                faults[fault] += n
                last = role
            if ends:
                more, roles = closing(q)
                letters, told = letters + more, told + roles
            for name, value in zip(out, (letters, told, faults[BLANK], faults[AGAIN], faults[CUT], illegal), strict=True):
                out[name].append(value)
        yield _record(batch, out, UNROLLED)


def _edit_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a letter; i is the turn it belongs to, null for inserts."""
    for batch in batches:
        columns = (batch[n].to_pylist() for n in ("conv_id", "piece", "letters", "told", "many", "n"))
        for c, piece, letters, told, many, n in zip(*columns, strict=True):
            copies = np.ones(n, np.int64)
            copies[np.array(many[::2], np.int64)] = many[1::2]
            size = len(letters)
            marks = np.frombuffer(letters.encode(), np.uint8)
            inserted = marks == ord("I")
            element = np.cumsum(~inserted) - 1
            turn = np.repeat(np.arange(n), copies)
            i = np.where(inserted, 0, turn[np.maximum(element, 0)] if n else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c] * size, pa.int64()),
                    pa.array([piece] * size, pa.int64()),
                    pa.array(np.arange(size, dtype=np.int32)),
                    pa.array(list(letters), pa.string()),
                    pa.array(list(told), pa.string()),
                    pa.array(i.astype(np.int32), mask=inserted),
                ],
                names=["conv_id", "piece", "place", "edit", "told", "i"],
            )


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns, one digest a conversation; only the running digest is held."""
    conv, digest = None, None

    def row(c: int | None, d) -> pa.RecordBatch:
        return pa.record_batch({"conv_id": pa.array([c], pa.int64()), "sha256": pa.array([d.hexdigest()])})

    for batch in batches:
        for c, role, text in zip(*(batch[n].to_pylist() for n in ("conv_id", "role", "text")), strict=True):
            if digest is None or c != conv:
                if digest is not None:
                    yield row(conv, digest)
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield row(conv, digest)


def repaired_digests(edits: DataFrame) -> DataFrame:
    """conv_id, sha256 of the repaired turns as `role:text` lines, of those that have any.

    A conversation's digest is taken in order, so its turns go through one task, as a stream.
    """
    ship_code(edits.sparkSession)
    left = edits.where("edit <> 'D'").repartition(shuffle_parts(edits.sparkSession), "conv_id")
    return left.sortWithinPartitions("conv_id", "piece", "place").select("conv_id", "role", "text").mapInArrow(
        _hashed, "conv_id long, sha256 string"
    )


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What has to be done to conversations (conv_id, turn, role, text), and a report.

    Edits, one row each: conv_id, piece and place (their order), edit (Keep, Rerole, Delete,
    Insert by initial), role and text (of the repaired turn; of the turn as it was if it
    is deleted).  Edits are the cheapest that make the roles' initials `(s?(ua)+)?`, and the
    first by their letters among those.  Report, one row a conversation that has turns:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Turns are sorted by turn, nulls first, then role and a digest of the text.  Equal rows
    are copies: one turn and its duplicates.  A null role or text is empty, a null conv_id
    is one conversation, other columns are ignored, and an empty table has no edit and no
    report.  The audit of a conversation is one string, a letter a turn.
    """
    ship_code(conversations.sparkSession)
    parts = shuffle_parts(conversations.sparkSession)
    told = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = told.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    turns = turns.withColumn("digest", _digest())
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = turns.groupBy("conv_id", "digest").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("times"))
    firsts = firsts.where("times > 1").select(
        F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn"), F.lit(True).alias("_again")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    body = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = (
        F.when(body == "", BLANK)
        .when(F.col("_again") & ~F.col("turn").eqNullSafe(F.col("_turn")), AGAIN)
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), CUT)
        .otherwise(FINE)
    )
    marked = turns.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", (role * 4 + fault).cast("int").alias("symbol"), "copies", "digest"
    )
    order = ["conv_id", "turn", "role", "digest"]
    sorted_turns = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("digest")
    rows = written(sorted_turns.mapInArrow(_numbered, ROWS), "turns")

    turn = F.struct("i", "symbol", "copies")
    pieces = rows.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    runs = pieces.mapInArrow(_runs, RUNS)
    behind = runs.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("piece")).mapInArrow(_suffixes, SUFFIX)
    unrolled = written(behind.sortWithinPartitions("conv_id", "piece").mapInArrow(_unrolled, UNROLLED), "unrolled")

    edits = unrolled.mapInArrow(_edit_rows, EDITS)
    names = ["conv_id", "piece", "place", "edit"]
    new_role = F.when(F.col("told") == "u", "user").when(F.col("told") == "a", "assistant")
    inserted = edits.where("edit = 'I'").select(*names, new_role.alias("role"), F.lit("").alias("text"))
    kept = edits.where("edit <> 'I'").join(rows.select("piece", "i", "role", "text"), ["piece", "i"])
    kept = kept.select(*names, F.coalesce(new_role, "role").alias("role"), "text")

    letters = F.sort_array(F.collect_list(F.struct("piece", "letters", "cost")))
    per = unrolled.groupBy("conv_id").agg(
        *[F.sum(n).alias(n) for n in ("blank", "again", "cut", "illegal")], letters.alias("pieces")
    )
    days = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    spread = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = days.groupBy(F.col("conv_id").alias("_conv")).agg(F.coalesce(spread, F.lit(0)).alias("gaps"))
    report = per.join(gaps, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id",
        "gaps",
        "blank",
        F.col("again").alias("duplicate"),
        F.col("cut").alias("truncated"),
        "illegal",
        F.get("pieces", F.lit(0))["cost"].alias("cost"),
        F.array_join(F.transform("pieces", lambda p: p["letters"]), "").alias("audit"),
    )
    return kept.unionByName(inserted), report
