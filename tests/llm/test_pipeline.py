"""Each stage of the pipeline on the output of the stage before it."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from given import SMALL
from pyspark.sql import functions as F

import corpus_pipeline as pipeline


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Documents and the rows of each stage, with extra columns whose names operators use."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({n: F.lit(n) for n in ("rated", "cut_bytes", "row", "rest", "leaks")})
    nulls = docs.limit(4).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes})
    docs = docs.unionByName(nulls).unionByName(docs.limit(2))
    out, kinds = [docs.collect()], [docs.dtypes]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
        kinds.append(docs.dtypes)
    return out, kinds


def test_columns_stay(steps):
    _, kinds = steps
    assert all(k == kinds[0] for k in kinds[:-1])


def test_quality(spark, steps):
    before, after = steps[0][0], steps[0][1]
    assert not Counter(after) - Counter(before)
    assert not any(brute.quality_base(r["text"])[-1] for r in after)
    good = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    clean = {r["doc_id"] for r in before if r["doc_id"] in good and not brute.quality_base(r["text"])[-1]}
    assert len(clean - {r["doc_id"] for r in after}) <= 0.02 * len(clean)


def test_jaccard(steps):
    before, after = steps[0][1], steps[0][2]
    want = {c for _, n, c in brute.components([(r["doc_id"], r["text"]) for r in before]) if n}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_repeats(steps):
    before, after = steps[0][2], steps[0][3]
    left = {d: n - gone for d, n, gone, _, _ in brute.cut([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"] for r in after} == {d for d, n in left.items() if n}
    assert all(left[r["doc_id"]] - 6 <= len(brute.raw(r["text"])) <= left[r["doc_id"]] for r in after)
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_leaks(spark, steps):
    before, after = steps[0][3], steps[0][4]
    items = [brute.shingle_set(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    sets = {r["doc_id"]: brute.shingle_set(r["text"]) for r in before}
    leaky = {d for d, s in sets.items() if any(x <= s for x in items)}
    clean = {d for d, s in sets.items() if not any(x & s for x in items)}
    kept = {r["doc_id"] for r in after}
    assert clean <= kept and not leaky & kept


def test_packing(steps):
    before, after = steps[0][4], steps[0][5]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    filled = Counter()
    for r in after:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_no_character_comes_from_two_halves(spark):
    """A repeat that begins inside one character and ends inside another."""
    passage = "".join(chr(0x4E00 + k) for k in range(90))
    docs = [(1, "xé" + passage + "éx"), (2, "yũ" + passage + "ãy"), (3, "only")]
    found = pipeline.without_repeats(spark, spark.createDataFrame(docs, "doc_id long, text string"), SMALL)
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {1: "xx", 2: "yy", 3: "only"}


def test_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
