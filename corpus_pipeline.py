"""From raw documents to packed training sequences: STAGES over the table documents.

Each stage takes what its predecessor kept.  All but the last return the columns of their
input; the last returns one row a piece of packed text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import decontam, jaccard, packing, quality, repeats
from tillstream.llm.store import written

TOKENIZER, END_ID = "word_bpe_49k.json", 0


def _narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text and the other columns as one, so that no name clashes with an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(1).alias("_"), *rest).alias("rest"))


def _wide(narrow: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again."""
    return narrow.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base or the ratio go."""
    rated = quality.rate(_narrow(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _wide(rated.where("rated.kept"), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of linked documents the one with the smallest doc_id stays."""
    return _wide(jaccard.one_of_each_component(_narrow(docs)), docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated byte strings are cut out; documents with nothing left go.

    A character of which a byte repeats goes as a whole; n_chars counts anew.  A null text
    stays null.
    """
    narrow = _narrow(docs)

    def text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, kept = batch["text"].is_valid().to_pylist(), batch["cut_text"].to_pylist()
            whole = [x.decode() if k else None for x, k in zip(kept, known, strict=True)]
            yield pa.record_batch({"doc_id": batch["doc_id"], "text": pa.array(whole, pa.string()), "rest": batch["rest"]})

    done = repeats.cut_repeats(narrow, whole_characters=True)
    left = done.where((F.length("cut_text") > 0) | (F.col("cut_bytes") == 0))
    out = _wide(left.mapInArrow(text, narrow.schema), docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak an item go."""
    flagged = decontam.flag_leaks(_narrow(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _wide(flagged.where(F.size("leaks") == 0), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row a piece, with its sequence and place."""
    capacity = packing.Capacity()
    return packing.pack(packing.pieces(docs, TOKENIZER, END_ID, capacity.tokens), capacity)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", pack_sequences),
]

# Similarity by components, repeated byte strings and tokenizers cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES one after another over documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
