"""Token counts through a cache of digests."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.store import ship_code
from tillstream.llm.textblock import blocks
from tillstream.llm.tokens import vocabulary_file, word_tokenizer

CACHE = "digest binary, tokenizer string, n_tokens long, run string"


@lru_cache(maxsize=2)
def _counter(file: str):
    """A function from a block of texts to their numbers of tokens, and one to call at the end of a task."""
    if file.endswith(".model"):
        import sentencepiece

        tool = sentencepiece.SentencePieceProcessor(model_file=file)
        return lambda batch, texts: [
            len(ids) for ids in tool.encode(["" if t is None else t for t in batch["text"].to_pylist()], num_threads=1)
        ], lambda: None
    try:
        words = word_tokenizer(file)
        return lambda batch, texts: np.diff(words.encode(texts)[1]), words.forget
    except ValueError:
        from tokenizers import Tokenizer

        tool = Tokenizer.from_file(file)
        tool.no_truncation()
        tool.no_padding()
        return lambda batch, texts: [
            len(x.ids)
            for x in tool.encode_batch(["" if t is None else t for t in batch["text"].to_pylist()], add_special_tokens=False)
        ], lambda: None


def tokenizer_version(file: str) -> str:
    """Digest of the vocabulary file: a changed file counts anew."""
    with open(file, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """digest, n_tokens and run (which wrote it) of the cache's counts by this tokenizer."""
    try:
        found = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], CACHE)
    return found.where(F.col("tokenizer") == version).select("digest", "n_tokens", "run")


def fill_cache(docs: DataFrame, tokenizer: str, cache: str, *, tokenizer_path: str | None = None) -> str:
    """Count the texts of docs (doc_id, text) that the cache lacks, once each, and append
    them under the name of this run, which is returned.

    Only the texts of one document for each missing digest are moved and encoded.  Two
    runs at once may store a count twice, which changes nothing.  Nothing is written that
    is known; an empty table adds nothing.
    """
    spark = docs.sparkSession
    ship_code(spark)
    file = vocabulary_file(tokenizer, tokenizer_path)
    version = tokenizer_version(file)
    plain = _plain(docs)
    missing = plain.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    missing = missing.join(_stored(spark, cache, version).select("digest").distinct(), "digest", "left_anti")
    first = plain.alias("d").join(
        missing.alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.digest") == F.col("m.digest")),
        "left_semi",
    )

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, finish = _counter(file)
        for batch, texts in blocks(batches, "text", 1_000_000):
            n = pa.array(np.asarray(count(batch, texts), np.int64))
            yield pa.record_batch({"digest": batch["digest"], "n_tokens": n})
        finish()

    counted = first.select("text", "digest").mapInArrow(encode, "digest binary, n_tokens long")
    run = uuid.uuid4().hex
    told = counted.dropDuplicates(["digest"]).select(
        "digest", F.lit(version).alias("tokenizer"), "n_tokens", F.lit(run).alias("run")
    )
    told.write.mode("append").parquet(cache)
    return run


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, *, limit: int = 4096, tokenizer_path: str | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, from_cache of docs (doc_id, text).

    The cache is a Parquet folder of (digest, tokenizer, n_tokens, run).  Texts are normalised
    to what has the same tokens by definition: a null text is the empty one.  Digests
    without a stored count are encoded once each and appended; from_cache says that a
    count was there before.  Repeated rows each have a row in the result; a null doc_id
    stays null; other columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    version = tokenizer_version(vocabulary_file(tokenizer, tokenizer_path))
    sized = _plain(docs).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    run = fill_cache(docs, tokenizer, cache, tokenizer_path=tokenizer_path)
    earlier = F.coalesce(F.col("run") != run, F.lit(True))
    counts = _stored(spark, cache, version).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens"), F.bool_or(earlier).alias("from_cache")
    )
    return sized.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        "from_cache",
    )
