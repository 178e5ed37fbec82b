"""The operators over whole tables, and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import chat, counts, decontam, jaccard, packing, pieces, quality, repair, repeats, shards, sql, tokenfile, trie, warc
from tillstream.llm.store import work_area

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one, -7, whose texts look like control strings."""
    both = F.array(F.lit("user"), F.lit("assistant"))
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.get(both, F.col("id").cast("int")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    told = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.prefix_examples(told.unionByName(probe)))


def op2_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    leaks = decontam.flag_leaks(docs, table(spark, folder, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return leaks.select(
        "doc_id", "leak.item_id", "leak.similarity", F.col("leak.from").alias("from_byte"), F.col("leak.to").alias("to_byte"), "leak.found_by"
    )


def op3_vector_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    capacity = packing.Capacity()
    found = packing.pieces(table(spark, folder, "documents"), "word_bpe_49k.json", 0, capacity.tokens)
    return packing.pack(found, capacity)


def op4_seekable_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    manifest = tokenfile.write_tokens(table(spark, folder, "documents"), "word_bpe_49k.json", 2)
    return tokenfile.read_tokens(manifest)


def op5_digest_cache_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Through a cache that knows about an eighth of the texts already, by an earlier count."""
    cache = work_area(spark, "counts")
    docs = table(spark, folder, "documents")
    counts.fill_cache(docs.where(F.pmod(F.xxhash64("text"), F.lit(8)) == 0), "piece_bpe_32k.model", cache)
    return counts.count_tokens(docs, "piece_bpe_32k.model", cache)


def op6_chain_verified_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of both kinds: a quarter of the pages in plain ones, where payloads stand as
    they are and the chain has to tell records from what looks like them."""
    pages = table(spark, folder, "pages")
    return warc.read_archives(warc.write_archives(pages, plain=F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0))


def op7_parity_sketch_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(table(spark, folder, "documents"))


def op8_ngram_ratio_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rated = quality.rate(docs, table(spark, folder, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rated.select("doc_id", *[f"rated.{n}" for n in names])


def op9_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.kd_shards(table(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_bwt_interval_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = repeats.cut_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("cut_bytes").alias("n_bytes"), F.col("cut_removed").alias("n_removed"),
        F.col("cut_spans").alias("n_spans"), F.sha2("cut_text", 256).alias("kept_sha256"),
    )


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Sequences (conv_id, turns) that begin as the first of their hundred does, for op11."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(100))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6).cast("int")
    heads = sequences.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    told = sequences.select("conv_id", "turns", base.alias("base"), h.alias("h")).join(heads, "base", "left")
    own = F.filter("turns", lambda _, i: i >= F.col("h"))
    head = F.filter("head", lambda _, i: i < F.col("h"))
    return told.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(head, own)).alias("turns"))


def op11_neighbour_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(rebuilt(trie.turn_sequences(table(spark, folder, "conversations"))))


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with the faults that op12 is asked to repair."""
    told = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    return told.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )


def op12_run_length_repair(spark: SparkSession, folder: str) -> DataFrame:
    told = table(spark, folder, "conversations")
    edits, report = repair.repair_conversations(damaged(told))
    hashes = repair.repaired_digests(edits).select(F.col("conv_id").alias("_hashed"), "sha256")
    found = report.withColumnRenamed("conv_id", "_found")
    whole = told.select("conv_id").distinct()
    whole = whole.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left")
    whole = whole.join(hashes, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_offset_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = "piece_bpe_32k.model"
    back = pieces.decode_pieces(pieces.encode_pieces(table(spark, folder, "documents"), model), model)
    return back.select(
        "doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_chat_prefix_targets,
            op2_simhash_windows,
            op3_vector_best_fit,
            op4_seekable_token_frames,
            op5_digest_cache_counts,
            op6_chain_verified_warc,
            op7_parity_sketch_join,
            op8_ngram_ratio_quality,
            op9_kd_tree_shards,
            op10_bwt_interval_dedup,
            op11_neighbour_trie,
            op12_run_length_repair,
            op13_offset_pieces,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_prefix_targets": sql.chat_prefix_targets(),
        "op6_chain_verified_warc": sql.WARC,
        "op7_parity_sketch_join": sql.SIMILAR,
        "op10_bwt_interval_dedup": sql.REPEATS,
        "op11_neighbour_trie": sql.trie(),
        "op12_run_length_repair": sql.repaired(),
    }
