"""Registered queries of the operators in this folder, over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtrace.llm import (
    alignment,
    embeddings,
    language,
    minhash,
    mixing,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    sharding,
    substring,
    toxicity,
    warc,
)
from coldtrace.llm.common import table
from coldtrace.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "warc")
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("record_id"), "url", F.col("html").alias("payload")
    )
    warc.write_archives(pages, folder)
    return warc.read_archives(spark, folder).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), _folder(spark, "slot-map"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op3_open_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, recall = embeddings.near_vectors(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return found.withColumns({"kept": kept, "audited_recall": F.lit(recall)})


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    base = F.lit(quality_rules.policy_mask(quality_rules.BASE)).cast("long")
    return judged.withColumn("base_failed", F.col("failed").bitwiseAND(base) != 0)


def op7_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op8_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality_model.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_multi_index_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.withColumn("kept", kept)


def op10_repetition_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
    )


def op11_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def heads(conv):
        turns = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(4))
        return conv - conv % 20, turns

    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), heads)


def op12_anchored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *paths)[0]


def op13_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def llm_queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_warc_chunks,
            op2_virtual_slots,
            op3_open_window_packing,
            op4_recompression,
            op5_nn_descent,
            op6_rule_ledger,
            op7_word_first_language,
            op8_subword_quality,
            op9_multi_index_minhash,
            op10_repetition_mix,
            op11_prefix_table,
            op12_anchored_windows,
            op13_toxic_segments,
        )
    }
