"""From raw documents to packed training sequences.

Each stage takes what the stage before it kept and is written as Parquet before the next one reads
it, so a lost executor costs a stage's tasks at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtrace.llm import minhash, mixing, packing, quality_model, substring
from coldtrace.llm.common import small_side, table
from coldtrace.llm.queries import tokenizer_path
from coldtrace.session import scratch_root

#: Passages of so many words that stand in an earlier document, too, are cut out.
PASSAGE = 50
#: Words of a shingle in near-duplicate detection.
SHINGLE = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_model.score(docs, model, "__quality")
    return scored.filter(F.col("__quality") >= quality_model.THRESHOLD).drop("__quality")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates.

    Of rows with one id and different texts each is judged by its own text.
    """
    found = minhash.judged_rows(docs, words=SHINGLE)
    dropped = found.filter(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("__doc_id"), F.col("version").alias("__version")
    )
    same = (F.col("doc_id") == F.col("__doc_id")) & (minhash.version(F.col("text")) == F.col("__version"))
    return docs.join(small_side(dropped.distinct()), same, "left_anti").select(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share with earlier ones; all others unchanged."""
    cut = substring.remove_repeats(docs, PASSAGE).filter("n_removed > 0").select(
        F.col("doc_id").alias("__doc_id"), F.col("version").alias("__version"), F.col("kept").alias("__kept")
    )
    same = (F.col("doc_id") == F.col("__doc_id")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__version")
    )
    changed = docs.join(cut.dropDuplicates(["__doc_id", "__version"]), same, "left")
    changed = changed.withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        length = F.when(F.col("__kept").isNotNull(), F.length("__kept").cast("long"))
        changed = changed.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return changed.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources come to their target shares."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their tokens and their place in a sequence."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        "ids",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing and learning have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
