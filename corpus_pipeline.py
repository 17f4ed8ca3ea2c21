"""A corpus from raw documents: five stages, each an operator over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, quality_rules, repeats, segmentation
from tidemark.llm.queries import FRAGMENT_WORDS, PIECE_BPE, vocabulary_path
from tidemark.llm.rows import shipped, stored, table


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or that the trees reject go."""
    forest = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, forest)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: strings that an earlier document has go from the texts."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: each document as often as the mix takes it."""
    weight = F.when(F.col("size") >= FRAGMENT_WORDS, 2.0).otherwise(1.0)
    return mixing.mix(docs, weight=weight)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: sampled segmentations of each text, with their ids.

    Each copy that the mix takes of a document draws its own; ``copy`` numbers them. Workers and executors have held
    the stages before, so less text is worked on at a time.
    """
    model = vocabulary_path(PIECE_BPE)
    size = segmentation.CHUNK_BYTES // 2
    return segmentation.encode(docs, model, with_ids=True, chunk_bytes=size, with_copies=True)


STAGES = [
    ("quality rules", shipped(reject_bad)),
    ("MinHash near-dedup", shipped(drop_near_copies)),
    ("suffix-array dedup", shipped(cut_repeats)),
    ("mixing sources to target weights", shipped(mix_sources)),
    ("SentencePiece encoding and decoding", shipped(encode)),
]

#: Trained trees and sampled segmentations have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
