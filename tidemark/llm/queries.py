"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    fingerprints,
    main_text,
    minhash,
    mixing,
    quality_rules,
    ranked_search,
    repeats,
    resampling,
    segmentation,
    spelling,
    token_files,
    toxicity,
)
from tidemark.llm.rows import shipped, table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: Documents of fewer words are fragments, which the mix takes half as readily.
FRAGMENT_WORDS = 50


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    size = mixing.word_count(F.col("text"))
    weight = F.when(F.col("size") >= FRAGMENT_WORDS, 2.0).otherwise(1.0)
    return mixing.mixed(mixing.sized(documents, size, weight)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.encode(table(spark, sf_dir, "documents"), vocabulary_path(PIECE_BPE))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def fold() -> Column:
    """Which of four folds of ids a document belongs to; toxicity is not learnt from the one of number 2."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = toxicity.train(documents, table(spark, sf_dir, "labels"), where=fold() != 2)
    scored = toxicity.score(documents, weights)
    held_out = F.coalesce(fold() == 2, F.lit(False))  # rows without an id are in no fold, and not learnt from
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ratios, share = resampling.train(documents, table(spark, sf_dir, "labels"))
    return resampling.resample(documents, ratios, share)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    forest = quality_rules.train(documents, table(spark, sf_dir, "labels"))
    return quality_rules.judge(documents, forest)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"), main_text.train())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_BPE))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.hit_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = {
        "op1_mix": op1_mix,
        "op2_segmentation": op2_segmentation,
        "op3_fingerprints": op3_fingerprints,
        "op4_toxicity": op4_toxicity,
        "op5_resampling": op5_resampling,
        "op6_quality_rules": op6_quality_rules,
        "op7_suffix_array": op7_suffix_array,
        "op8_main_text": op8_main_text,
        "op9_token_files": op9_token_files,
        "op10_minhash": op10_minhash,
        "op11_decontamination": op11_decontamination,
        "op12_ranked_search": op12_ranked_search,
        "op13_spelling": op13_spelling,
    }
    return {name: shipped(query) for name, query in found.items()}
