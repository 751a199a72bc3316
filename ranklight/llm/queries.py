"""One query per operator of this subpackage, and SQL where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ranklight.llm import (
    decontaminate,
    histogram_packing,
    interpolation,
    isolation,
    line_dedup,
    near_dedup,
    packing,
    quality_gam,
    repeats,
    sharding,
    toxicity,
    vector_codes,
    whitening,
)
from ranklight.llm.common import table
from ranklight.session import own_scratch, tune


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"), shards=8)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_gam.quality_digest(docs, labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity_digest(docs, labels)


def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.interpolation_digest(table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, benchmark)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return isolation.rules_digest(docs, labels)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight codes of four bits for each vector, by codebooks of six rounds."""
    return vector_codes.code_digest(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


def op12_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, by combinations of at most three lengths."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return histogram_packing.packing_digest(table(spark, sf_dir, "documents"), vocabulary, 2048)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the 32 leading components, each with unit variance."""
    return whitening.whitening_digest(table(spark, sf_dir, "embeddings"), components=32)


def _with_folder(function):
    """Run in the session as it is, with the joins' settings and, where unset, a folder of its own."""
    return lambda spark, sf_dir: function(own_scratch(tune(spark)), sf_dir)


QUERIES = {
    f.__name__: _with_folder(f)
    for f in (
        op1_sharding,
        op2_quality,
        op3_toxicity,
        op4_deleted_interpolation,
        op5_simhash_near_dedup,
        op6_decontamination,
        op7_packing,
        op8_suffix_array_dedup,
        op9_line_dedup,
        op10_quality_rules,
        op11_vector_codes,
        op12_histogram_packing,
        op13_whitening,
    )
}
QUERIES["pipeline"] = _with_folder(corpus_pipeline.run)
ORACLES = {"op9_line_dedup": line_dedup.SQL, "op11_vector_codes": vector_codes.SQL}
