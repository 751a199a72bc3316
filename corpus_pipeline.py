"""From raw documents to packed training sequences: five stages, each a table of its own.

Each stage is a function of (spark, docs, sf_dir). Its result is written to the shared folder
and read again as the next stage's documents. All but the last return the columns of
documents; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.llm import decontaminate, line_dedup, near_dedup, packing, quality_gam
from ranklight.llm.common import table
from ranklight.session import own_scratch, settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_gam.keep_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in the last of them only."""
    cleaned = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(kind))
    return cleaned.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return near_dedup.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in as few sequences as can be found."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


#: Ten thousand rows at once, as Spark hands them to Python, are tens of megabytes of text in the
#: executor's buffers and in each worker, which keep what they once took through all later stages.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def _stage(function):
    """Texts go to Python in small batches; where the session names no shared folder, as in trials, set one."""

    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in SMALL_BATCHES.items():
            spark.conf.set(key, value)
        return function(own_scratch(spark), docs, sf_dir)

    return staged


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", _stage(quality)),
    ("line_dedup", _stage(lines)),
    ("simhash_near_dedup", _stage(near_duplicates)),
    ("benchmark_decontamination", _stage(decontamination)),
    ("best_fit_packing", _stage(pack)),
]

#: The classifier and the packing cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(own_scratch(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
