"""Bounded samples of rows for fitting the models that the driver learns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import row_key


def hashed_sample(rows: DataFrame, limit: int, seed: int = 7) -> DataFrame:
    """At most ``limit`` rows, chosen by a seeded hash of id and text; all where fewer exist.

    A cut near the share wanted keeps the sort small; the limit makes the bound hold. The
    sample is dealt out again, as a limit leaves it in one task.
    """
    total = rows.count()
    drawn = rows.withColumn("_draw", F.xxhash64(F.lit(seed), row_key()))
    if total > limit:
        share = min(1.0, 1.2 * limit / total)
        drawn = drawn.filter(F.col("_draw") < int(-(2**63) + share * (2**64 - 1)))
    return drawn.orderBy("_draw").limit(limit).drop("_draw").repartition(16)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, fold: Column, column: str = "text"
) -> DataFrame:
    """doc_id, text (or another ``column``) and ``label`` (0 or 1) of the labelled documents in the learning fold.

    Null labels and ids are left out; of several labels for one id the largest counts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    found = docs.select("doc_id", column).filter(fold).join(known, F.col("doc_id") == F.col("_id"))
    return found.select("doc_id", column, F.col("_label").alias("label"))
