"""Distinct counts from stored sketches that merge, for tables too large to count anew each day.

A sketch table has one small row for each day and column. A new batch is sketched alone and added to the
table; counts over any days union the stored rows and never read the data again. Exact counts
(``dataset_summary``, ``category_cardinality``) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 to the power of 16 cells: a standard error of 0.4 percent.
PRECISION = 16


def sketch_columns(
    df: DataFrame, columns: Sequence[str], day: Column | None = None, precision: int = PRECISION
) -> DataFrame:
    """Rows ``day, column, rows, sketch``: the distinct values of each column on each day.

    ``day`` is any grouping value, null by default (one row a column). Nulls are no values; they
    count in ``rows``. Sketches are combined in the map tasks, so a day of any size moves one small row a task.
    """
    when = F.lit(None).cast("date") if day is None else day
    cells = [
        F.hll_sketch_agg(F.col(c).cast("string"), precision).alias(f"_{k}") for k, c in enumerate(columns)
    ]
    wide = df.withColumn("_day", when).groupBy("_day").agg(F.count(F.lit(1)).alias("rows"), *cells)
    each = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_{k}").alias("sketch")) for k, c in enumerate(columns)]
    )
    return wide.select(F.col("_day").alias("day"), "rows", F.inline(each)).select(
        "day", "column", "rows", "sketch"
    )


def merged_sketches(*tables: DataFrame) -> DataFrame:
    """One sketch table of several: the same cells as ``sketch_columns`` of all their rows would have."""
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows.groupBy("day", "column").agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch")
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Rows ``column, rows, distinct_values`` over all days of a sketch table."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
