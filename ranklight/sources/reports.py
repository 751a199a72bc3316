"""Small result tables: model comparison and drift summary."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIFT_SUMMARY = """
status string, drift_detected boolean, drift_share double,
reference_rows bigint, current_rows bigint,
column_results array<struct<
  column: string, drift_score: double, drift_detected: boolean, method: string>>
"""


def write_metric_comparison(comparison: DataFrame, path: str) -> None:
    """One row per metric name, so one file."""
    comparison.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_metric_comparison(spark: SparkSession, path: str) -> DataFrame:
    schema = "metric string, model_a double, model_b double, diff_b_minus_a double"
    return spark.read.schema(schema).option("header", True).csv(path)


def with_column_results(summary: DataFrame, columns: DataFrame) -> DataFrame:
    """Attach the rows per monitored column (a handful) to the one-row summary."""
    fields = ("column", "drift_score", "drift_detected", "method")
    rows = columns.agg(F.array_sort(F.collect_list(F.struct(*fields)))).scalar()
    return summary.withColumn("column_results", rows)


def write_drift_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_drift_summary(spark: SparkSession, path: str) -> DataFrame | None:
    """None when no summary was written."""
    try:
        return spark.read.schema(DRIFT_SUMMARY).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
