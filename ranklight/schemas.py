"""Explicit schemas of the sources and the column lists that jobs check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INTERACTION_COLUMNS = ["user_id", "item_id", "rating", "timestamp"]

REVIEWS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("parent_asin", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.ArrayType(T.StringType())),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("price", T.StringType()),
        T.StructField("main_category", T.StringType()),
    ]
)

# Log lines as written: every value is read as text first and coerced afterwards,
# so that a wrong type becomes null while malformed JSON still fails the job.
PREDICTION_LINES = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("items", T.StringType()),
        T.StructField("latency_ms", T.StringType()),
    ]
)

FEEDBACK_LINES = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("logged_at", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("action", T.StringType()),
    ]
)

PREDICTION_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("num_items", T.IntegerType()),
        T.StructField("top_item", T.StringType()),
        T.StructField("request_hour", T.IntegerType()),
        T.StructField("request_dayofweek", T.IntegerType()),
    ]
)

FEEDBACK_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("action", T.StringType()),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Fail at plan time, without a job, when a column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
