"""Prediction and feedback logs as JSON lines, in batch and as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ranklight import schemas
from ranklight.functions.stats import finite

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """None when there is no file; malformed lines fail the job."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def prediction_columns(lines: DataFrame) -> DataFrame:
    """Coerce the raw text columns and derive the monitored ones."""
    listed = F.from_json("items", "array<string>")
    typed = lines.select(
        F.expr("try_to_timestamp(timestamp)").alias("timestamp"),
        "user_id",
        F.coalesce("variant", F.lit("unknown")).alias("variant"),
        F.coalesce(listed, F.array().cast("array<string>")).alias("items"),
        finite(F.col("latency_ms").try_cast("double")).alias("latency_ms"),
    )
    return derive_columns(typed)


def derive_columns(predictions: DataFrame) -> DataFrame:
    """Item count, first item, hour and weekday (Monday 0); no time gives -1."""
    return predictions.withColumns(
        {
            "num_items": F.size("items"),
            "top_item": F.get("items", F.lit(0)),
            "request_hour": F.coalesce(F.hour("timestamp"), F.lit(-1)),
            "request_dayofweek": F.coalesce(F.weekday("timestamp"), F.lit(-1)),
        }
    )


def feedback_columns(lines: DataFrame) -> DataFrame:
    times = {c: F.expr(f"try_to_timestamp({c})") for c in ("timestamp", "logged_at")}
    return lines.select(*[times.get(c, F.col(c)).alias(c) for c in schemas.FEEDBACK_LINES.names])


def read_predictions(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    lines = _lines(spark, path, schemas.PREDICTION_LINES)
    if lines is None:
        return spark.createDataFrame([], schemas.PREDICTION_LOG)
    df = prediction_columns(lines)
    return df.orderBy(F.asc_nulls_last("timestamp")) if ordered else df


def read_feedback(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    lines = _lines(spark, path, schemas.FEEDBACK_LINES)
    if lines is None:
        return spark.createDataFrame([], schemas.FEEDBACK_LOG)
    df = feedback_columns(lines)
    return df.orderBy(F.asc_nulls_last("logged_at")) if ordered else df


def stream_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Malformed lines fail the stream, as they fail the batch."""
    reader = spark.readStream.schema(schemas.PREDICTION_LINES).option("mode", "FAILFAST")
    return prediction_columns(reader.json(path))


def stream_feedback(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.readStream.schema(schemas.FEEDBACK_LINES).option("mode", "FAILFAST")
    return feedback_columns(reader.json(path))


def prediction_records(predictions: DataFrame) -> DataFrame:
    """Log records as written: ISO time, latency to two decimals."""
    return predictions.select(
        F.date_format("timestamp", _ISO).alias("timestamp"),
        "user_id",
        "variant",
        "items",
        F.round("latency_ms", 2).alias("latency_ms"),
    )


def feedback_records(feedback: DataFrame) -> DataFrame:
    return feedback.select(
        F.date_format("timestamp", _ISO).alias("timestamp"),
        F.date_format("logged_at", _ISO).alias("logged_at"),
        "user_id",
        "item_id",
        "action",
    )


def append_log(records: DataFrame, path: str) -> None:
    """Each task appends its own file; readers take the folder as one log."""
    records.write.mode("append").json(path)


def append_stream(records: DataFrame, path: str, checkpoint: str):
    """File sink with exactly-once files for a stream of records."""
    return (
        records.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
