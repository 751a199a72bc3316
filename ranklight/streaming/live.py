"""Live forms of the log aggregates.

Every function takes and returns a streaming frame (and works on a batch one, which
is how the results are compared). State is bounded by the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.stats import finite
from ranklight.operators.alerts import ERROR_RATE_LIMIT, LATENCY_LIMIT_MS, error_rate
from ranklight.operators.experiment import route_traffic
from ranklight.operators.monitoring import LATENCY_BUCKETS, histogram_columns

LATENESS = "10 minutes"


def _window(df: DataFrame, time: str, length: str, lateness: str) -> tuple[DataFrame, Column]:
    return df.withWatermark(time, lateness), F.window(time, length).alias("_window")


def stream_requests_per_minute(predictions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    timed, window = _window(predictions, "timestamp", "1 minute", lateness)
    counted = timed.groupBy(window).agg(F.count(F.lit(1)).alias("requests"))
    return counted.select(F.col("_window.start").alias("minute"), "requests")


def stream_feedback_hourly(feedback: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Long form: hour, action, events."""
    timed, window = _window(feedback, "logged_at", "1 hour", lateness)
    counted = timed.groupBy(window, "action").agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("_window.start").alias("hour"), "action", "events")


def stream_counters(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Running totals per label set; write in update or complete mode."""
    return rows.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def stream_latency_histogram(
    predictions: DataFrame, length: str = "1 hour", lateness: str = LATENESS
) -> DataFrame:
    timed, window = _window(predictions, "timestamp", length, lateness)
    seconds = F.col("latency_ms") / 1000.0
    wide = timed.groupBy(window, "variant").agg(*histogram_columns(seconds, LATENCY_BUCKETS))
    return wide.select(
        F.col("_window.start").alias("start"), "variant", F.inline("_cells"), "total", "samples"
    )


def stream_route(
    requests: DataFrame, mode: str = "ab_test", split_ratio: float | None = None
) -> DataFrame:
    return route_traffic(requests, mode, split_ratio)


def stream_attribution(
    predictions: DataFrame,
    feedback: DataFrame,
    within: str = "1 hour",
    lateness: str = LATENESS,
) -> DataFrame:
    """Feedback with each prediction of the same user at most ``within`` before it.

    Both sides carry a watermark and the condition bounds the time between them, so
    both states are finite. ``latest_attribution`` then keeps one row per feedback.
    """
    shown = predictions.select(
        F.col("user_id").alias("_user"), F.col("timestamp").alias("predicted_at"), "variant"
    ).withWatermark("predicted_at", lateness)
    given = feedback.withWatermark("timestamp", lateness)
    bound = (
        (F.col("user_id") == F.col("_user"))
        & (F.col("predicted_at") <= F.col("timestamp"))
        & (F.col("predicted_at") >= F.col("timestamp") - F.expr(f"INTERVAL {within}"))
    )
    return given.join(shown, bound).drop("_user")


def latest_attribution(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest prediction per feedback row, for use on one batch of joined rows."""
    newest = F.max(F.struct("predicted_at", "variant")).alias("_newest")
    rows = joined.groupBy(*keys).agg(newest)
    return rows.select(*keys, F.col("_newest.predicted_at"), F.col("_newest.variant"))


def stream_alerts(
    requests: DataFrame,
    failed: Column,
    length: str = "1 hour",
    lateness: str = LATENESS,
    latency_limit: float = LATENCY_LIMIT_MS,
    error_limit: float = ERROR_RATE_LIMIT,
) -> DataFrame:
    """Per window the mean latency, the error rate, and whether each is over its limit.

    An update may lift an alert again, so readers filter the latest row of a window.
    """
    timed, window = _window(requests, "timestamp", length, lateness)
    measured = timed.groupBy(window).agg(
        F.coalesce(F.avg(finite("latency_ms")), F.lit(0.0)).alias("mean_latency_ms"),
        error_rate(F.count_if(failed), F.count(F.lit(1))).alias("error_rate"),
    )
    return measured.select(
        F.col("_window.start").alias("start"),
        "mean_latency_ms",
        "error_rate",
        (F.col("mean_latency_ms") > latency_limit).alias("latency_alert"),
        (F.col("error_rate") > error_limit).alias("error_alert"),
    )


def start_upserts(stream: DataFrame, path: str, checkpoint: str):
    """Write a windowed aggregate in update mode: every change of a row, with its batch number.

    No window is held back until the watermark passes it, so the last ones count too;
    ``latest_rows`` reads what holds now. A batch that is run again writes the
    same rows under the same number.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("append").parquet(path)

    writer = stream.writeStream.foreachBatch(add).outputMode("update")
    return writer.option("checkpointLocation", checkpoint)


def latest_rows(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the rows that ``start_upserts`` wrote, the last of each key."""
    values = [c for c in written.columns if c not in (*keys, "_batch")]
    newest = F.max_by(F.struct(*values), "_batch").alias("_newest")
    return written.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def stream_dedup(
    log: DataFrame, keys: Sequence[str] = ("user_id", "timestamp"), lateness: str = LATENESS
) -> DataFrame:
    """Drop redelivered rows within the watermark."""
    return log.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(list(keys))
