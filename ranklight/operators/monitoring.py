"""Aggregates over prediction and feedback logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.stats import finite
from ranklight.functions.text import first_items_text

# Upper bounds of the latency (seconds) and score histograms.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
SCORE_BUCKETS = [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0]


def kpis(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    events = feedback.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("action") == "click").alias("clicks"),
            F.count_if(F.col("action") == "purchase").alias("purchases"),
        )
    ).scalar()
    shown = predictions.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.coalesce(F.avg(finite("latency_ms")), F.lit(0.0)).alias("avg_latency_ms"),
    ).withColumn("_events", events)
    clicks = F.col("_events.clicks")
    rate = F.coalesce(F.try_divide(clicks.cast("double"), F.col("predictions")), F.lit(0.0))
    return shown.select(
        "predictions",
        "avg_latency_ms",
        F.col("_events.rows").alias("feedback_events"),
        clicks.alias("clicks"),
        F.col("_events.purchases").alias("purchases"),
        rate.alias("click_rate"),
    )


def requests_per_minute(predictions: DataFrame) -> DataFrame:
    timed = predictions.filter(F.col("timestamp").isNotNull())
    minute = F.date_trunc("minute", "timestamp").alias("minute")
    return timed.groupBy(minute).agg(F.count(F.lit(1)).alias("requests"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null counts as ``unknown``."""
    value = F.coalesce(F.col(column), F.lit("unknown")).alias(column)
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("events"))


def variant_counts(predictions: DataFrame) -> DataFrame:
    return counts_by(predictions, "variant")


def action_counts(feedback: DataFrame) -> DataFrame:
    return counts_by(feedback, "action")


def feedback_hourly(feedback: DataFrame) -> DataFrame:
    """Long form ``hour, action, events``: every action that occurs, null as ``unknown``."""
    timed = feedback.filter(F.col("logged_at").isNotNull())
    hour = F.date_trunc("hour", "logged_at").alias("hour")
    action = F.coalesce("action", F.lit("unknown")).alias("action")
    return timed.groupBy(hour, action).agg(F.count(F.lit(1)).alias("events"))


def feedback_hourly_wide(feedback: DataFrame, actions: Sequence[str]) -> DataFrame:
    """``hour`` and one count column for each of ``actions``, 0 where it does not occur.

    The columns are fixed beforehand, so an action that never occurs is there and no job looks for the
    values first; other actions and null are counted in ``other``.
    """
    if "other" in actions or "hour" in actions:
        raise ValueError("actions cannot be named hour or other")
    timed = feedback.filter(F.col("logged_at").isNotNull())
    known = F.coalesce(F.col("action").isin(*actions), F.lit(False))
    return timed.groupBy(F.date_trunc("hour", "logged_at").alias("hour")).agg(
        *[F.count_if(F.col("action") == a).alias(a) for a in actions],
        F.count_if(~known).alias("other"),
    )


def _recent(df: DataFrame, time: str, ties: Sequence[str], n: int) -> DataFrame:
    # Rows without a time sort last in the log, so the newest rows include them.
    last = df.orderBy(F.desc_nulls_first(time), *[F.desc(t) for t in ties]).limit(n)
    return last.orderBy(F.desc_nulls_last(time), *[F.desc(t) for t in ties])


def recent_predictions(
    predictions: DataFrame, n: int = 10, ties: Sequence[str] = ("user_id",)
) -> DataFrame:
    recent = _recent(predictions, "timestamp", ties, n)
    return recent.select(
        "timestamp", "user_id", "variant", "latency_ms", first_items_text(F.col("items")).alias("items")
    )


def recent_feedback(
    feedback: DataFrame, n: int = 10, ties: Sequence[str] = ("user_id",)
) -> DataFrame:
    recent = _recent(feedback, "logged_at", ties, n)
    return recent.select("logged_at", "timestamp", "user_id", "item_id", "action")


def event_counters(requests: DataFrame, feedback: DataFrame, errors: DataFrame) -> DataFrame:
    """Counts of requests by (variant, status), feedback by action, errors by endpoint.

    One aggregation over the three logs; each log fills only its own labels.
    """
    none = F.lit(None).cast("string")

    def labelled(df: DataFrame, counter: str, **labels: str) -> DataFrame:
        columns = {
            name: F.col(labels[name]).cast("string") if name in labels else none
            for name in ("variant", "status", "action", "endpoint")
        }
        return df.select(F.lit(counter).alias("counter"), *[c.alias(n) for n, c in columns.items()])

    rows = (
        labelled(requests, "recommend_total", variant="variant", status="status")
        .unionByName(labelled(feedback, "feedback_total", action="action"))
        .unionByName(labelled(errors, "errors_total", endpoint="endpoint"))
    )
    return rows.groupBy("counter", "variant", "status", "action", "endpoint").agg(
        F.count(F.lit(1)).alias("value")
    )


def shared_event_counters(log: DataFrame) -> DataFrame:
    """``event_counters`` of one log that holds requests, feedback and errors, read once.

    ``log`` has variant, status, action and endpoint. Rows with a status are requests, rows with
    an action feedback, rows with an endpoint errors; a row may be several of them. Requests, feedback
    and errors are three grouping sets of one Expand, so that the log is aggregated in one pass.
    """
    labels = ["variant", "status", "action", "endpoint"]
    sets = [["variant", "status"], ["action"], ["endpoint"]]
    # A label outside of a set and a label that is null are told apart by the grouping bits.
    of_requests, of_feedback = F.grouping("status") == 0, F.grouping("action") == 0
    counter = (
        F.when(of_requests, "recommend_total").when(of_feedback, "feedback_total").otherwise("errors_total")
    )
    told = F.when(of_requests, F.col("status")).when(of_feedback, F.col("action")).otherwise(F.col("endpoint"))
    counted = log.select(*[F.col(c).cast("string").alias(c) for c in labels]).groupingSets(sets, *labels)
    rows = counted.agg(counter.alias("counter"), F.count(F.lit(1)).alias("value"), told.alias("_told"))
    return rows.filter(F.col("_told").isNotNull()).select("counter", *labels, "value")


def histogram_columns(value: Column, bounds: Sequence[float]) -> list[Column]:
    """Cumulative count per upper bound and above all, plus sum and count, as one struct list."""
    value = finite(value)
    cells = [
        F.struct(F.lit(str(float(b))).alias("le"), F.count_if(value <= b).alias("observations"))
        for b in bounds
    ]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.count(value).alias("observations")))
    return [
        F.array(*cells).alias("_cells"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("total"),
        F.count(value).alias("samples"),
    ]


def histogram(
    df: DataFrame, value: Column, labels: Sequence[Column | str], bounds: Sequence[float]
) -> DataFrame:
    """Rows ``labels, le, observations, total, samples``; one pass, no bucket join."""
    wide = df.groupBy(*labels).agg(*histogram_columns(value, bounds))
    names = [c for c in wide.columns if c not in ("_cells", "total", "samples")]
    return wide.select(*names, F.inline("_cells"), "total", "samples")


def latency_histogram(predictions: DataFrame) -> DataFrame:
    return histogram(predictions, F.col("latency_ms") / 1000.0, ["variant"], LATENCY_BUCKETS)


def score_histogram(scored_items: DataFrame) -> DataFrame:
    """Over one row per recommended item: ``variant, score``."""
    return histogram(scored_items, F.col("score"), ["variant"], SCORE_BUCKETS)
