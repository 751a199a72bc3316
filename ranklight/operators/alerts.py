"""Threshold alerts; each one is a row ``name, triggered, observed, threshold, unit``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.stats import finite

DRIFT_SHARE_LIMIT = 0.3
LATENCY_LIMIT_MS = 500.0
ERROR_RATE_LIMIT = 0.05


def _alert(name: str, triggered: Column, observed: Column, threshold: float, unit: str) -> list[Column]:
    return [
        F.lit(name).alias("name"),
        triggered.alias("triggered"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(unit).alias("unit"),
    ]


def alert_drift(summary: DataFrame, limit: float = DRIFT_SHARE_LIMIT) -> DataFrame:
    """From a one-row drift summary; the share of drifted columns is compared."""
    share = F.coalesce(finite("drift_share"), F.lit(0.0))
    fired = F.coalesce(F.col("drift_detected"), F.lit(False)) | (share > limit)
    return summary.select(*_alert("drift", fired, share, limit, "share"))


def alert_latency(latency: DataFrame, limit: float = LATENCY_LIMIT_MS) -> DataFrame:
    """From rows with ``latency_ms``; the mean of the finite ones is compared."""
    mean = latency.agg(F.coalesce(F.avg(finite("latency_ms")), F.lit(0.0)).alias("mean"))
    return mean.select(*_alert("latency", F.col("mean") > limit, F.col("mean"), limit, "ms"))


def error_rate(errors: Column, total: Column) -> Column:
    return errors.cast("double") / F.greatest(total, F.lit(1))


def alert_error_rate(
    requests: DataFrame, failed: Column, limit: float = ERROR_RATE_LIMIT
) -> DataFrame:
    """From one row per request; ``failed`` marks the errors."""
    rate = requests.agg(error_rate(F.count_if(failed), F.count(F.lit(1))).alias("rate"))
    return rate.select(*_alert("error_rate", F.col("rate") > limit, F.col("rate"), limit, "share"))


def alerts_all(
    summary: DataFrame | None,
    latency: DataFrame,
    requests: DataFrame,
    failed: Column,
    include_fallback: bool = False,
) -> DataFrame:
    """All alerts. Drift counts only for a report of status ``ok``, unless told otherwise."""
    parts = [alert_latency(latency), alert_error_rate(requests, failed)]
    if summary is not None:
        accepted = ["ok", "fallback"] if include_fallback else ["ok"]
        parts.insert(0, alert_drift(summary.filter(F.col("status").isin(accepted))))
    return reduce(DataFrame.unionByName, parts)
