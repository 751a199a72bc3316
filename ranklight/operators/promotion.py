"""Promotion decisions from metric tables, canary feedback and deployment history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.operators.ordering import top_n

DECISIVE_METRICS = ["ndcg_at_10", "precision_at_10", "recall_at_10", "auc_roc"]
IMPROVEMENT = 0.01
CANARY_MIN_ROWS = 100
CANARY_ERROR_LIMIT = 0.05


def run_metrics(metrics: DataFrame, names: Sequence[str] = DECISIVE_METRICS) -> DataFrame:
    return metrics.filter(F.col("metric").isin(list(names)))


def metric_improvements(
    candidate: DataFrame,
    production: DataFrame,
    keys: Sequence[str] = ("experiment",),
    threshold: float = IMPROVEMENT,
) -> DataFrame:
    """Metrics both runs have, with differences and verdict; an equal value is degraded."""
    new = candidate.select(*keys, "metric", F.col("value").alias("candidate"))
    old = production.select(*keys, "metric", F.col("value").alias("production"))
    both = new.join(old, [*keys, "metric"])
    gap = F.col("candidate") - F.col("production")
    relative = F.coalesce(F.try_divide(gap, F.col("production")), F.lit(0.0))
    improved = F.col("candidate") > F.col("production")
    return both.withColumns(
        {
            "absolute_diff": gap,
            "relative_diff": relative,
            "improved": improved,
            "significant": improved & (relative >= threshold),
        }
    )


def promotion_decision(
    candidate: DataFrame,
    production: DataFrame,
    keys: Sequence[str] = ("experiment",),
    threshold: float = IMPROVEMENT,
) -> DataFrame:
    """One row per candidate: action, reason and the counts behind them."""
    compared = metric_improvements(candidate, production, keys, threshold)
    counted = compared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("common"),
        F.count_if("improved").alias("improved"),
        F.count_if(~F.col("improved")).alias("degraded"),
        F.count_if("significant").alias("significant"),
    )
    runs = candidate.select(*keys).distinct()
    live = production.select(*keys).distinct().withColumn("_live", F.lit(True))
    table = runs.join(live, list(keys), "left").join(counted, list(keys), "left")
    table = table.na.fill(0, ["common", "improved", "degraded", "significant"])
    promote = (F.col("significant") > 0) & (F.col("degraded") < F.col("common") / 2)
    action = (
        F.when(F.col("_live").isNull(), "promoted_to_staging")
        .when(~promote, "rejected")
        .when(F.col("significant") >= 2, "promoted_to_canary")
        .otherwise("promoted_to_staging")
    )
    reason = (
        F.when(F.col("_live").isNull(), "no_production_model")
        .when(~promote, "no_significant_improvement")
        .when(F.col("significant") >= 2, "significant_improvement")
        .otherwise("moderate_improvement")
    )
    return table.select(
        *keys,
        "common",
        "improved",
        "degraded",
        "significant",
        promote.alias("should_promote"),
        action.alias("action"),
        reason.alias("reason"),
    )


def canary_health(
    feedback: DataFrame | None,
    experiments: DataFrame,
    min_rows: int = CANARY_MIN_ROWS,
    error_limit: float = CANARY_ERROR_LIMIT,
) -> DataFrame:
    """Per experiment: status, error rate and whether the canary may proceed.

    ``feedback`` has ``experiment, variant, action``; None stands for a log that does
    not exist.
    """
    if feedback is None:
        return experiments.select(
            "experiment",
            F.lit("no_data").alias("status"),
            F.lit(0).cast("bigint").alias("samples"),
            F.lit(None).cast("double").alias("error_rate"),
            F.lit(True).alias("proceed"),
        )
    rows = feedback.filter(F.col("variant") == "canary")
    counted = rows.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("action") == "error").alias("_errors")
    )
    table = experiments.select("experiment").join(counted, "experiment", "left")
    table = table.na.fill(0, ["samples", "_errors"])
    rate = F.when(
        F.col("samples") >= min_rows, F.col("_errors").cast("double") / F.col("samples")
    )
    status = (
        F.when(F.col("samples") < min_rows, "insufficient_data")
        .when(rate > error_limit, "high_error_rate")
        .otherwise("healthy")
    )
    return table.select(
        "experiment", status.alias("status"), "samples", rate.alias("error_rate"),
        (status == "healthy").alias("proceed"),
    )


def latest_deployment_state(history: DataFrame, ties: Sequence[str] = ("version",)) -> DataFrame:
    """The newest row per experiment."""
    rest = [c for c in history.columns if c not in ("experiment", "updated_at", *ties)]
    newest = history.groupBy("experiment").agg(
        F.max(F.struct("updated_at", *ties, *rest)).alias("_row")
    )
    return newest.select("experiment", *[F.col(f"_row.{c}").alias(c) for c in ("updated_at", *ties, *rest)])


def latest_version_per_stage(history: DataFrame) -> DataFrame:
    """The newest version per (model, stage) of a version history."""
    ranked = top_n(history, ["model", "stage"], [F.desc("updated_at"), F.desc("version")], 1, "_n")
    return ranked.drop("_n")


def rollback_target(history: DataFrame) -> DataFrame:
    """The newest archived version per model."""
    return latest_version_per_stage(history).filter(F.col("stage") == "Archived")
