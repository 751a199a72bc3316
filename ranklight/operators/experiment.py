"""Variant assignment, conversion by variant, significance and sample size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklight.functions.hashing import hash_percent
from ranklight.functions.stats import sample_size, two_proportion_z, two_sided_p

MODES = ("shadow", "canary", "ab_test")
CANARY_SHARE = 0.05
DEFAULT_SPLIT = 0.5
SIGNIFICANCE = 0.05


def assign_variant(user_id: Column, split_ratio: float) -> Column:
    """``B`` for hash buckets below the split, else ``A``; the same user always gets the same."""
    return F.when(hash_percent(user_id) < int(split_ratio * 100), "B").otherwise("A")


def route_traffic(
    requests: DataFrame, mode: str = "ab_test", split_ratio: float | None = None
) -> DataFrame:
    """Add ``serving_variant`` and ``shadow_variant``; works on batches and streams alike."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    if mode == "shadow":
        serving, shadow = F.lit("A"), F.lit("B")
    else:
        share = CANARY_SHARE if mode == "canary" else (split_ratio or DEFAULT_SPLIT)
        serving, shadow = assign_variant(F.col("user_id"), share), F.lit(None).cast("string")
    return requests.withColumns({"serving_variant": serving, "shadow_variant": shadow})


def logged_variants(routed: DataFrame) -> DataFrame:
    """One row per variant that is run for a request: the served one and any shadow."""
    both = F.array_compact(F.array("serving_variant", "shadow_variant"))
    return routed.withColumn("variant", F.explode(both))


def variant_share(assigned: DataFrame, variant: str = "variant") -> DataFrame:
    counts = assigned.groupBy(F.col(variant).alias("variant")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(W.partitionBy())
    return counts.withColumn("share", F.col("n") / whole)


def ab_conversion(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Clicks per variant when feedback is joined to predictions on the user alone.

    Every click meets every prediction of its user. Both sides are counted per user
    first, which gives the same number without producing the pairs.
    """
    served = predictions.groupBy("user_id", "variant").agg(F.count(F.lit(1)).alias("_n"))
    clicked = feedback.filter(F.col("action") == "click").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_clicks")
    )
    joined = served.filter(F.col("variant").isNotNull()).join(clicked, "user_id", "left")
    table = joined.groupBy("variant").agg(
        F.sum("_n").alias("n"),
        F.coalesce(F.sum(F.col("_n") * F.col("_clicks")), F.lit(0)).alias("clicks"),
    )
    return table.withColumn("conversion_rate", _rate(F.col("clicks"), F.col("n")))


def _rate(clicks: Column, n: Column) -> Column:
    return F.try_divide(clicks.cast("double"), n)


def attribute_feedback(
    predictions: DataFrame, feedback: DataFrame, bucket_seconds: int = 3600
) -> DataFrame:
    """Give each feedback row the user's latest prediction not later than it.

    Adds ``variant`` and ``predicted_at``, null without an earlier prediction. The
    search runs inside (user, time bucket); what a bucket inherits from earlier ones is
    one row per bucket, so a user with a large share of the log is spread over tasks.
    """
    columns = feedback.columns
    served = predictions.filter(F.col("timestamp").isNotNull()).select(
        "user_id",
        F.col("timestamp").alias("_at"),
        F.struct(F.col("timestamp").alias("at"), "variant").alias("_served"),
    )
    events = served.withColumn("_row", F.lit(None)).unionByName(
        feedback.select(
            "user_id",
            F.col("timestamp").alias("_at"),
            F.lit(None).alias("_served"),
            F.struct(*columns).alias("_row"),
        )
    )
    events = events.withColumn("_bucket", F.floor(F.unix_seconds("_at") / bucket_seconds))

    newest = events.groupBy("user_id", "_bucket").agg(F.max("_served").alias("_newest"))
    earlier = W.partitionBy("user_id").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    inherited = newest.select(
        "user_id", "_bucket", F.last("_newest", ignorenulls=True).over(earlier).alias("_inherited")
    )
    # At equal times a prediction sorts before the feedback it caused.
    local = (
        W.partitionBy("user_id", "_bucket")
        .orderBy("_at", F.col("_row").isNotNull(), "_served")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    found = events.withColumn("_own", F.last("_served", ignorenulls=True).over(local))
    rows = found.filter(F.col("_row").isNotNull()).join(inherited, ["user_id", "_bucket"])
    source = F.coalesce("_own", "_inherited")
    return rows.select(
        *[F.col(f"_row.{c}").alias(c) for c in columns],
        source["variant"].alias("variant"),
        source["at"].alias("predicted_at"),
    )


def ab_conversion_attributed(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Conversion where every click counts once; clicks nobody caused form a null-variant row."""
    clicks = attribute_feedback(predictions, feedback.filter(F.col("action") == "click"))
    counted = clicks.groupBy("variant").agg(F.count(F.lit(1)).alias("clicks"))
    shown = predictions.groupBy("variant").agg(F.count(F.lit(1)).alias("n"))
    both = shown.withColumn("clicks", F.lit(0)).unionByName(counted.withColumn("n", F.lit(0)))
    table = both.groupBy("variant").agg(F.sum("n").alias("n"), F.sum("clicks").alias("clicks"))
    return table.withColumn("conversion_rate", _rate(F.col("clicks"), F.col("n")))


def two_proportion_test(segments: DataFrame) -> DataFrame:
    """Add ``z`` and two-sided ``p`` (4 decimals) to rows with clicks and n of A and B."""
    z = two_proportion_z(*[F.col(c) for c in ("clicks_a", "n_a", "clicks_b", "n_b")])
    exact = segments.withColumn("_z", z)
    return exact.withColumns(
        {"z": F.round("_z", 4), "p": F.round(two_sided_p(F.col("_z")), 4)}
    ).drop("_z")


def experiment_readout(conversion: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Set variants A and B side by side (per key) with test, significance and lift."""

    def of(variant: str, column: str) -> Column:
        value = F.sum(F.when(F.col("variant") == variant, F.col(column)))
        return F.coalesce(value, F.lit(0)).alias(f"{column}_{variant.lower()}")

    sides = conversion.groupBy(*keys).agg(
        of("A", "clicks"), of("A", "n"), of("B", "clicks"), of("B", "n")
    )
    tested = two_proportion_test(sides)
    rate_a = F.col("clicks_a") / F.greatest(F.col("n_a"), F.lit(1))
    rate_b = F.col("clicks_b") / F.greatest(F.col("n_b"), F.lit(1))
    lift = (rate_b - rate_a) / F.greatest(rate_a, F.lit(1e-9))
    return tested.withColumns({"significant": F.col("p") < SIGNIFICANCE, "lift": lift})


def needed_samples(
    segments: DataFrame, base: str = "base_rate", effect: str = "effect",
    alpha: float = 0.05, power: float = 0.80,
) -> DataFrame:
    return segments.withColumn(
        "needed_per_variant", sample_size(F.col(base), F.col(effect), alpha, power)
    )
