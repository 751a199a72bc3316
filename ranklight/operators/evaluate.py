"""Ranking metrics over all test users in one pass, and score metrics over pairs.

Lists: ``recs(user_id, item_id, rank)`` with 1-based ranks. Truth:
``relevant(user_id, item_id)``; repeated rows count towards the list length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.operators.ordering import add_range, running_sums

CUTOFFS = (5, 10, 20)
_CLIP = 1e-15


def _gain(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + 1.0)


def _ideal_gain(found: Column, k: int) -> Column:
    """Best possible gain for ``found`` relevant rows, looked up among k running totals."""
    totals, acc = [], 0.0
    for rank in range(1, k + 1):
        acc += 1.0 / math.log2(rank + 1)
        totals.append(F.lit(acc))
    return F.get(F.array(*totals), (F.least(found, F.lit(k)) - 1).cast("int"))


def user_metrics(recs: DataFrame, relevant: DataFrame, ks: Sequence[int] = CUTOFFS) -> DataFrame:
    """Per test user: precision, recall and NDCG at each k, and the reciprocal rank."""
    wanted = relevant.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("_copies"))
    sizes = wanted.groupBy("user_id").agg(F.sum("_copies").alias("_relevant"))
    hits = recs.join(wanted.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
    aggregates = [F.min("rank").alias("_first")]
    for k in ks:
        inside = F.col("rank") <= k
        aggregates.append(F.count_if(inside).alias(f"_hits_{k}"))
        aggregates.append(F.sum(F.when(inside, _gain(F.col("rank")))).alias(f"_gain_{k}"))
    scored = sizes.join(hits.groupBy("user_id").agg(*aggregates), "user_id", "left")

    columns = []
    for k in ks:
        found = F.coalesce(f"_hits_{k}", F.lit(0)).cast("double")
        gain = F.coalesce(f"_gain_{k}", F.lit(0.0))
        precision = found / k if k else F.lit(0.0)
        ideal = _ideal_gain(F.col("_relevant"), k) if k else F.lit(None).cast("double")
        columns.append(precision.alias(f"precision_at_{k}"))
        columns.append((found / F.col("_relevant")).alias(f"recall_at_{k}"))
        columns.append(F.coalesce(F.try_divide(gain, ideal), F.lit(0.0)).alias(f"ndcg_at_{k}"))
    reciprocal = F.coalesce(F.lit(1.0) / F.col("_first"), F.lit(0.0))
    return scored.select("user_id", *columns, reciprocal.alias("reciprocal_rank"))


def metric_names(ks: Sequence[int] = CUTOFFS) -> list[str]:
    return [f"{m}_at_{k}" for m in ("precision", "recall", "ndcg") for k in ks]


def evaluate_topn(
    recs: DataFrame, relevant: DataFrame, ks: Sequence[int] = CUTOFFS, prefix: str = ""
) -> DataFrame:
    """One row: each metric averaged over the test users; no users gives 0."""
    per_user = user_metrics(recs, relevant, ks)
    return per_user.agg(
        *[F.coalesce(F.avg(m), F.lit(0.0)).alias(f"{prefix}{m}") for m in metric_names(ks)]
    )


def precision_at_k(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    return user_metrics(recs, relevant, [k]).select("user_id", f"precision_at_{k}")


def recall_at_k(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    return user_metrics(recs, relevant, [k]).select("user_id", f"recall_at_{k}")


def ndcg_at_k(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    return user_metrics(recs, relevant, [k]).select("user_id", f"ndcg_at_{k}")


def mean_reciprocal_rank(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    per_user = user_metrics(recs, relevant, [])
    return per_user.agg(F.coalesce(F.avg("reciprocal_rank"), F.lit(0.0)).alias("mrr"))


def to_long(metrics: DataFrame) -> DataFrame:
    """One row per metric from a one-row metric table."""
    return metrics.unpivot([], metrics.columns, "metric", "value")


def rmse(scored: DataFrame, score: str = "score", rating: str = "rating") -> DataFrame:
    gap = F.col(score) - F.col(rating)
    return scored.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def auc_roc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the curve from counts per distinct score; ties count half."""
    counts = scored.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ranked = running_sums(
        add_range(counts, "_score"),
        [],
        F.col("_range"),
        ["_score"],
        {"_pos_seen": F.col("_pos"), "_neg_seen": F.col("_neg")},
        totals=True,
    )
    below = F.col("_neg_seen") - F.col("_neg")
    won = F.sum(F.col("_pos").cast("double") * (below + F.col("_neg") / 2.0))
    pairs = F.max(F.col("_pos_seen_total").cast("double") * F.col("_neg_seen_total"))
    return ranked.agg(F.try_divide(won, pairs).alias("auc_roc"))


def log_loss(scored: DataFrame, probability: str = "score", label: str = "label") -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(_CLIP)), F.lit(1 - _CLIP))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1.0 - p))
    return scored.agg(F.avg(loss).alias("log_loss"))


def compare_metric_sets(first: DataFrame, second: DataFrame) -> DataFrame:
    """Full outer comparison of two ``metric, value`` tables, sorted by name."""
    a = first.select("metric", F.col("value").alias("model_a"))
    b = second.select("metric", F.col("value").alias("model_b"))
    joined = a.join(b, "metric", "full")
    return joined.withColumn("diff_b_minus_a", F.col("model_b") - F.col("model_a")).orderBy("metric")


def cold_start_parts(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Test rows of items met in train (warm) and of items not met (cold)."""
    known = train.select("item_id").distinct()
    return test.join(known, "item_id", "left_semi"), test.join(known, "item_id", "left_anti")


def cold_start_segments(train: DataFrame, test: DataFrame) -> DataFrame:
    tested = test.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    known = train.select("item_id").distinct().withColumn("_warm", F.lit(1))
    marked = tested.join(known, "item_id", "left")
    cold, warm = F.col("_warm").isNull(), F.col("_warm").isNotNull()
    counted = marked.agg(
        F.count(F.lit(1)).alias("total_test_items"),
        F.count_if(cold).alias("cold_start_items"),
        F.count_if(warm).alias("warm_items"),
        F.coalesce(F.sum(F.when(cold, F.col("_n"))), F.lit(0)).alias("cold_start_interactions"),
        F.coalesce(F.sum(F.when(warm, F.col("_n"))), F.lit(0)).alias("warm_interactions"),
    )
    share = F.try_divide(F.col("cold_start_items").cast("double"), F.col("total_test_items"))
    return counted.withColumn("cold_start_ratio", F.coalesce(share, F.lit(0.0)))
