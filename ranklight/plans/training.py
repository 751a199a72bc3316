"""Training jobs: fit, evaluate, compare, collect metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.text import product_text
from ranklight.functions.vectors import dot
from ranklight.operators import features as feat
from ranklight.operators.blocks import best_products
from ranklight.operators.collaborative import (
    SEARCH_GRID,
    CollaborativeModel,
    als_fit,
    als_score_pairs,
    popular_for,
    recommend,
    search_settings,
    users_with_candidates,
)
from ranklight.operators.evaluate import (
    CUTOFFS,
    auc_roc,
    cold_start_parts,
    cold_start_segments,
    compare_metric_sets,
    evaluate_topn,
    log_loss,
    metric_names,
    rmse,
    to_long,
    user_metrics,
)
from ranklight.operators.factorise import fit_settings
from ranklight.operators.ranker import ClickModel, ctr_fit, ctr_predict
from ranklight.operators.similarity import neighbour_table, restrict_to_train_items, semantic_top_n
from ranklight.operators.text_space import text_space_vectors
from ranklight.plans.serving import two_stage_top_n
from ranklight.session import settle


def _labelled(metrics: DataFrame, run: str) -> DataFrame:
    return to_long(metrics).select(F.lit(run).alias("run_id"), "metric", "value")


def evaluate_collaborative(
    model: CollaborativeModel, test: DataFrame, ks: Sequence[int] = CUTOFFS
) -> DataFrame:
    """One row: list metrics over all test users and the error on the test ratings."""
    lists = recommend(model, test, max(ks))
    error = rmse(als_score_pairs(model, test)).scalar()
    return evaluate_topn(lists, test, ks).withColumn("rmse", error)


def evaluate_semantic(
    train: DataFrame,
    test: DataFrame,
    neighbours: DataFrame,
    ks: Sequence[int] = CUTOFFS,
) -> DataFrame:
    """List metrics of the semantic lists over all test users."""
    history = train.join(test.select("user_id").distinct(), "user_id", "left_semi")
    return evaluate_topn(semantic_top_n(history, neighbours, max(ks)), test, ks)


def cold_start_metrics(
    train: DataFrame,
    test: DataFrame,
    neighbours: DataFrame,
    ks: Sequence[int] = CUTOFFS,
) -> DataFrame:
    """Rows ``segment`` and the metrics for warm and for cold test items."""
    parts = dict(zip(("warm", "cold"), cold_start_parts(train, test)))
    rows = [
        evaluate_semantic(train, part, neighbours, ks).select(
            F.lit(name).alias("segment"), "*"
        )
        for name, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def evaluate_two_stage(
    model: CollaborativeModel,
    clicks: ClickModel,
    train: DataFrame,
    test: DataFrame,
    neighbours: DataFrame | None,
    user_table: DataFrame,
    item_table: DataFrame,
    ks: Sequence[int] = CUTOFFS,
) -> DataFrame:
    lists = two_stage_top_n(
        model, clicks, train, neighbours, user_table, item_table, max(ks), users=test
    )
    return evaluate_topn(lists, test, ks, prefix="pipeline_")


def evaluate_settings(
    users: DataFrame, items: DataFrame, train: DataFrame, test: DataFrame, ks: Sequence[int] = CUTOFFS
) -> DataFrame:
    """``run_id, metric, value`` of many models in one pass: list metrics and the rating error.

    ``users`` and ``items`` hold ``run_id``, the id and its vector; all models know the same
    users and items. Every number is that of ``evaluate_collaborative`` for the model alone.
    """
    names = [r["run_id"] for r in users.select("run_id").distinct().orderBy("run_id").collect()]
    rated = feat.drop_null_ratings(train)
    first = [t.filter(F.col("run_id") == names[0]).drop("run_id") for t in (users, items)]
    one = CollaborativeModel(*first, rated)
    asked = test.select("user_id").distinct()
    served = settle(users_with_candidates(one, asked), "served")
    runs = F.explode(F.lit(names)).alias("run_id")

    def keyed(rows: DataFrame, name: str, *columns) -> DataFrame:
        """Users of different runs are different users."""
        own = F.concat_ws("\t", "run_id", F.col("user_id").cast("string"))
        return rows.select(own.alias(name), *columns)

    n = max(ks)
    met = rated.select("user_id", "item_id").join(served, "user_id", "left_semi").select("*", runs)
    best = best_products(
        keyed(users.join(served, "user_id", "left_semi"), "id", "vector", "run_id"),
        items.select(F.col("item_id").alias("id"), "vector", "run_id"),
        n,
        seen=keyed(met, "query_id", "item_id", "run_id"),
        group="run_id",
        digits=None,
    )
    popular = popular_for(asked.join(served, "user_id", "left_anti"), rated, n).select("*", runs)
    lists = best.select(F.col("query_id").alias("user_id"), "item_id", "rank").unionByName(
        keyed(popular, "user_id", "item_id", "rank")
    )
    truth = keyed(test.select("user_id", "item_id", runs), "user_id", "item_id")
    per_user = user_metrics(settle(lists, "lists"), truth, ks)
    per_user = per_user.withColumn("run_id", F.substring_index("user_id", "\t", 1))
    listed = per_user.groupBy("run_id").agg(*[F.avg(m).alias(m) for m in metric_names(ks)])

    pairs = test.select("user_id", "item_id", "rating", runs)
    joined = pairs.join(users.withColumnRenamed("vector", "_u"), ["run_id", "user_id"], "left").join(
        items.withColumnRenamed("vector", "_i"), ["run_id", "item_id"], "left"
    )
    known = F.col("_u").isNotNull() & F.col("_i").isNotNull()
    score = F.when(known, dot(F.col("_u"), F.col("_i"))).otherwise(one.mean().scalar())
    gap = score - F.col("rating")
    errors = joined.groupBy("run_id").agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))
    wide = listed.join(errors, "run_id")
    return wide.unpivot(["run_id"], [*metric_names(ks), "rmse"], "metric", "value")


def als_grid_search(
    train: DataFrame, test: DataFrame, grid: Mapping[str, Sequence] = SEARCH_GRID, **fitting
) -> tuple[CollaborativeModel, DataFrame, str]:
    """Fit every setting in shared jobs; the first with the best NDCG@10 wins.

    Returns its model, the metric rows of all settings, and the winning run id. ``fitting`` goes
    to ``fit_settings``.
    """
    train, test = settle(train, "search-train"), settle(test, "search-test")
    settings = {f"als-{k:02d}": setting for k, setting in enumerate(search_settings(grid))}
    users, items = fit_settings(train, settings, **fitting)
    rows = settle(evaluate_settings(users, items, train, test), "search-metrics")
    scores = rows.filter(F.col("metric") == "ndcg_at_10")
    best = scores.orderBy(F.desc("value"), "run_id").first()["run_id"]
    tables = [t.filter(F.col("run_id") == best).drop("run_id") for t in (users, items)]
    return CollaborativeModel(*tables, feat.drop_null_ratings(train)), rows, best


def build_ctr_dataset(
    train: DataFrame,
    user_table: DataFrame,
    item_table: DataFrame,
    model: CollaborativeModel,
    neighbours: DataFrame | None,
    neg_ratio: int = 4,
    sample_users: int | None = None,
) -> DataFrame:
    pairs = feat.ctr_pairs(train, neg_ratio, sample_users)
    scored = als_score_pairs(model, pairs, "model_a_score")
    if neighbours is None:
        scored = scored.withColumn("model_b_score", F.lit(0.0))
    else:
        scored = feat.add_semantic_score(scored, feat.semantic_scores(train, neighbours))
    return feat.ctr_dataset(scored, user_table, item_table)


def train_click_model(
    dataset: DataFrame, **settings
) -> tuple[ClickModel, DataFrame, DataFrame]:
    """Fit on the stratified train part; return model, validation scores, metric row."""
    split = settle(
        feat.stratified_split(dataset, "label", ["user_id", "item_id"]), "ctr-dataset"
    )
    model = ctr_fit(split, **settings)
    held_out = split.filter(F.col("split") == "validation").drop("split")
    scored = settle(ctr_predict(model, held_out, "score"), "ctr-validation")
    metrics = auc_roc(scored).withColumn("log_loss", log_loss(scored).scalar())
    return model, scored, metrics


def item_text_vectors(metadata: DataFrame, dimensions: int = 128, **fitting) -> DataFrame:
    """``item_id, embedding`` of every item from its title, description and features."""
    items = feat.one_per_item(metadata)
    texts = items.select("item_id", product_text(items).alias("text"))
    return text_space_vectors(texts, "item_id", dimensions, **fitting)


def training_job(
    train: DataFrame,
    test: DataFrame,
    metadata: DataFrame | None = None,
    vectors: DataFrame | None = None,
    tuning: bool = False,
    train_semantic: bool = False,
    train_clicks: bool = False,
    als_settings: Mapping | None = None,
    click_settings: Mapping | None = None,
    click_users: int | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Metric rows ``run_id, metric, value`` of every model the flags ask for.

    ``click_users`` bounds the users whose labelled rows the click model learns from; every
    evaluation covers all test users. ``approximate`` chooses the item search by lists. Without
    ``vectors`` the semantic model takes those of the items' texts.
    """
    rows = []
    if tuning:
        model, searched, best = als_grid_search(train, test)
        metrics_a = searched.filter(F.col("run_id") == best).withColumn("run_id", F.lit("model_a"))
    else:
        model = als_fit(train, **(als_settings or {}))
        metrics_a = _labelled(evaluate_collaborative(model, test), "model_a")
    metrics_a = settle(metrics_a, "metrics-a")
    rows.append(metrics_a)

    neighbours = None
    if train_semantic and vectors is None and metadata is not None:
        vectors = settle(item_text_vectors(metadata), "text-vectors")
    if train_semantic and vectors is not None:
        known = restrict_to_train_items(vectors, train)
        neighbours = settle(neighbour_table(train, known, approximate=approximate), "neighbours")
        metrics_b = settle(
            _labelled(evaluate_semantic(train, test, neighbours), "model_b"), "metrics-b"
        )
        gap = compare_metric_sets(metrics_a, metrics_b).filter(F.col("diff_b_minus_a").isNotNull())
        cold = cold_start_segments(train, test).select(
            *[F.col(c).cast("double").alias(c) for c in cold_start_segments(train, test).columns]
        )
        rows += [
            metrics_b,
            gap.select(
                F.lit("model_b_minus_a").alias("run_id"), "metric", F.col("diff_b_minus_a").alias("value")
            ),
            _labelled(cold, "cold_start"),
        ]

    if train_clicks and metadata is not None:
        user_table = settle(feat.user_features(train), "user-features")
        item_table = settle(feat.item_features(train, metadata), "item-features")
        dataset = build_ctr_dataset(
            train, user_table, item_table, model, neighbours, sample_users=click_users
        )
        clicks, _, metrics_c = train_click_model(dataset, **(click_settings or {}))
        pipeline = evaluate_two_stage(
            model, clicks, train, test, neighbours, user_table, item_table
        )
        rows += [_labelled(metrics_c, "model_c"), _labelled(pipeline, "pipeline")]
    return reduce(DataFrame.unionByName, rows)
