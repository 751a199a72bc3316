"""Implicit-feedback factorisation: fit, score pairs, top lists, cold start."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.vectors import dot
from ranklight.operators.alternating import fit_factors
from ranklight.operators.blocks import ROWS_PER_BLOCK, best_products
from ranklight.operators.bounded import best_products_bounded
from ranklight.operators.features import (
    confidence_matrix,
    drop_null_ratings,
    global_mean,
    id_maps,
    popular_items,
)
from ranklight.schemas import require_columns
from ranklight.session import discard, settle

REQUIRED = ("user_id", "item_id", "rating")

# The settings tried by the search.
SEARCH_GRID = {
    "n_factors": [50, 100, 200],
    "n_epochs": [15, 30],
    "regularization": [0.01, 0.1],
    "alpha": [20.0, 40.0, 80.0],
}


@dataclass(frozen=True)
class CollaborativeModel:
    """Factor tables by original id, and what the fallbacks need."""

    user_factors: DataFrame  # user_id, vector
    item_factors: DataFrame  # item_id, vector
    train: DataFrame  # user_id, item_id, rating

    def mean(self) -> DataFrame:
        return global_mean(self.train)


def als_fit(
    train: DataFrame,
    n_factors: int = 100,
    n_epochs: int = 20,
    regularization: float = 0.01,
    alpha: float = 40.0,
    seed: int = 42,
    ratings_per_block: int = 1_000_000,
) -> CollaborativeModel:
    """Factors of every user and item.

    ``ratings_per_block`` sets how many blocks each side is cut into, ten at least and two for
    each core; it changes the layout, not the model.
    """
    require_columns(train, REQUIRED, "training data")
    if not math.isfinite(alpha) or alpha <= 0:
        raise ValueError(f"alpha must be positive and finite, got {alpha}")
    rated = drop_null_ratings(train)
    count = rated.count()
    if not count:
        raise ValueError("no valid ratings to fit on")
    blocks = max(10, 2 * train.sparkSession.sparkContext.defaultParallelism, -(-count // ratings_per_block))

    users, items = id_maps(rated)
    users, items = settle(users, "user-ids"), settle(items, "item-ids")
    matrix = confidence_matrix(rated, 1.0).join(users, "user_id").join(items, "item_id")
    matrix = settle(matrix.select("user_index", "item_index", "confidence"), "rating-matrix")
    user_factors, item_factors = fit_factors(matrix, n_factors, n_epochs, regularization, alpha, seed, blocks)
    discard(matrix)

    def named(factors: DataFrame, ids: DataFrame, index: str, key: str) -> DataFrame:
        renamed = factors.select(F.col("id").alias(index), "vector")
        return settle(renamed.join(ids, index).select(key, "vector"), f"{key}-factors")

    return CollaborativeModel(
        named(user_factors, users, "user_index", "user_id"),
        named(item_factors, items, "item_index", "item_id"),
        rated,
    )


def als_score_pairs(model: CollaborativeModel, pairs: DataFrame, name: str = "score") -> DataFrame:
    """Add the factor product; pairs with an unknown user or item get the mean rating."""
    users = model.user_factors.withColumnRenamed("vector", "_u")
    items = model.item_factors.withColumnRenamed("vector", "_i")
    joined = pairs.join(users, "user_id", "left").join(items, "item_id", "left")
    known = F.col("_u").isNotNull() & F.col("_i").isNotNull()
    score = F.when(known, dot(F.col("_u"), F.col("_i"))).otherwise(model.mean().scalar())
    return joined.select(*pairs.columns, score.alias(name))


def als_top_n(
    model: CollaborativeModel,
    n: int = 10,
    exclude_seen: bool = True,
    users: DataFrame | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    bounded: bool = False,
) -> DataFrame:
    """Rows ``user_id, item_id, score, rank`` for all (or the given) known users at once.

    ``bounded`` skips items whose norm rules them out (see ``bounded``): the same rows in
    several jobs, for catalogues whose factors differ much in length.
    """
    if n <= 0:
        raise ValueError(f"n must be positive, got {n}")
    factors, seen = model.user_factors, model.train.select("user_id", "item_id")
    if users is not None:
        wanted = users.select("user_id").distinct()
        factors = factors.join(wanted, "user_id", "left_semi")
        seen = seen.join(wanted, "user_id", "left_semi")
    search = (lambda *a, **k: best_products_bounded(*a, **k).best) if bounded else best_products
    best = search(
        factors.select(F.col("user_id").alias("id"), "vector"),
        model.item_factors.select(F.col("item_id").alias("id"), "vector"),
        n,
        seen=seen.withColumnRenamed("user_id", "query_id") if exclude_seen else None,
        digits=None,
        rows_per_block=rows_per_block,
    )
    return best.withColumnRenamed("query_id", "user_id")


def cold_start_fallback(users: DataFrame, train: DataFrame, n: int = 10) -> DataFrame:
    """The n most popular items, scored by the mean rating, for users without training rows."""
    unknown = users.select("user_id").distinct().join(
        train.select("user_id").distinct(), "user_id", "left_anti"
    )
    return popular_for(unknown, train, n)


def popular_for(users: DataFrame, train: DataFrame, n: int) -> DataFrame:
    """The same n popular items for each user; the list travels as one value."""
    listed = popular_items(train, n).agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("items")
    )
    rows = users.withColumn("_items", listed.scalar())
    return rows.select("user_id", F.inline("_items")).select(
        "user_id", "item_id", global_mean(train).scalar().alias("score"), "rank"
    )


def users_with_candidates(model: CollaborativeModel, users: DataFrame) -> DataFrame:
    """The users whose unseen list is not empty: known ones that have not met every item."""
    total = model.item_factors.agg(F.count(F.lit(1))).scalar()
    met = model.train.select("user_id", "item_id").distinct()
    full = met.groupBy("user_id").agg(F.count(F.lit(1)).alias("_met")).filter(F.col("_met") >= total)
    known = users.join(model.user_factors.select("user_id"), "user_id", "left_semi")
    return known.join(full.select("user_id"), "user_id", "left_anti")


def recommend(model: CollaborativeModel, users: DataFrame, n: int = 10) -> DataFrame:
    """Unseen top n for every user; popular items where that list would be empty."""
    wanted = users.select("user_id").distinct()
    served = users_with_candidates(model, wanted)
    without = wanted.join(served, "user_id", "left_anti")
    return als_top_n(model, n, users=served).unionByName(popular_for(without, model.train, n))


def search_settings(grid: Mapping[str, Sequence] = SEARCH_GRID) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]
