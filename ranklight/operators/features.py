"""Feature tables, ids and samples drawn from training interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.hashing import draw_bucket, draw_key
from ranklight.functions.text import description_length, price_number
from ranklight.operators.ordering import (
    dense_ids,
    exact_quantile,
    row_numbers,
    running_sums,
    top_n,
)

LIKED_RATING = 4.0
NOT_FEATURES = ("user_id", "item_id", "label")
_INDEX_BUCKET = 4096


def liked_items(train: DataFrame) -> DataFrame:
    """Rows rated at least four; of users without any, all their rows."""
    best = train.groupBy("user_id").agg(F.max("rating").alias("best"))
    unhappy = best.filter((F.col("best") < LIKED_RATING) | F.col("best").isNull())
    all_rows = train.join(unhappy.select("user_id"), "user_id", "left_semi")
    return train.filter(F.col("rating") >= LIKED_RATING).unionByName(all_rows)


def drop_null_ratings(train: DataFrame) -> DataFrame:
    return train.dropna(subset=["rating"])


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def select_features(df: DataFrame, columns: Sequence[str], absent: str = "error") -> DataFrame:
    """Ids, label and the model's columns in its order.

    ``absent='error'`` refuses a table without some feature; ``'zero'`` adds it as 0.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing and absent == "error":
        raise ValueError(f"missing feature columns: {sorted(missing)}")
    ids = [c for c in NOT_FEATURES if c in df.columns]
    return df.select(*ids, *[F.lit(0.0).alias(c) if c in missing else F.col(c) for c in columns])


def fill_missing(df: DataFrame) -> DataFrame:
    return df.na.fill(0.0)


def user_features(train: DataFrame, ticks_per_day: int = 86_400) -> DataFrame:
    span = (F.max("timestamp") - F.min("timestamp")) / F.lit(float(ticks_per_day))
    return train.groupBy("user_id").agg(
        F.count("rating").alias("num_ratings"),
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("avg_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.coalesce(span, F.lit(0.0)).alias("days_active"),
    )


def one_per_item(metadata: DataFrame) -> DataFrame:
    """One metadata row per item: the greatest row when an item repeats."""
    rest = [c for c in metadata.columns if c != "item_id"]
    best = metadata.groupBy("item_id").agg(F.max(F.struct(*rest)).alias("row"))
    return best.select("item_id", *[F.col(f"row.{c}").alias(c) for c in rest])


def item_features(train: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rating statistics joined with price (missing: exact median) and description length."""
    rated = train.groupBy("item_id").agg(
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("avg_rating_received"),
        F.count("rating").alias("num_ratings_received"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std_received"),
    )
    unique = one_per_item(metadata)
    described = unique.select(
        "item_id",
        price_number(unique).alias("price"),
        description_length(unique).alias("description_length"),
    )
    joined = rated.join(described, "item_id", "left")
    median = exact_quantile(joined, "price", 0.5).scalar()
    return joined.withColumns(
        {
            "price": F.coalesce("price", median, F.lit(0.0)),
            "description_length": F.coalesce("description_length", F.lit(0)),
        }
    )


def global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg("rating").alias("global_mean"))


def item_popularity(train: DataFrame) -> DataFrame:
    return train.groupBy("item_id").agg(F.count(F.lit(1)).alias("interactions"))


def popular_items(train: DataFrame, n: int) -> DataFrame:
    """The n most frequent items with their rank; ties by item id."""
    first = item_popularity(train).orderBy(F.desc("interactions"), "item_id").limit(n)
    return top_n(first, [], [F.desc("interactions"), "item_id"], n)


def id_maps(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dense integer ids: (user_id, user_index) and (item_id, item_index)."""
    return dense_ids(train, "user_id", "user_index"), dense_ids(train, "item_id", "item_index")


def confidence_matrix(train: DataFrame, alpha: float = 40.0) -> DataFrame:
    return train.groupBy("user_id", "item_id").agg(
        (F.sum("rating") * F.lit(float(alpha))).alias("confidence")
    )


def semantic_scores(
    train: DataFrame, neighbours: DataFrame, first_liked: int | None = None
) -> DataFrame:
    """Per (user, item): mean similarity to the user's liked items that list the item.

    ``neighbours`` holds the top 20 rows ``item_id, neighbour_id, similarity`` per item.
    All liked items count; ``first_liked`` keeps only that many of a user's earliest.
    """
    liked = liked_items(train)
    if first_liked is not None:
        liked = top_n(liked, ["user_id"], ["timestamp", "item_id"], first_liked)
    found = liked.select("user_id", "item_id").join(neighbours, "item_id")
    return found.groupBy("user_id", F.col("neighbour_id").alias("item_id")).agg(
        F.avg("similarity").alias("model_b_score")
    )


def add_semantic_score(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    joined = pairs.join(scores, ["user_id", "item_id"], "left")
    return joined.withColumn("model_b_score", F.coalesce("model_b_score", F.lit(0.0)))


def sample_users(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Up to n distinct users, uniformly and reproducibly."""
    users = df.select("user_id").distinct()
    return users.orderBy(draw_key(seed, F.col("user_id")), "user_id").limit(n)


def negative_samples(
    train: DataFrame, neg_ratio: int = 4, seed: int = 42, users: DataFrame | None = None
) -> DataFrame:
    """Per liked pair: ``neg_ratio`` items the user never met, without repetition.

    Rows ``user_id, positive_id, slot, item_id``. A draw picks a position in the
    user's unseen list; the position is turned into an item by counting the seen
    items before it, so nothing is rejected and no unseen list is ever built.
    """
    catalogue = dense_ids(train, "item_id", "_index")
    pairs = train.select("user_id", "item_id", "rating")
    if users is not None:
        pairs = pairs.join(users.select("user_id").distinct(), "user_id", "left_semi")
    met = pairs.select("user_id", "item_id").distinct()
    seen = met.join(catalogue, "item_id").select(
        "user_id", F.col("_index").cast("bigint").alias("_index")
    )

    ranked = row_numbers(
        seen, ["user_id"], F.floor(F.col("_index") / _INDEX_BUCKET), ["_index"], "_position"
    )
    gaps = (
        ranked.groupBy("user_id", (F.col("_index") - F.col("_position") + 1).alias("value"))
        .agg(F.count(F.lit(1)).alias("seen_here"))
        .select(
            "user_id",
            "value",
            "seen_here",
            F.lit(None).cast(train.schema["item_id"].dataType).alias("positive_id"),
            F.lit(-1).alias("slot"),
        )
    )

    total = catalogue.agg(F.count(F.lit(1))).scalar()
    free = met.groupBy("user_id").agg(F.count(F.lit(1)).alias("_seen"))
    liked = pairs.filter(F.col("rating") >= LIKED_RATING).select("user_id", "item_id").distinct()
    liked = liked.join(free, "user_id").withColumn("_free", total - F.col("_seen"))
    names = [f"_draw{slot}" for slot in range(neg_ratio)]
    for slot, name in enumerate(names):
        liked = liked.withColumn(name, _draw(slot, names[:slot], seed))
    draws = liked.select(
        "user_id",
        F.col("item_id").alias("positive_id"),
        "_free",
        F.posexplode(F.array(*names)).alias("slot", "value"),
    ).filter(F.col("slot") < F.col("_free"))

    both = draws.select("user_id", "value", F.lit(0).alias("seen_here"), "positive_id", "slot")
    both = both.unionByName(gaps.select(*both.columns))
    counted = running_sums(
        both,
        ["user_id"],
        F.floor(F.col("value") / _INDEX_BUCKET),
        ["value", F.asc("slot"), "positive_id"],
        {"_before": F.col("seen_here")},
    )
    chosen = counted.filter(F.col("slot") >= 0).select(
        "user_id", "positive_id", "slot", (F.col("value") + F.col("_before")).alias("_index")
    )
    return chosen.join(catalogue, "_index").select("user_id", "positive_id", "slot", "item_id")


def _draw(slot: int, earlier: Sequence[str], seed: int) -> Column:
    """The slot's number in 0 .. free-1-slot, moved over the earlier draws in ascending order."""
    text = draw_key(seed, F.col("user_id"), F.col("item_id"), F.lit(slot))
    number = F.conv(F.substring(text, 1, 15), 16, 10).cast("bigint")
    start = number % F.greatest(F.col("_free") - slot, F.lit(1))
    if not earlier:
        return start
    taken = F.array_sort(F.array(*earlier))
    return F.aggregate(taken, start, lambda x, d: x + (x >= d).cast("bigint"))


def positive_pairs(train: DataFrame, users: DataFrame | None = None) -> DataFrame:
    liked = train.filter(F.col("rating") >= LIKED_RATING).select("user_id", "item_id").distinct()
    if users is not None:
        liked = liked.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return liked


def ctr_pairs(
    train: DataFrame, neg_ratio: int = 4, sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Labelled pairs: liked pairs as 1 and their drawn negatives as 0."""
    users = sample_users(positive_pairs(train), sample, seed) if sample else None
    positives = positive_pairs(train, users).withColumn("label", F.lit(1))
    negatives = negative_samples(train, neg_ratio, seed, users)
    return positives.unionByName(
        negatives.select("user_id", "item_id", F.lit(0).alias("label"))
    )


def ctr_dataset(
    scored_pairs: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """Join the feature tables to pairs that carry label and retrieval scores; null to 0."""
    return fill_missing(scored_pairs.join(users, "user_id", "left").join(items, "item_id", "left"))


def class_balance(dataset: DataFrame) -> DataFrame:
    counted = dataset.agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
    )
    ratio = F.try_divide(F.col("negatives").cast("double"), F.col("positives"))
    return counted.withColumn("ratio", ratio)


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: per label the first ceil(share * n) rows in hash order are validation.

    Rows are ranked within evenly filled hash buckets, so one label may hold most rows.
    """
    keyed = df.withColumn("_draw", draw_key(seed, *[F.col(k) for k in keys]))
    ranked = row_numbers(
        keyed, [label], draw_bucket(F.col("_draw")), ["_draw", *keys], "_position", totals=True
    )
    wanted = F.ceil(F.col("_position_total") * F.lit(float(test_share)))
    side = F.when(F.col("_position") <= wanted, "validation").otherwise("train")
    return ranked.select(*df.columns, side.alias("split"))
