"""Interaction preparation: alignment, deduplication, frequency filters, time split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.operators.ordering import row_numbers
from ranklight.schemas import INTERACTION_COLUMNS, require_columns

SECONDS_PER_DAY = 86_400
# Larger times are milliseconds: as seconds they would lie in the year 5138.
_LARGEST_SECONDS = 100_000_000_000


def project_core(df: DataFrame) -> DataFrame:
    require_columns(df, INTERACTION_COLUMNS, "interactions")
    return df.select(*INTERACTION_COLUMNS)


def align_catalog(reviews: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the rows of both tables whose item is in both."""
    described = metadata.select("item_id").distinct()
    reviewed = reviews.select("item_id").distinct()
    return (
        reviews.join(described, "item_id", "left_semi"),
        metadata.join(reviewed, "item_id", "left_semi"),
    )


def _latest(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One struct per pair holding its last row; partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c not in ("user_id", "item_id", *order)]
    return df.groupBy("user_id", "item_id").agg(F.max(F.struct(*order, *rest)).alias("latest"))


def _unpack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    keys = ("user_id", "item_id")
    return df.select(*[F.col(c) if c in keys else F.col(f"latest.{c}").alias(c) for c in columns])


def dedupe_last(df: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Keep the last row per (user, item) by ``order``; further columns break ties."""
    return _unpack(_latest(df, order), df.columns)


def _filter_min(df: DataFrame, key: str, minimum: int, counted: str) -> DataFrame:
    # Counting a payload column keeps both branches on the same exchange.
    frequent = df.groupBy(key).agg(F.count(counted).alias("_n")).filter(F.col("_n") >= minimum)
    return df.join(frequent.select(key), key, "left_semi")


def filter_min_users(df: DataFrame, min_interactions: int = 5) -> DataFrame:
    frequent = df.groupBy("user_id").count().filter(F.col("count") >= min_interactions)
    return df.join(frequent.select("user_id"), "user_id", "left_semi")


def filter_min_items(df: DataFrame, min_interactions: int = 5) -> DataFrame:
    frequent = df.groupBy("item_id").count().filter(F.col("count") >= min_interactions)
    return df.join(frequent.select("item_id"), "item_id", "left_semi")


def preprocess(
    df: DataFrame, min_interactions: int = 5, order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """Deduplicate, then drop rare users, then rare items: one pass, not an iterated core.

    Rows without user or item are never frequent; dropping them first lets all counts
    read the same deduplicating exchange.
    """
    require_columns(df, INTERACTION_COLUMNS, "interactions")
    known = df.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    # Only the kept columns go through the filters; never null, but nullable, so that it is counted as it is.
    kept = F.struct(*[F.col(f"latest.{c}").alias(c) for c in INTERACTION_COLUMNS if c not in ("user_id", "item_id")])
    pairs = _latest(known, order).withColumn("latest", F.when(F.col("latest").isNotNull(), kept))
    pairs = _filter_min(pairs, "user_id", min_interactions, "latest")
    pairs = _filter_min(pairs, "item_id", min_interactions, "latest")
    return _unpack(pairs, INTERACTION_COLUMNS)


def day_bucket(time: Column) -> Column:
    """Days of a time in seconds or milliseconds; never falls as the number grows."""
    days = F.floor(time / SECONDS_PER_DAY)
    return F.when(
        time > _LARGEST_SECONDS, F.floor(time / (1000 * SECONDS_PER_DAY)) + 2_000_000
    ).otherwise(days)


def temporal_split(df: DataFrame, test_ratio: float = 0.2) -> DataFrame:
    """Add ``split``: the first share of each user's rows by time is train, the rest test.

    Users with one row stay in train. One task ranks one day of one user at a time,
    whether times are seconds or milliseconds.
    """
    placed = row_numbers(
        df,
        ["user_id"],
        day_bucket(F.col("timestamp")),
        ["timestamp", "item_id"],
        "_position",
        totals=True,
    )
    kept = F.greatest(F.lit(1), F.floor(F.col("_position_total") * F.lit(1.0 - test_ratio)))
    side = F.when(F.col("_position") <= kept, "train").otherwise("test")
    return placed.select(*df.columns, side.alias("split"))


def split_sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = df.filter(F.col("split") == "train").drop("split")
    test = df.filter(F.col("split") == "test").drop("split")
    return train, test


def split_violations(train: DataFrame, test: DataFrame) -> DataFrame:
    """Users whose last training row is later than their first test row."""
    last_train = train.groupBy("user_id").agg(F.max("timestamp").alias("train_max"))
    first_test = test.groupBy("user_id").agg(F.min("timestamp").alias("test_min"))
    return last_train.join(first_test, "user_id").filter(F.col("train_max") > F.col("test_min"))


def split_integrity(train: DataFrame, test: DataFrame, examples: int = 5) -> DataFrame:
    """One row: number of violating users and the first few of them by id."""
    bad = split_violations(train, test)
    first = bad.select("user_id").orderBy("user_id").limit(examples)
    listed = first.agg(F.sort_array(F.collect_list("user_id")).alias("ids"))
    names = F.array_join(listed.scalar().cast("array<string>"), ",")
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(
        "violations", names.alias("examples")
    )


def assert_split_integrity(train: DataFrame, test: DataFrame) -> None:
    row = split_integrity(train, test).first()
    if row["violations"]:
        raise ValueError(
            f"{row['violations']} users have test rows earlier than train rows, "
            f"for example {row['examples']}"
        )


def dataset_summary(clean: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row of sizes. Distinct counts go by pre-aggregated keys."""
    users = clean.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    items = clean.select("item_id").distinct()
    return users.agg(
        F.sum("n").alias("interactions"), F.count(F.lit(1)).alias("users")
    ).select(
        "interactions",
        "users",
        items.agg(F.count(F.lit(1))).scalar().alias("items"),
        train.agg(F.count(F.lit(1))).scalar().alias("train_rows"),
        test.agg(F.count(F.lit(1))).scalar().alias("test_rows"),
    )
