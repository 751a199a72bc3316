"""The preparation job: raw tables to validated, time-split training data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ranklight.operators import interactions as prep
from ranklight.operators import quality
from ranklight.session import settle
from ranklight.sources.tables import write_splits

MIN_INTERACTIONS = 10
TEST_RATIO = 0.2


def clean_interactions(
    reviews: DataFrame,
    metadata: DataFrame | None = None,
    min_interactions: int = MIN_INTERACTIONS,
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    if metadata is not None:
        reviews, _ = prep.align_catalog(reviews, metadata)
    return prep.preprocess(reviews, min_interactions, order)


def prepare_interactions(
    reviews: DataFrame,
    metadata: DataFrame,
    folder: str | None = None,
    min_interactions: int = MIN_INTERACTIONS,
    test_ratio: float = TEST_RATIO,
    order: Sequence[str] = ("timestamp",),
    range_ms: tuple[int, int] = quality.TIME_RANGE_MS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Align, clean, check, split, check again, and write the three tables if asked.

    The aligned metadata, the cleaned and the split table are each written once: the checks and the sinks
    read them instead of running the preparation again.
    """
    reviews, metadata = prep.align_catalog(reviews, metadata)
    metadata = settle(metadata, "metadata")
    clean = settle(prep.preprocess(reviews, min_interactions, order), "clean")
    quality.assert_passed(quality.check_reviews(clean, range_ms), "review checks failed")
    quality.assert_passed(quality.check_metadata(metadata), "metadata checks failed")

    split = settle(prep.temporal_split(clean, test_ratio), "split")
    train, test = prep.split_sides(split)
    quality.assert_passed(quality.check_leakage(train, test), "leakage checks failed")
    if folder:
        write_splits(train, test, metadata, folder)
    return train, test, metadata
