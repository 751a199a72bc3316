"""Data-quality checks; each one returns rows ``check, violations, passed``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.operators.interactions import split_violations
from ranklight.schemas import INTERACTION_COLUMNS

# The accepted time range, 1996-01-01 00:00:00 to 2026-12-31 23:59:59
# UTC in milliseconds, and the magnitudes that tell the time unit.
TIME_RANGE_MS = (820454400000, 1798761599000)
SYNTHETIC_BELOW = 1_000_000_000
MILLISECONDS_ABOVE = 1_000_000_000_000
RATING_MIN = 1
RATING_MAX = 5


def _check(name: Column | str, violations: Column, passed: Column | None = None) -> list[Column]:
    label = F.lit(name) if isinstance(name, str) else name
    count = F.coalesce(violations, F.lit(0)).cast("bigint")
    return [
        label.alias("check"),
        count.alias("violations"),
        (count == 0 if passed is None else passed).alias("passed"),
    ]


def _blank(column: str) -> Column:
    return F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) == ""


def required_columns(df: DataFrame) -> DataFrame:
    """Required columns that the table lacks, or that hold no value in any of its rows."""
    there = [c for c in INTERACTION_COLUMNS if c in df.columns]
    missing = len(INTERACTION_COLUMNS) - len(there)
    filled = [F.count(c).alias(c) for c in there]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *filled)
    empty = [((F.col("_rows") > 0) & (F.col(c) == 0)).cast("bigint") for c in there]
    return counted.select(*_check("required_columns", sum(empty, F.lit(missing).cast("bigint"))))


def nulls(df: DataFrame) -> DataFrame:
    """One row per required column, counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in INTERACTION_COLUMNS])
    long = counted.unpivot([], INTERACTION_COLUMNS, "column", "n")
    return long.select(*_check(F.concat(F.lit("null_"), F.col("column")), F.col("n")))


def _rating_outside() -> Column:
    return F.count_if((F.col("rating") < RATING_MIN) | (F.col("rating") > RATING_MAX))


def rating_range(df: DataFrame) -> DataFrame:
    return df.agg(_rating_outside().alias("n")).select(*_check("rating_range", F.col("n")))


def duplicate_pairs(df: DataFrame) -> DataFrame:
    pairs = df.groupBy("user_id", "item_id").agg((F.count(F.lit(1)) - 1).alias("surplus"))
    return pairs.agg(F.sum("surplus").alias("n")).select(*_check("duplicate_pairs", F.col("n")))


def _outside(low: int, high: int) -> Column:
    return F.count_if((F.col("timestamp") < low) | (F.col("timestamp") > high))


def _time_measures(range_ms: tuple[int, int]) -> list[Column]:
    low, high = range_ms
    return [
        F.max("timestamp").alias("_latest"),
        _outside(low, high).alias("_as_ms"),
        _outside(low // 1000, high // 1000).alias("_as_s"),
    ]


def _time_outside() -> Column:
    return (
        F.when(F.col("_latest") < SYNTHETIC_BELOW, F.lit(0))
        .when(F.col("_latest") > MILLISECONDS_ABOVE, F.col("_as_ms"))
        .otherwise(F.col("_as_s"))
    )


def timestamp_range(df: DataFrame, range_ms: tuple[int, int] = TIME_RANGE_MS) -> DataFrame:
    """The unit is told from the largest value; both readings are counted in one pass."""
    return df.agg(*_time_measures(range_ms)).select(*_check("timestamp_range", _time_outside()))


def pair_overlap(train: DataFrame, test: DataFrame) -> DataFrame:
    keys = ["user_id", "item_id"]
    both = train.select(*keys).distinct().join(test.select(*keys).distinct(), keys, "left_semi")
    return both.agg(F.count(F.lit(1)).alias("n")).select(*_check("pair_overlap", F.col("n")))


def time_leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    bad = split_violations(train, test)
    return bad.agg(F.count(F.lit(1)).alias("n")).select(*_check("time_leakage", F.col("n")))


def item_key(metadata: DataFrame) -> DataFrame:
    if "item_id" not in metadata.columns:
        return metadata.sparkSession.range(1).select(*_check("item_key", F.lit(1)))
    n = F.count_if(F.col("item_id").isNull())
    return metadata.agg(n.alias("n")).select(*_check("item_key", F.col("n")))


def empty_titles(metadata: DataFrame) -> DataFrame:
    """Counts only: empty titles are a warning, never a failure."""
    if "title" not in metadata.columns:
        return metadata.sparkSession.range(1).select(
            *_check("empty_titles", F.lit(0), F.lit(True))
        )
    n = F.count_if(_blank("title"))
    return metadata.agg(n.alias("n")).select(*_check("empty_titles", F.col("n"), F.lit(True)))


def category(metadata: DataFrame) -> DataFrame:
    """Null or blank categories; without the column the check passes."""
    if "main_category" not in metadata.columns:
        return metadata.sparkSession.range(1).select(*_check("category", F.lit(0)))
    n = F.count_if(_blank("main_category"))
    return metadata.agg(n.alias("n")).select(*_check("category", F.col("n")))


def category_cardinality(metadata: DataFrame) -> DataFrame:
    return metadata.select("main_category").distinct().agg(
        F.count("main_category").alias("categories")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows(wide: DataFrame, checks: list[list[Column]]) -> DataFrame:
    """Several checks measured in one aggregate row, as rows."""
    return wide.select(F.inline(F.array(*[F.struct(*c) for c in checks])))


def check_reviews(df: DataFrame, range_ms: tuple[int, int] = TIME_RANGE_MS) -> DataFrame:
    """All review checks: one pass for the row-wise ones, one grouping for repeated pairs."""
    if set(INTERACTION_COLUMNS) - set(df.columns):
        return required_columns(df)
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in INTERACTION_COLUMNS],
        _rating_outside().alias("_rating"),
        *_time_measures(range_ms),
    )
    checks = [_check("required_columns", F.lit(0))]
    checks += [_check(f"null_{c}", F.col(f"_null_{c}")) for c in INTERACTION_COLUMNS]
    checks += [
        _check("rating_range", F.col("_rating")),
        _check("timestamp_range", _time_outside()),
    ]
    return _rows(wide, checks).unionByName(duplicate_pairs(df))


def check_metadata(metadata: DataFrame) -> DataFrame:
    """All metadata checks in one pass."""
    if "item_id" not in metadata.columns:
        return item_key(metadata)
    present = set(metadata.columns)
    wide = metadata.agg(
        F.count_if(F.col("item_id").isNull()).alias("_key"),
        (F.count_if(_blank("title")) if "title" in present else F.lit(0)).alias("_titles"),
        (F.count_if(_blank("main_category")) if "main_category" in present else F.lit(0)).alias("_category"),
    )
    return _rows(
        wide,
        [
            _check("item_key", F.col("_key")),
            _check("empty_titles", F.col("_titles"), F.lit(True)),
            _check("category", F.col("_category")),
        ],
    )


def check_leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    return _union([pair_overlap(train, test), time_leakage(train, test)])


def assert_passed(checks: DataFrame, what: str) -> None:
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        names = ", ".join(f"{r['check']} ({r['violations']})" for r in failed)
        raise ValueError(f"{what}: {names}")
