import random

import pytest
from pyspark.sql import functions as F

from ranklight.operators import interactions as prep
from ranklight.operators import quality
from ranklight.plans.prepare import prepare_interactions


def _tuples(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_missing_column_is_an_error(ratings):
    with pytest.raises(ValueError, match="timestamp"):
        prep.project_core(ratings([("u", "i", 1.0, 1)]).drop("timestamp"))


def test_dedupe_keeps_the_last_row(ratings):
    rows = [("u1", f"i{i}", 3.0, i) for i in range(1, 7)] + [("u2", f"i{i}", 4.0, i) for i in range(1, 6)]
    df = ratings(rows + [("u1", "i1", 5.0, 99)])
    out = prep.dedupe_last(df)
    assert out.count() == 11
    assert ("u1", "i1", 5.0) in _tuples(out, "user_id", "item_id", "rating")


def test_short_users_are_dropped(ratings):
    df = ratings([("u1", f"i{i}", 4.0, i) for i in range(5)] + [("u2", "i0", 4.0, 0)])
    assert _tuples(prep.filter_min_users(df, 5), "user_id") == [("u1",)] * 5


def test_preprocess_is_one_pass(ratings):
    # u1 has three items, of which only one stays: the user is not checked again.
    rows = [("u1", f"i{i}", 4.0, i) for i in range(3)] + [("u2", "i0", 4.0, 0), ("u2", "i8", 4.0, 1), ("u2", "i9", 4.0, 2)]
    out = prep.preprocess(ratings(rows), 2)
    assert _tuples(out, "user_id", "item_id") == [("u1", "i0"), ("u2", "i0")]


def test_preprocess_ignores_rows_without_ids(ratings):
    rows = [("u1", "i1", 4.0, 1), ("u2", "i1", 4.0, 1), (None, "i1", 4.0, 1), ("u1", None, 4.0, 1)]
    assert prep.preprocess(ratings(rows), 1).count() == 2


def _expected_split(rows, ratio):
    sides = {}
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[3], r[1]))
        kept = max(1, int(len(mine) * (1 - ratio)))
        for n, row in enumerate(mine):
            sides[(user, row[1])] = "train" if n < kept else "test"
    return sides


@pytest.mark.parametrize("ratio", [0.2, 0.5, 0.29, 0.9])
def test_temporal_split_matches_brute_force(ratings, ratio):
    rng = random.Random(4)
    rows = [("hot", f"i{i}", 3.0, rng.randint(0, 40) * 43_200) for i in range(300)]
    rows += [(f"u{u}", f"i{i}", 3.0, rng.randint(0, 10) * 86_400) for u in range(30) for i in range(rng.randint(1, 9))]
    out = prep.temporal_split(ratings(rows), ratio)
    assert {(r["user_id"], r["item_id"]): r["split"] for r in out.collect()} == _expected_split(rows, ratio)
    train, test = prep.split_sides(out)
    prep.assert_split_integrity(train, test)


def test_single_interaction_stays_in_train(ratings):
    out = prep.temporal_split(ratings([("u1", "i1", 3.0, 1)]))
    assert [r["split"] for r in out.collect()] == ["train"]


def test_leaking_split_is_an_error(ratings):
    train = ratings([("u1", "a", 1.0, 100), ("u1", "b", 1.0, 200)])
    test = ratings([("u1", "c", 1.0, 50)])
    row = prep.split_integrity(train, test).first()
    assert (row["violations"], row["examples"]) == (1, "u1")
    with pytest.raises(ValueError, match="u1"):
        prep.assert_split_integrity(train, test)


def test_align_keeps_common_items(ratings, spark):
    reviews = ratings([("u", "a", 1.0, 1), ("u", "b", 1.0, 1)])
    metadata = spark.createDataFrame([("b",), ("c",), ("b",)], "item_id string")
    left, right = prep.align_catalog(reviews, metadata)
    assert _tuples(left, "item_id") == [("b",)]
    assert _tuples(right, "item_id") == [("b",), ("b",)]


def _passed(df):
    return {r["check"]: (r["violations"], r["passed"]) for r in df.collect()}


def test_review_checks(ratings):
    good = ratings([(f"u{u}", f"i{i}", 3.0, u * 5 + i) for u in range(2) for i in range(5)])
    assert all(passed for _, passed in _passed(quality.check_reviews(good)).values())
    bad = ratings([("u", "i", 6.0, 1), ("u", "i", None, 2)])
    found = _passed(quality.check_reviews(bad))
    assert found["rating_range"] == (1, False)
    assert found["duplicate_pairs"] == (1, False)
    assert found["null_rating"] == (1, False)
    assert _passed(quality.check_reviews(good.drop("rating"))) == {"required_columns": (1, False)}


@pytest.mark.parametrize(
    "times, violations",
    [
        ([820454400000, 1609459200000, 1798761599000], 0),
        ([100000000000, 820454400000], 2),
        ([0, 1, 2], 0),
        ([820454399, 1609459200], 1),
    ],
)
def test_timestamp_unit_is_inferred(ratings, times, violations):
    df = ratings([("u", f"i{n}", 3.0, t) for n, t in enumerate(times)])
    assert quality.timestamp_range(df).first()["violations"] == violations


def test_leakage_checks(ratings):
    train = ratings([("u1", "a", 3.0, 1), ("u1", "b", 3.0, 2)])
    clean, overlap = ratings([("u1", "c", 3.0, 3)]), ratings([("u1", "b", 3.0, 3)])
    assert all(p for _, p in _passed(quality.check_leakage(train, clean)).values())
    assert _passed(quality.check_leakage(train, overlap))["pair_overlap"] == (1, False)


def test_metadata_checks(spark):
    schema = "item_id string, title string, main_category string"
    good = spark.createDataFrame([("a", "A", "x"), ("b", "B", "y"), ("c", " ", "x")], schema)
    found = _passed(quality.check_metadata(good))
    assert found["empty_titles"] == (1, True) and found["category"] == (0, True)
    bad = spark.createDataFrame([("a", "A", " "), (None, "B", None)], schema)
    found = _passed(quality.check_metadata(bad))
    assert found["category"] == (2, False) and found["item_key"] == (1, False)
    assert quality.category_cardinality(good).first()["categories"] == 2
    assert _passed(quality.category(good.drop("main_category")))["category"] == (0, True)


def test_prepare_writes_and_checks(ratings, spark, tmp_path):
    rows = [(f"u{u}", f"i{i}", 1.0 + (u + i) % 5, u + 10 * i) for u in range(6) for i in range(6)]
    metadata = spark.createDataFrame(
        [(f"i{i}", f"T{i}", "x") for i in range(5)], "item_id string, title string, main_category string"
    )
    train, test, items = prepare_interactions(ratings(rows), metadata, str(tmp_path), min_interactions=5)
    assert (train.count(), test.count(), items.count()) == (24, 6, 5)
    assert spark.read.parquet(str(tmp_path / "train.parquet")).count() == 24
    with pytest.raises(ValueError, match="rating_range"):
        prepare_interactions(ratings([(u, i, 9.0, t) for u, i, _, t in rows]), metadata, min_interactions=5)


def test_days_of_seconds_and_milliseconds_never_fall(spark):
    times = [0, 86_399, 86_400, 99_999_999_999, 100_000_000_001, 1_700_000_000_000, 1_700_086_400_000]
    df = spark.createDataFrame([(t,) for t in times], "t long")
    days = [r["d"] for r in df.orderBy("t").select(prep.day_bucket(F.col("t")).alias("d")).collect()]
    assert days == sorted(days) and days[-1] == days[-2] + 1 and days[:3] == [0, 0, 1]


def test_filters_count_rows_without_time_or_rating(spark):
    kind = "user_id int, item_id int, rating double, timestamp long, line int, note string"
    holed = spark.createDataFrame([(u, i, None, None, i, "") for u in range(5) for i in range(5)], kind)
    found = prep.preprocess(holed, 5, ("line",))
    assert found.columns == ["user_id", "item_id", "rating", "timestamp"] and found.count() == 25
    assert prep.preprocess(holed, 6, ("line",)).count() == 0
