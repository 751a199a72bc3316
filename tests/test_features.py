import random
import statistics

import pytest
from pyspark.sql import functions as F

from ranklight.functions import text
from ranklight.operators import features as feat


@pytest.fixture(scope="module")
def history(ratings):
    rng = random.Random(42)
    rows = []
    for u in range(10):
        for i in rng.sample(range(20), 5):
            rows.append((f"u{u}", f"i{i}", float(rng.randint(1, 5)), rng.randint(1000, 9998)))
    return ratings(rows)


def test_liked_items_fall_back_to_all(ratings):
    df = ratings([("u1", "a", 5.0, 1), ("u1", "b", 4.0, 2), ("u1", "c", 2.0, 3), ("u2", "a", 1.0, 1), ("u2", "b", 2.0, 1)])
    got = sorted((r["user_id"], r["item_id"]) for r in feat.liked_items(df).collect())
    assert got == [("u1", "a"), ("u1", "b"), ("u2", "a"), ("u2", "b")]


def test_user_features(history):
    rows = history.collect()
    for got in feat.user_features(history).collect():
        mine = [r for r in rows if r["user_id"] == got["user_id"]]
        assert got["num_ratings"] == len(mine)
        assert got["avg_rating"] == pytest.approx(statistics.mean(r["rating"] for r in mine))
        assert got["rating_std"] == pytest.approx(statistics.stdev(r["rating"] for r in mine))
        times = [r["timestamp"] for r in mine]
        assert got["days_active"] == pytest.approx((max(times) - min(times)) / 86400)


def test_single_rating_has_no_spread(ratings):
    row = feat.user_features(ratings([("u", "i", 3.0, 5)])).first()
    assert (row["rating_std"], row["days_active"]) == (0.0, 0.0)


def test_item_features_fill_the_median_price(spark, ratings):
    train = ratings([("u", i, 4.0, 1) for i in "abcd"])
    metadata = spark.createDataFrame(
        [("a", "10", ["x", None]), ("b", "n/a", []), ("c", "30.5", ["long", "text"]), ("a", "10", ["x", None]), ("z", "900", [])],
        "item_id string, price string, description array<string>",
    )
    got = {r["item_id"]: r for r in feat.item_features(train, metadata).collect()}
    assert {k: r["price"] for k, r in got.items()} == {"a": 10.0, "b": 20.25, "c": 30.5, "d": 20.25}
    assert {k: r["description_length"] for k, r in got.items()} == {"a": 6, "b": 0, "c": 9, "d": 0}


@pytest.mark.parametrize(
    "raw, price", [("12.5", 12.5), (" 3 ", 3.0), ("1e2", 100.0), ("$4", None), ("4d", None), ("", None), (None, None)]
)
def test_price(spark, raw, price):
    df = spark.createDataFrame([(raw,)], "price string")
    assert df.select(text.price_number(df)).first()[0] == price


def test_product_text(spark):
    df = spark.createDataFrame(
        [
            ("a", " Phone ", "good  ", ["5G", "", None, "OLED"]),
            ("b", None, None, None),
            ("c", "", " desc", []),
        ],
        "item_id string, title string, description string, features array<string>",
    )
    got = {r[0]: r[1] for r in df.select("item_id", text.product_text(df)).collect()}
    assert got == {"a": "Phone good 5G OLED", "b": "unknown product", "c": "desc"}


def test_negatives_are_unseen_distinct_and_complete(history):
    items = {r["item_id"] for r in history.select("item_id").distinct().collect()}
    seen = {}
    for r in history.collect():
        seen.setdefault(r["user_id"], set()).add(r["item_id"])
    drawn = {}
    for r in feat.negative_samples(history).collect():
        drawn.setdefault((r["user_id"], r["positive_id"]), []).append(r["item_id"])
    liked = {(r["user_id"], r["item_id"]) for r in history.filter("rating >= 4").collect()}
    assert set(drawn) == liked
    for (user, _), found in drawn.items():
        assert len(found) == len(set(found)) == min(4, len(items - seen[user]))
        assert not set(found) & seen[user]


def test_negatives_of_users_who_met_nearly_everything(ratings):
    rows = [("all", f"i{i}", 5.0, i) for i in range(30)] + [("most", f"i{i}", 5.0, i) for i in range(28)]
    drawn = {}
    for r in feat.negative_samples(ratings(rows)).collect():
        drawn.setdefault((r["user_id"], r["positive_id"]), set()).add(r["item_id"])
    assert all(user == "most" and found == {"i28", "i29"} for (user, _), found in drawn.items())
    assert len(drawn) == 28


def test_negative_draws_are_spread_evenly(ratings):
    rows = [(f"u{u}", f"i{u % 40}", 5.0, 1) for u in range(2000)]
    counts = feat.negative_samples(ratings(rows)).groupBy("item_id").count().collect()
    assert len(counts) == 40
    assert all(140 < r["count"] < 260 for r in counts)


def test_semantic_score_uses_the_first_liked_items(spark, ratings):
    train = ratings([("u", f"l{i}", 5.0, i) for i in range(6)])
    near = spark.createDataFrame(
        [("l0", "x", 0.8), ("l1", "x", 0.4), ("l5", "x", 0.0), ("l5", "y", 0.9)],
        "item_id string, neighbour_id string, similarity double",
    )
    pairs = spark.createDataFrame([("u", "x"), ("u", "y")], "user_id string, item_id string")
    out = feat.add_semantic_score(pairs, feat.semantic_scores(train, near, first_liked=5))
    got = {r["item_id"]: r["model_b_score"] for r in out.collect()}
    assert got == {"x": pytest.approx(0.6), "y": 0.0}
    every = feat.add_semantic_score(pairs, feat.semantic_scores(train, near))
    assert {r["item_id"]: r["model_b_score"] for r in every.collect()} == {"x": pytest.approx(0.4), "y": 0.9}


def test_select_features(spark):
    df = spark.createDataFrame([("u", 1.0)], "user_id string, a double")
    with pytest.raises(ValueError, match="b"):
        feat.select_features(df, ["a", "b"])
    assert feat.select_features(df, ["b", "a"], absent="zero").columns == ["user_id", "b", "a"]


def test_stratified_split_keeps_shares(spark):
    rows = [(f"u{i}", f"i{i}", int(i % 10 == 0)) for i in range(1003)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, label int")
    out = feat.stratified_split(df, "label", ["user_id", "item_id"])
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert counts == {(0, "validation"): 181, (0, "train"): 721, (1, "validation"): 21, (1, "train"): 80}


def test_sample_users_is_reproducible(history):
    first = [r[0] for r in feat.sample_users(history, 4).collect()]
    assert first == [r[0] for r in feat.sample_users(history, 4).collect()]
    assert len(set(first)) == 4
    assert feat.sample_users(history, 99).count() == 10


def test_class_balance(history):
    row = feat.class_balance(feat.ctr_pairs(history)).first()
    assert row["positives"] > 0 and row["ratio"] <= 4.5
    assert row["negatives"] == 4 * row["positives"]


def test_popular_items_break_ties_by_id(ratings):
    df = ratings([("u1", "b", 1.0, 1), ("u2", "b", 1.0, 1), ("u1", "c", 1.0, 1), ("u1", "a", 1.0, 1)])
    got = [(r["item_id"], r["rank"]) for r in feat.popular_items(df, 2).orderBy("rank").collect()]
    assert got == [("b", 1), ("a", 2)]


def test_confidence_sums_duplicates(ratings):
    df = ratings([("u", "i", 2.0, 1), ("u", "i", 3.0, 2)])
    assert feat.confidence_matrix(df).first()["confidence"] == 200.0


def test_fill_missing_covers_integers(spark):
    df = spark.createDataFrame([(None, None, None)], "a double, n int, s string")
    assert tuple(feat.fill_missing(df).first()) == (0.0, 0, None)
    assert feat.drop_null_ratings(df.select(F.col("a").alias("rating"))).count() == 0
