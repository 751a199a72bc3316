"""Planted structure: 200 users and 100 items in four groups; users rate mostly inside
their group, and item vectors are the group centre plus noise."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklight.operators import features as feat
from ranklight.operators import similarity as sim
from ranklight.operators.blocks import best_products
from ranklight.operators.collaborative import (
    als_fit,
    als_score_pairs,
    als_top_n,
    cold_start_fallback,
    popular_for,
    recommend,
    search_settings,
)
from ranklight.operators.evaluate import evaluate_topn
from ranklight.operators.interactions import split_sides, temporal_split
from ranklight.operators.ranker import (
    candidate_union,
    ctr_predict,
    feature_importance,
    rerank,
)
from ranklight.plans import serving, training
from ranklight.sources import models

GROUPS = 4


@pytest.fixture(scope="module")
def planted(spark, ratings):
    rng = random.Random(11)
    rows = []
    for u in range(200):
        mine = [i for i in range(100) if i % GROUPS == u % GROUPS]
        other = [i for i in range(100) if i % GROUPS != u % GROUPS]
        for n, i in enumerate(rng.sample(mine, 12) + rng.sample(other, 2)):
            rows.append((f"u{u}", f"i{i}", 5.0 if i % GROUPS == u % GROUPS else 1.0, rng.randrange(10**6)))
    df = ratings(rows)
    train, test = split_sides(temporal_split(df))
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(GROUPS, 16))
    rows = [(f"i{i}", [float(x) for x in centres[i % GROUPS] + rng.normal(scale=0.3, size=16)]) for i in range(100)]
    return sim.normalised(spark.createDataFrame(rows, "item_id string, embedding array<float>")).cache()


@pytest.fixture(scope="module")
def metadata(spark):
    rows = [(f"i{i}", f"Item {i}", ["words", "here"], ["f"], str(5 + i), "x") for i in range(100)]
    return spark.createDataFrame(
        rows,
        "item_id string, title string, description array<string>, features array<string>, price string, main_category string",
    )


@pytest.fixture(scope="module")
def model(planted):
    return als_fit(planted[0], n_factors=8, n_epochs=8)


@pytest.fixture(scope="module")
def clicks(planted, model, metadata, vectors):
    train, _ = planted
    users, items = feat.user_features(train), feat.item_features(train, metadata)
    near = sim.neighbour_table(train, vectors)
    dataset = training.build_ctr_dataset(train, users, items, model, near)
    return training.train_click_model(dataset, trees=10, depth=3)


def _lists(df):
    out = {}
    for r in df.orderBy("user_id", "rank").collect():
        out.setdefault(r["user_id"], []).append((r["item_id"], r["score"], r["rank"]))
    return out


def _check_lists(lists, n):
    for rows in lists.values():
        assert [r[2] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= n
        assert all(a[1] >= b[1] for a, b in zip(rows, rows[1:]))
        assert len({r[0] for r in rows}) == len(rows)


def test_als_beats_the_popular_list(planted, model):
    train, test = planted
    got = evaluate_topn(als_top_n(model, 10), test, [10]).first()["ndcg_at_10"]
    base = evaluate_topn(popular_for(test.select("user_id").distinct(), train, 10), test, [10]).first()["ndcg_at_10"]
    assert got > 2 * base > 0


def test_als_lists(planted, model):
    train, _ = planted
    lists = _lists(als_top_n(model, 10))
    assert len(lists) == 200 and all(len(rows) == 10 for rows in lists.values())
    _check_lists(lists, 10)
    seen = {(r["user_id"], r["item_id"]) for r in train.collect()}
    assert not {(u, r[0]) for u, rows in lists.items() for r in rows} & seen


def test_als_lists_equal_brute_force(planted, model):
    train, _ = planted
    users = {r["user_id"]: np.array(r["vector"]) for r in model.user_factors.collect()}
    items = {r["item_id"]: np.array(r["vector"]) for r in model.item_factors.collect()}
    seen = {(r["user_id"], r["item_id"]) for r in train.collect()}
    for user, rows in _lists(als_top_n(model, 5, rows_per_block=16)).items():
        scores = {i: float(users[user] @ v) for i, v in items.items() if (user, i) not in seen}
        assert [r[1] for r in rows] == pytest.approx(sorted(scores.values(), reverse=True)[:5], abs=1e-5)


def test_als_rejects_bad_input(planted, spark, ratings):
    train, _ = planted
    with pytest.raises(ValueError, match="alpha"):
        als_fit(train, alpha=float("nan"))
    with pytest.raises(ValueError, match="rating"):
        als_fit(train.drop("rating"))
    with pytest.raises(ValueError, match="no valid ratings"):
        als_fit(ratings([("u", "i", None, 1)]))


def test_unknown_pairs_get_the_mean(spark, model):
    pairs = spark.createDataFrame([("u0", "i0"), ("u0", "none"), ("none", "i0")], "user_id string, item_id string")
    got = [r["score"] for r in als_score_pairs(model, pairs).orderBy(F.desc("user_id"), "item_id").collect()]
    mean = model.mean().first()[0]
    assert np.isfinite(got).all() and got[0] != mean and got[1:] == [mean, mean]


def test_n_must_be_positive(model):
    with pytest.raises(ValueError, match="positive"):
        als_top_n(model, 0)


def test_fallback_for_unknown_and_sated_users(spark, ratings):
    rows = [("all", f"i{i}", 4.0, i) for i in range(6)] + [("some", f"i{i}", 5.0, i) for i in range(3)]
    small = als_fit(ratings(rows), n_factors=2, n_epochs=2)
    asked = spark.createDataFrame([("all",), ("some",), ("new",)], "user_id string")
    lists = _lists(recommend(small, asked, 4))
    assert {u: len(rows) for u, rows in lists.items()} == {"all": 4, "some": 3, "new": 4}
    assert [r[0] for r in lists["new"]] == ["i0", "i1", "i2", "i3"] == [r[0] for r in lists["all"]]
    cold = _lists(cold_start_fallback(asked, small.train, 2))
    assert list(cold) == ["new"] and cold["new"][0][1] == pytest.approx(39 / 9)


def test_neighbours_equal_brute_force(vectors):
    table = {r["item_id"]: np.array(r["embedding"], dtype=float) for r in vectors.collect()}
    out = sim.item_neighbours(vectors, 7, rows_per_block=9)
    found = {}
    for r in out.orderBy("item_id", "rank").collect():
        found.setdefault(r["item_id"], []).append(r["neighbour_id"])
    for item, vector in table.items():
        near = sorted((-round(float(vector @ v), 9), other) for other, v in table.items() if other != item)
        assert found[item] == [other for _, other in near[:7]]
        assert {other[1:] for other in found[item]} == {o[1:] for o in found[item] if int(o[1:]) % 4 == int(item[1:]) % 4}


def test_copies_do_not_lose_neighbours(spark):
    """A third of the vectors are the same: ties go to the smaller id, nothing is dropped."""
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(i, [float(x) for x in rng.normal(size=2)]) for i in range(40, 120)]
    df = sim.normalised(spark.createDataFrame(rows, "item_id long, embedding array<float>"))
    exact = sim.item_neighbours(df, 5, rows_per_block=7)
    assert exact.count() == 120 * 5
    mine = exact.filter("item_id = 3").orderBy("rank").collect()
    assert [r["neighbour_id"] for r in mine] == [0, 1, 2, 4, 5]
    lsh = sim.item_neighbours_lsh(df, 5, rows_per_block=7)
    assert lsh.groupBy("item_id").count().filter("count > 5").isEmpty()
    assert sim.recall_against(lsh, exact).first()["recall"] > 0.9


def test_lsh_recall(vectors):
    hashing = {"tables": 8, "bits": 5}
    lsh = sim.item_neighbours_lsh(vectors, 5, **hashing)
    assert lsh.filter("item_id = neighbour_id").isEmpty()
    assert sim.recall_against(lsh, sim.item_neighbours(vectors, 5)).first()["recall"] > 0.5


def test_lsh_finds_planted_clusters_with_few_pairs(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 16))
    rows = [(i, [float(x) for x in centres[i % 40] + 0.15 * rng.normal(size=16)]) for i in range(400)]
    df = sim.normalised(spark.createDataFrame(rows, "item_id long, embedding array<float>"))
    found = sim.item_neighbours_lsh(df, 5, bits=8)
    assert sim.recall_against(found, sim.item_neighbours(df, 5)).first()["recall"] >= 0.9
    assert sim.compared_share(sim.hyperplane_buckets(df, bits=8), 400).first()["share"] <= 0.25


def test_grouped_products_only_meet_inside_groups(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(10)], "id long, vector array<float>, g int")
    out = best_products(df, df, 3, exclude_self=True, group="g", rows_per_block=2)
    assert out.filter("query_id % 2 != item_id % 2").isEmpty() and out.count() == 30


def test_semantic_lists(planted, vectors):
    train, test = planted
    near = sim.neighbour_table(train, vectors)
    lists = _lists(sim.semantic_top_n(train, near, 10))
    _check_lists(lists, 10)
    seen = {(r["user_id"], r["item_id"]) for r in train.collect()}
    assert not {(u, r[0]) for u, rows in lists.items() for r in rows} & seen
    metrics = training.evaluate_semantic(train, test, near, ks=[10]).first()
    assert metrics["ndcg_at_10"] > 0.1


def test_text_vectors_are_unit_length(spark):
    texts = spark.createDataFrame([("a", "red fast car"), ("b", "red fast bike"), ("c", "green tea")], "item_id string, text string")
    got = {r["item_id"]: np.array(r["embedding"]) for r in sim.text_vectors(texts, "item_id").collect()}
    assert all(len(v) == 384 and np.linalg.norm(v) == pytest.approx(1, abs=1e-5) for v in got.values())
    assert got["a"] @ got["b"] > got["a"] @ got["c"]


def test_candidate_union_prefers_the_collaborative_score(spark):
    schema = "user_id string, item_id string, score double, rank int"
    a = spark.createDataFrame([("u", "x", 0.1, 1), ("u", "y", 0.05, 2)], schema)
    b = spark.createDataFrame([("u", "x", 0.9, 1), ("u", "z", 0.8, 2), ("u", "w", 0.7, 3)], schema)
    got = {r["item_id"]: r["score"] for r in candidate_union(a, b, 2).collect()}
    assert got == {"x": 0.1, "y": 0.05, "z": 0.8}
    assert candidate_union(a, None, 1).count() == 1


def test_click_model(clicks, planted):
    model, scored, metrics = clicks
    row = metrics.first()
    assert row["auc_roc"] > 0.8 and 0 < row["log_loss"] < 0.7
    assert scored.filter("score < 0 OR score > 1").isEmpty()
    with pytest.raises(ValueError, match="missing feature columns"):
        ctr_predict(model, planted[0].select("user_id", "item_id"))


def test_rerank(clicks, spark):
    model = clicks[0]
    rows = [("u", f"i{i}", i / 10) for i in range(8)]
    found = spark.createDataFrame(rows, "user_id string, item_id string, model_a_score double")
    lists = _lists(rerank(model, found, 5))
    assert len(lists["u"]) == 5
    _check_lists(lists, 5)
    assert rerank(model, found.limit(0), 5).isEmpty()


def test_importance_is_sorted(clicks, spark):
    rows = feature_importance(clicks[0], spark, 5).collect()
    assert len(rows) == 5 and rows == sorted(rows, key=lambda r: -r["importance"])


def test_two_stage_lists(planted, model, clicks, metadata, vectors):
    train, test = planted
    users, items = feat.user_features(train), feat.item_features(train, metadata)
    near = sim.neighbour_table(train, vectors)
    lists = _lists(serving.two_stage_top_n(model, clicks[0], train, near, users, items, 10, 30))
    assert len(lists) == 200
    _check_lists(lists, 10)
    row = training.evaluate_two_stage(model, clicks[0], train, test, None, users, items, [10]).first()
    assert 0 <= row["pipeline_ndcg_at_10"] <= 1


def test_variant_lists(spark, planted, model, clicks):
    users = planted[0].select("user_id").unionByName(spark.createDataFrame([("new",)], "user_id string"))
    out = serving.variant_recommendations(model, clicks[0], users, n=5, candidates=20)
    assert out.groupBy("user_id").count().filter("count != 5").isEmpty()
    assert out.select("user_id").distinct().count() == 201
    both = serving.variant_recommendations(model, None, users, "shadow", n=3)
    rows = {}
    for r in both.collect():
        rows.setdefault((r["user_id"], r["rank"]), {})[r["variant"]] = r["item_id"]
    assert all(r["A"] == r["B"] for r in rows.values())
    logged = serving.prediction_rows(both, F.current_timestamp(), F.lit(1.0))
    assert logged.count() == 402 and logged.filter("size(items) != 3").isEmpty()


def test_search_tries_every_setting(planted):
    assert len(search_settings()) == 36
    grid = {"n_factors": [2, 8], "n_epochs": [3], "regularization": [0.01], "alpha": [40.0]}
    best, rows, run = training.als_grid_search(*planted, grid)
    scores = {r["run_id"]: r["value"] for r in rows.filter("metric = 'ndcg_at_10'").collect()}
    assert set(scores) == {"als-00", "als-01"} and scores[run] == max(scores.values())
    assert best is not None


def test_training_job(planted, metadata, vectors):
    out = training.training_job(
        *planted, metadata, vectors, train_semantic=True, train_clicks=True,
        als_settings={"n_factors": 4, "n_epochs": 2}, click_settings={"trees": 3, "depth": 2}, click_users=50,
    )
    rows = {(r["run_id"], r["metric"]): r["value"] for r in out.collect()}
    assert {run for run, _ in rows} == {"model_a", "model_b", "model_b_minus_a", "cold_start", "model_c", "pipeline"}
    assert all(0 <= v <= 1 for (run, m), v in rows.items() if run in ("model_a", "model_b") and "_at_" in m)
    assert ("model_a", "rmse") in rows and ("model_c", "auc_roc") in rows


def test_models_are_saved_and_loaded(spark, planted, model, clicks, tmp_path):
    path = str(tmp_path / "als")
    assert models.load_collaborative(spark, path) is None
    trained, how = models.load_or_train(spark, path, planted[0].limit(200))
    assert how == "trained"
    loaded, how = models.load_or_train(spark, path, planted[0])
    assert how == "loaded" and loaded.user_factors.count() == trained.user_factors.count()
    assert models.load_click_model(spark, str(tmp_path / "none")) is None
    models.save_click_model(clicks[0], spark, str(tmp_path / "clicks"))
    again = models.load_click_model(spark, str(tmp_path / "clicks"))
    assert again.columns == clicks[0].columns


def test_neighbours_are_stored_by_bucket(spark, vectors, tmp_path):
    near = sim.item_neighbours(vectors, 3)
    models.save_neighbours(near, str(tmp_path / "near"), "near_items", 4)
    stored = models.load_neighbours(spark, str(tmp_path / "near"), "near_items")
    assert models.similar_items(stored, "i1").count() == 3
    assert models.similar_items(stored, "unknown").count() == 0
    joined = stored.join(stored.withColumnRenamed("neighbour_id", "other"), "item_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
