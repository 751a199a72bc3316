import math
import random

import pytest

from ranklight.operators import evaluate


def _frames(spark, lists, truth):
    recs = [(u, i, n + 1) for u, items in lists.items() for n, i in enumerate(items)]
    rows = [(u, i) for u, items in truth.items() for i in items]
    return (
        spark.createDataFrame(recs, "user_id string, item_id int, rank int"),
        spark.createDataFrame(rows, "user_id string, item_id int"),
    )


def _expected(recommended, relevant, k):
    hits = [n for n, i in enumerate(recommended[:k]) if i in set(relevant)]
    best = sum(1 / math.log2(n + 2) for n in range(min(len(relevant), k)))
    return (
        len(hits) / k if k else 0.0,
        len(hits) / len(relevant),
        sum(1 / math.log2(n + 2) for n in hits) / best if best else 0.0,
    )


def test_three_small_lists(spark):
    lists = {"a": [1, 2, 3], "b": [1, 2, 3], "c": [1, 2, 3]}
    truth = {"a": [2, 3, 5], "b": [4, 5, 6], "c": [1, 2, 3]}
    out = {r["user_id"]: r for r in evaluate.user_metrics(*_frames(spark, lists, truth), [3]).collect()}
    assert out["a"]["precision_at_3"] == pytest.approx(2 / 3)
    assert 0 < out["a"]["ndcg_at_3"] < 1
    assert (out["b"]["precision_at_3"], out["b"]["ndcg_at_3"], out["b"]["reciprocal_rank"]) == (0, 0, 0)
    assert (out["c"]["precision_at_3"], out["c"]["ndcg_at_3"], out["c"]["reciprocal_rank"]) == (1, 1, 1)


def test_random_lists_match_brute_force(spark):
    rng = random.Random(5)
    lists = {f"u{u}": rng.sample(range(40), rng.randint(1, 25)) for u in range(30)}
    truth = {f"u{u}": [rng.randrange(40) for _ in range(rng.randint(1, 12))] for u in range(5, 40)}
    recs, relevant = _frames(spark, lists, truth)
    out = {r["user_id"]: r for r in evaluate.user_metrics(recs, relevant, [0, 5, 20]).collect()}
    assert set(out) == set(truth)
    for user, wanted in truth.items():
        for k in (0, 5, 20):
            got = [out[user][f"{m}_at_{k}"] for m in ("precision", "recall", "ndcg")]
            assert got == pytest.approx(_expected(lists.get(user, []), wanted, k))
    mean = evaluate.evaluate_topn(recs, relevant, [5]).first()["recall_at_5"]
    assert mean == pytest.approx(sum(_expected(lists.get(u, []), w, 5)[1] for u, w in truth.items()) / len(truth))


def test_no_test_users(spark):
    recs, relevant = _frames(spark, {"a": [1]}, {"a": [1]})
    row = evaluate.evaluate_topn(recs, relevant.limit(0), [5]).first()
    assert row["precision_at_5"] == 0.0
    assert evaluate.mean_reciprocal_rank(recs, relevant.limit(0)).first()["mrr"] == 0.0


def test_auc_counts_ties_half(spark):
    rng = random.Random(6)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert evaluate.auc_roc(df).first()["auc_roc"] == pytest.approx(won / len(pos) / len(neg))
    assert evaluate.auc_roc(df.filter("label = 1")).first()["auc_roc"] is None


def test_log_loss_and_rmse(spark):
    df = spark.createDataFrame([(0.9, 1, 1.0), (0.2, 0, 0.0), (0.0, 0, 0.5)], "score double, label int, rating double")
    assert evaluate.log_loss(df).first()[0] == pytest.approx(-(math.log(0.9) + math.log(0.8)) / 3, abs=1e-9)
    assert evaluate.rmse(df).first()[0] == pytest.approx(math.sqrt((0.01 + 0.04 + 0.25) / 3))


def test_compare_metric_sets(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "metric string, value double")
    b = spark.createDataFrame([("y", 5.0), ("z", 3.0)], "metric string, value double")
    rows = [tuple(r) for r in evaluate.compare_metric_sets(a, b).collect()]
    assert rows == [("x", 1.0, None, None), ("y", 2.0, 5.0, 3.0), ("z", None, 3.0, None)]


def test_cold_start_segments(spark):
    train = spark.createDataFrame([("u", "a"), ("u", "a")], "user_id string, item_id string")
    test = spark.createDataFrame([("u", "a"), ("v", "a"), ("u", "b")], "user_id string, item_id string")
    row = evaluate.cold_start_segments(train, test).first()
    assert (row["cold_start_items"], row["warm_items"], row["cold_start_ratio"]) == (1, 1, 0.5)
    assert (row["cold_start_interactions"], row["warm_interactions"]) == (1, 2)
