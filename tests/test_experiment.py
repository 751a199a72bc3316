import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ranklight.functions import stats
from ranklight.operators import experiment


@pytest.fixture(scope="module")
def users(spark):
    return spark.range(10_000).select(F.concat(F.lit("user_"), "id").alias("user_id"))


def _bucket(user):
    return int(hashlib.md5(user.encode()).hexdigest()[:8], 16) % 100


@pytest.mark.parametrize("split", [0.0, 0.05, 0.29, 0.5, 1.0])
def test_assignment_equals_the_hash_rule(users, split):
    rows = users.select("user_id", experiment.assign_variant(F.col("user_id"), split).alias("v")).collect()
    assert all(r["v"] == ("B" if _bucket(r["user_id"]) < int(split * 100) else "A") for r in rows)


def test_share_is_near_the_split(users):
    routed = experiment.route_traffic(users, "ab_test", 0.5)
    share = {r["variant"]: r["share"] for r in experiment.variant_share(routed, "serving_variant").collect()}
    assert share["A"] == pytest.approx(0.5, abs=0.02)


def test_modes(users):
    shadow = experiment.route_traffic(users, "shadow")
    assert shadow.filter("serving_variant = 'A' AND shadow_variant = 'B'").count() == 10_000
    assert experiment.logged_variants(shadow).count() == 20_000
    canary = experiment.route_traffic(users, "CANARY").filter("serving_variant = 'B'").count()
    assert 300 < canary < 700
    default = experiment.route_traffic(users, "ab_test", 0.0).filter("serving_variant = 'B'").count()
    assert 4500 < default < 5500
    with pytest.raises(ValueError, match="unknown mode"):
        experiment.route_traffic(users, "blue_green")


def _logs(spark, seed, users, n):
    rng = random.Random(seed)
    pick = lambda: "hot" if rng.random() < 0.4 else f"u{rng.randrange(users)}"
    shown = [(pick(), rng.choice("AB"), rng.randrange(40_000)) for _ in range(n)]
    given = [(pick(), rng.choice(["click", "ignore"]), rng.randrange(40_000), k) for k in range(n)]
    predictions = spark.createDataFrame(shown, "user_id string, variant string, t long")
    feedback = spark.createDataFrame(given, "user_id string, action string, t long, row long")
    at = F.timestamp_seconds("t").alias("timestamp")
    return (
        shown,
        given,
        predictions.select("user_id", "variant", at),
        feedback.select("user_id", "action", at, "row", "t"),
    )


def test_attribution_finds_the_latest_earlier_prediction(spark):
    shown, given, predictions, feedback = _logs(spark, 7, 40, 600)
    out = experiment.attribute_feedback(predictions, feedback)
    got = {r["row"]: r["variant"] for r in out.collect()}
    assert len(got) == len(given)
    for user, _, t, row in given:
        earlier = [(at, v) for u, v, at in shown if u == user and at <= t]
        assert got[row] == (max(earlier)[1] if earlier else None)


def test_conversion_joined_on_user_counts_every_pair(spark):
    shown, given, predictions, feedback = _logs(spark, 8, 10, 300)
    out = {r["variant"]: (r["n"], r["clicks"]) for r in experiment.ab_conversion(predictions, feedback).collect()}
    for variant in "AB":
        n = sum(v == variant for _, v, _ in shown)
        pairs = sum(u == g and v == variant for u, v, _ in shown for g, a, _, _ in given if a == "click")
        assert out[variant] == (n, pairs)


def test_attributed_conversion_counts_every_click_once(spark):
    _, given, predictions, feedback = _logs(spark, 9, 10, 300)
    rows = experiment.ab_conversion_attributed(predictions, feedback).collect()
    assert sum(r["clicks"] for r in rows) == sum(a == "click" for _, a, _, _ in given)


def test_z_test(spark):
    rows = [(1, 50, 1000, 50, 1000), (2, 10, 1000, 100, 1000), (3, 0, 0, 10, 100), (4, 50, 1000, 65, 1000)]
    df = spark.createDataFrame(rows, "id int, clicks_a long, n_a long, clicks_b long, n_b long")
    out = {r["id"]: (r["z"], r["p"]) for r in experiment.two_proportion_test(df).collect()}
    assert out[1] == (0.0, 1.0)
    assert abs(out[2][0]) > 1.96 and out[2][1] < 0.05
    assert out[3] == (0.0, 1.0)
    z = (0.065 - 0.05) / math.sqrt(0.0575 * 0.9425 * 0.002)
    assert out[4] == (round(z, 4), round(2 * (1 - 0.5 * (1 + math.erf(z / math.sqrt(2)))), 4))


def test_erf_equals_the_library(spark):
    values = [x / 50 for x in range(-400, 401)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", stats.erf(F.col("x")).alias("y")).collect():
        assert r["y"] == pytest.approx(math.erf(r["x"]), abs=1e-12)


def test_sample_size(spark):
    df = spark.createDataFrame(
        [(0.05, 0.01), (0.05, 0.05), (0.0, 0.01), (0.05, 0.0), (1.0, 0.01)], "base_rate double, effect double"
    )
    out = [r["needed_per_variant"] for r in experiment.needed_samples(df).collect()]
    assert out[0] == 7665 and out[1] < out[0] and out[2:] == [0, 0, 0]


def test_readout_per_segment(spark):
    df = spark.createDataFrame(
        [("x", "A", 1000, 10), ("x", "B", 1000, 100), ("y", "A", 50, 5)],
        "segment string, variant string, n long, clicks long",
    )
    out = {r["segment"]: r for r in experiment.experiment_readout(df, ["segment"]).collect()}
    assert out["x"]["significant"] and out["x"]["lift"] == pytest.approx(9.0)
    assert not out["y"]["significant"] and out["y"]["n_b"] == 0
