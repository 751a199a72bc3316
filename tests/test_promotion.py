import pytest

from ranklight.operators import promotion

SCHEMA = "experiment string, metric string, value double"


def _table(spark, experiment, **values):
    return spark.createDataFrame([(experiment, m, v) for m, v in values.items()], SCHEMA)


@pytest.mark.parametrize(
    "candidate, production, action",
    [
        ({"ndcg": 0.2, "precision": 0.2}, {"ndcg": 0.1, "precision": 0.1}, "promoted_to_canary"),
        ({"ndcg": 0.2, "precision": 0.1001, "recall": 0.2001}, {"ndcg": 0.1, "precision": 0.1, "recall": 0.2}, "promoted_to_staging"),
        ({"ndcg": 0.1, "precision": 0.1}, {"ndcg": 0.1, "precision": 0.1}, "rejected"),
        ({"ndcg": 0.2, "precision": 0.05}, {"ndcg": 0.1, "precision": 0.1}, "rejected"),
        ({"ndcg": 0.2}, {"recall": 0.1}, "rejected"),
        ({"ndcg": 0.2}, {"ndcg": 0.0}, "rejected"),
    ],
)
def test_decision(spark, candidate, production, action):
    out = promotion.promotion_decision(_table(spark, "e", **candidate), _table(spark, "e", **production))
    assert out.first()["action"] == action


def test_no_production_model_goes_to_staging(spark):
    row = promotion.promotion_decision(_table(spark, "e", ndcg=0.2), _table(spark, "other", ndcg=0.1)).first()
    assert (row["action"], row["reason"]) == ("promoted_to_staging", "no_production_model")


def test_run_metrics_are_limited(spark):
    df = _table(spark, "e", ndcg_at_10=1.0, rmse=2.0, auc_roc=3.0)
    assert {r["metric"] for r in promotion.run_metrics(df).collect()} == {"ndcg_at_10", "auc_roc"}


@pytest.mark.parametrize(
    "rows, errors, status, proceed",
    [(50, 0, "insufficient_data", False), (150, 20, "high_error_rate", False), (150, 2, "healthy", True)],
)
def test_canary(spark, rows, errors, status, proceed):
    data = [("e", "canary", "error" if i < errors else "click") for i in range(rows)] + [("e", "control", "error")] * 300
    log = spark.createDataFrame(data, "experiment string, variant string, action string")
    row = promotion.canary_health(log, log.select("experiment").distinct()).first()
    assert (row["status"], row["samples"], row["proceed"]) == (status, rows, proceed)


def test_canary_without_a_log(spark):
    asked = spark.createDataFrame([("e",)], "experiment string")
    row = promotion.canary_health(None, asked).first()
    assert (row["status"], row["proceed"]) == ("no_data", True)
    empty = spark.createDataFrame([], "experiment string, variant string, action string")
    assert promotion.canary_health(empty, asked).first()["status"] == "insufficient_data"


def test_latest_state(spark):
    rows = [("e", "Staging", 1, "r1", 10), ("e", "Production", 2, "r2", 20), ("f", "Staging", 1, "r3", 5)]
    df = spark.createDataFrame(rows, "experiment string, stage string, version long, run_id string, updated_at long")
    out = {r["experiment"]: (r["stage"], r["run_id"]) for r in promotion.latest_deployment_state(df).collect()}
    assert out == {"e": ("Production", "r2"), "f": ("Staging", "r3")}


def test_rollback_takes_the_newest_archived(spark):
    rows = [("m", "Archived", 1, 10), ("m", "Archived", 3, 30), ("m", "Production", 4, 40)]
    df = spark.createDataFrame(rows, "model string, stage string, version long, updated_at long")
    assert promotion.rollback_target(df).first()["version"] == 3
    assert promotion.latest_version_per_stage(df).count() == 2
