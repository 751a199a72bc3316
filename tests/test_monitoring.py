import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ranklight.operators import alerts, drift, monitoring
from ranklight.plans.drift_report import analyze_prediction_drift
from ranklight.sources import logs, reports


@pytest.fixture(scope="module")
def predictions(spark):
    start = datetime(2024, 3, 4, 10)
    rows = [
        (start + timedelta(minutes=7 * i), f"u{i}", "AB"[i % 2], [f"p{i}", "q", "r", "s", "t", "x"], 50.0 + i)
        for i in range(50)
    ]
    df = spark.createDataFrame(
        rows, "timestamp timestamp, user_id string, variant string, items array<string>, latency_ms double"
    )
    return logs.derive_columns(df)


def test_derived_columns(predictions, spark):
    first = predictions.orderBy("timestamp").first()
    assert (first["num_items"], first["top_item"], first["request_hour"], first["request_dayofweek"]) == (6, "p0", 10, 0)
    empty = predictions.limit(1).select(
        F.lit(None).cast("timestamp").alias("timestamp"), F.array().cast("array<string>").alias("items")
    )
    row = logs.derive_columns(empty).first()
    assert (row["num_items"], row["top_item"], row["request_hour"], row["request_dayofweek"]) == (0, None, -1, -1)


def test_kpis_of_empty_logs(predictions, spark):
    feedback = spark.createDataFrame([("click",), ("purchase",), ("click",)], "action string")
    row = monitoring.kpis(predictions, feedback).first()
    assert (row["predictions"], row["clicks"], row["purchases"], row["click_rate"]) == (50, 2, 1, 0.04)
    row = monitoring.kpis(predictions.limit(0), feedback.limit(0)).first()
    assert (row["predictions"], row["avg_latency_ms"], row["click_rate"]) == (0, 0.0, 0.0)


def test_histogram_is_cumulative(predictions):
    rows = monitoring.latency_histogram(predictions).filter("variant = 'A'").collect()
    counts = {r["le"]: r["observations"] for r in rows}
    assert counts["0.05"] == 1 and counts["0.1"] == 25 and counts["+Inf"] == 25 == rows[0]["samples"]


def test_recent_rows_include_unknown_times(predictions):
    unknown = predictions.limit(2).withColumn("timestamp", F.lit(None).cast("timestamp"))
    rows = monitoring.recent_predictions(predictions.unionByName(unknown), 10).collect()
    assert [r["timestamp"] for r in rows[-2:]] == [None, None]
    times = [r["timestamp"] for r in rows[:-2]]
    assert times == sorted(times, reverse=True) and len(times) == 8
    assert rows[0]["items"].count(",") == 4


def test_counts_and_pivot(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5, 1), "click"), (datetime(2024, 1, 1, 5, 9), "click"), (datetime(2024, 1, 1, 6), None), (None, "click")],
        "logged_at timestamp, action string",
    )
    assert {(r["action"], r["events"]) for r in monitoring.action_counts(df).collect()} == {("click", 3), ("unknown", 1)}
    rows = monitoring.feedback_hourly(df).orderBy("hour").collect()
    assert [(r["hour"].hour, r["action"], r["events"]) for r in rows] == [(5, "click", 2), (6, "unknown", 1)]


@pytest.mark.parametrize("n, size, least", [(100, 0.5, 20), (45, 0.9, 20), (39, 0.5, 20), (1000, 0.01, 20), (10, 0.5, 0)])
def test_reference_split(spark, n, size, least):
    rng = random.Random(n)
    rows = [(datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(9000) // 2), i) for i in range(n)]
    df = spark.createDataFrame(rows, "timestamp timestamp, id long")
    out = drift.reference_current_split(df, "timestamp", "id", size, least)
    wanted = min(max(int(n * min(max(size, 0.1), 0.9)), least), n - least)
    ordered = [i for _, i in sorted(rows)]
    expected = set(ordered[:wanted]) if 0 < wanted < n else set()
    assert {r["id"] for r in out.filter("part = 'reference'").collect()} == expected
    assert out.count() == n


def test_unknown_times_are_current(spark):
    rows = [(datetime(2024, 1, 1, i), i) for i in range(10)] + [(None, 99)]
    df = spark.createDataFrame(rows, "timestamp timestamp, id long")
    out = drift.reference_current_split(df, "timestamp", "id", 0.5, 1)
    assert out.filter("id = 99").first()["part"] == "current"


@pytest.fixture(scope="module")
def flagged(spark):
    rng = np.random.default_rng(3)
    old = [("reference", float(np.round(v, 2)), rng.choice(["a", "b", "c"])) for v in rng.gamma(2, 3, 700)]
    new = [("current", float(np.round(v - 1, 2)), rng.choice(["a", "b", "d"])) for v in rng.gamma(2, 5, 500)]
    rows = [(p, v, str(c)) for p, v, c in old + new]
    return spark.createDataFrame(rows, "part string, x double, c string")


def _sides(flagged):
    rows = flagged.collect()
    return [np.array([r["x"] for r in rows if r["part"] == p]) for p in ("reference", "current")]


def test_distances_match_numpy(flagged):
    old, new = _sides(flagged)
    grid = np.sort(np.concatenate([old, new]))
    gap = np.abs(
        np.searchsorted(np.sort(old), grid, "right") / len(old) - np.searchsorted(np.sort(new), grid, "right") / len(new)
    )
    ks = drift.drift_ks(flagged, ["x"]).first()
    assert ks["distance"] == pytest.approx(gap.max()) and ks["p_value"] < 1e-6
    area = (gap[:-1] * np.diff(grid)).sum() / old.std()
    assert drift.drift_wasserstein(flagged, ["x"]).first()["distance"] == pytest.approx(area)
    shift = drift.drift_numeric(flagged, ["x"]).first()
    assert shift["drift_score"] == pytest.approx(abs(new.mean() - old.mean()) / max(old.std(), 1))


def test_equal_windows_do_not_drift(spark):
    df = spark.createDataFrame([(p, float(i)) for p in ("reference", "current") for i in range(50)], "part string, x double")
    row = drift.drift_ks(df, ["x"]).first()
    assert (row["distance"], row["p_value"]) == (0.0, 1.0)


def test_chi2_matches_the_library(flagged):
    row = drift.drift_chi2(flagged, ["c"]).first()
    indexed = flagged
    for name in ("part", "c"):
        indexed = StringIndexer(inputCol=name, outputCol=f"{name}_i").fit(indexed).transform(indexed)
    table = VectorAssembler(inputCols=["c_i"], outputCol="v").transform(indexed)
    found = ChiSquareTest.test(table, "v", "part_i").first()
    assert row["statistic"] == pytest.approx(found["statistics"][0])
    assert row["degrees"] == found["degreesOfFreedom"][0]


def test_missing_categories_are_a_value(spark):
    rows = [("reference", "a")] * 6 + [("reference", None)] * 4 + [("current", "a")] * 10
    df = spark.createDataFrame(rows, "part string, c string")
    row = drift.drift_categorical(df, ["c"]).first()
    assert row["drift_score"] == pytest.approx(0.4) and row["drift_detected"]


def test_report_job(predictions, spark, tmp_path):
    path = str(tmp_path / "drift")
    summary = analyze_prediction_drift(predictions, path).first()
    assert (summary["status"], summary["reference_rows"], summary["current_rows"]) == ("fallback", 25, 25)
    assert {r["column"] for r in summary["column_results"]} == set(drift.MONITORED)
    assert reports.read_drift_summary(spark, path).first()["drift_share"] == summary["drift_share"]
    assert reports.read_drift_summary(spark, str(tmp_path / "none")) is None
    few = analyze_prediction_drift(predictions.limit(30)).first()
    assert (few["status"], few["drift_detected"]) == ("not_enough_data", None)


def test_report_rows_of_an_empty_report(spark):
    df = spark.createDataFrame([('{"metrics": []}',), ("{}",)], "report string")
    assert drift.drift_result_rows(df).count() == 0


@pytest.mark.parametrize("share, flag, fired", [(0.1, False, False), (0.5, True, True), (0.4, False, True), (None, None, False)])
def test_drift_alert(spark, share, flag, fired):
    df = spark.createDataFrame([("ok", flag, share)], "status string, drift_detected boolean, drift_share double")
    assert alerts.alert_drift(df).first()["triggered"] == fired


def test_latency_and_error_alerts(spark):
    for value, fired in ((100.0, False), (600.0, True)):
        df = spark.createDataFrame([(value,), (value,)], "latency_ms double")
        row = alerts.alert_latency(df).first()
        assert (row["triggered"], row["observed"], row["threshold"], row["unit"]) == (fired, value, 500.0, "ms")
    df = spark.createDataFrame([(i < 6,) for i in range(100)], "failed boolean")
    assert alerts.alert_error_rate(df, F.col("failed")).first()["triggered"]
    assert not alerts.alert_error_rate(df.limit(0), F.col("failed")).first()["triggered"]


def test_drift_alert_needs_an_ok_report(spark):
    schema = "status string, drift_detected boolean, drift_share double"
    fallback = spark.createDataFrame([("fallback", True, 0.8)], schema)
    log = spark.createDataFrame([(10.0, False)], "latency_ms double, failed boolean")
    names = lambda **k: [r["name"] for r in alerts.alerts_all(fallback, log, log, F.col("failed"), **k).collect()]
    assert names() == ["latency", "error_rate"]
    assert names(include_fallback=True) == ["drift", "latency", "error_rate"]


def test_tested_report_is_ok_and_fires(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=i), f"u{i % 7}", "A", ["x"], 10.0 + (i >= 100) * 50 + i % 3) for i in range(200)]
    log = logs.derive_columns(spark.createDataFrame(rows, "timestamp timestamp, user_id string, variant string, items array<string>, latency_ms double"))
    summary = analyze_prediction_drift(log, tests=True).first()
    assert summary["status"] == "ok" and summary["drift_share"] > 0
    assert analyze_prediction_drift(log).first()["status"] == "fallback"


def test_non_finite_values_count_as_missing(spark):
    schema = "part string, latency_ms double"
    rows = [("reference", float(i)) for i in range(30)] + [("current", float(i)) for i in range(30)]
    odd = [("current", float("nan")), ("reference", float("inf")), ("current", float("-inf")), ("current", None)]
    clean, dirty = (spark.createDataFrame(r, schema) for r in (rows, rows + odd))
    for test in (drift.drift_numeric, drift.drift_ks, drift.drift_wasserstein):
        assert test(dirty, ["latency_ms"]).collect() == test(clean, ["latency_ms"]).collect()
    latency = spark.createDataFrame([(100.0,), (float("nan"),)], "latency_ms double")
    assert alerts.alert_latency(latency).first()["observed"] == 100.0


def test_rows_without_time_are_cut_in_two(spark):
    rows = [(None, "u", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "timestamp timestamp, user_id string, latency_ms double")
    parts = drift.reference_current_split(df, "timestamp", "user_id").groupBy("part").count()
    assert {r["part"]: r["count"] for r in parts.collect()} == {"reference": 50, "current": 50}


@pytest.mark.parametrize("statistic, degrees, p", [(3.841, 1, 0.05), (5.991, 2, 0.05), (18.307, 10, 0.05), (1.386, 2, 0.5)])
def test_chi_square_tail(spark, statistic, degrees, p):
    from ranklight.functions.stats import chi_square_p

    row = spark.range(1).select(chi_square_p(F.lit(statistic), F.lit(degrees)).alias("p")).first()
    assert row["p"] == pytest.approx(p, abs=0.01)


def test_one_pass_counters_equal_those_of_three_logs(spark):
    rows = [
        ("A", "ok", None, None),
        ("A", "error", None, "/recommend"),
        ("B", "ok", "click", None),
        (None, "ok", "click", None),
        (None, None, "ignore", None),
        (None, None, None, None),
    ]
    log = spark.createDataFrame(rows, "variant string, status string, action string, endpoint string")
    apart = monitoring.event_counters(
        log.filter("status IS NOT NULL"), log.filter("action IS NOT NULL"), log.filter("endpoint IS NOT NULL")
    )
    shared = monitoring.shared_event_counters(log)
    assert sorted(map(str, shared.collect())) == sorted(map(str, apart.collect()))
    assert monitoring.shared_event_counters(log.limit(0)).count() == 0
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Union") == 0


def test_hourly_columns_hold_every_action(spark):
    rows = [("2024-01-01 10:05:00", "click"), ("2024-01-01 10:55:00", None), ("2024-01-01 11:00:00", "share"), (None, "click")]
    log = spark.createDataFrame(rows, "at string, action string").selectExpr("CAST(at AS TIMESTAMP) AS logged_at", "action")
    wide = monitoring.feedback_hourly_wide(log, ["click", "ignore"])
    assert wide.columns == ["hour", "click", "ignore", "other"]
    assert sorted(tuple(r)[1:] for r in wide.collect()) == [(0, 0, 1), (1, 0, 1)]
    with pytest.raises(ValueError):
        monitoring.feedback_hourly_wide(log, ["other"])
