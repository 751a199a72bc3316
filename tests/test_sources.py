import json

import pytest
from pyspark.sql import functions as F

from ranklight.sources import logs, reports, tables


def _write(path, lines):
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(path)


def test_prediction_log_is_coerced(spark, tmp_path):
    path = _write(
        tmp_path / "p.jsonl",
        [
            {"timestamp": "2024-03-04T10:00:00.5", "user_id": "u1", "variant": "A", "items": ["a", "b"], "latency_ms": 12.5},
            "",
            {"timestamp": "not a time", "user_id": "u2", "variant": None, "items": "a", "latency_ms": "slow"},
            {"timestamp": "2024-03-03T10:00:00+00:00", "user_id": 3, "latency_ms": "7"},
        ],
    )
    rows = logs.read_predictions(spark, path, ordered=True).collect()
    assert [r["user_id"] for r in rows] == ["3", "u1", "u2"]
    assert [r["variant"] for r in rows] == ["unknown", "A", "unknown"]
    assert [r["items"] for r in rows] == [[], ["a", "b"], []]
    assert [r["latency_ms"] for r in rows] == [7.0, 12.5, None]
    assert [r["request_hour"] for r in rows] == [10, 10, -1]
    assert [r["request_dayofweek"] for r in rows] == [6, 0, -1]


def test_missing_logs_are_empty_with_all_columns(spark, tmp_path):
    found = logs.read_predictions(spark, str(tmp_path / "none.jsonl"))
    assert found.count() == 0 and "request_dayofweek" in found.columns
    assert logs.read_feedback(spark, str(tmp_path / "none.jsonl")).columns[-1] == "action"


def test_malformed_json_fails(spark, tmp_path):
    path = _write(tmp_path / "bad.jsonl", [{"user_id": "u"}, "{broken"])
    with pytest.raises(Exception, match="(?i)malformed"):
        logs.read_predictions(spark, path).collect()


def test_logs_round_trip_and_append(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("u", "A", ["x"], 1.2345)], "user_id string, variant string, items array<string>, latency_ms double")
    records = logs.prediction_records(df.withColumn("timestamp", F.timestamp_seconds(F.lit(1700000000))))
    logs.append_log(records, path)
    logs.append_log(records, path)
    rows = logs.read_predictions(spark, path).collect()
    assert [(r["latency_ms"], r["items"]) for r in rows] == [(1.23, ["x"])] * 2


def test_feedback_sorts_unknown_times_last(spark, tmp_path):
    path = _write(
        tmp_path / "f.jsonl",
        [
            {"user_id": "a", "logged_at": None, "action": "click"},
            {"user_id": "b", "logged_at": "2024-01-02T00:00:00", "action": "click"},
            {"user_id": "c", "logged_at": "2024-01-01T00:00:00", "action": "click"},
        ],
    )
    assert [r["user_id"] for r in logs.read_feedback(spark, path, ordered=True).collect()] == ["c", "b", "a"]


def test_reviews_and_metadata(spark, tmp_path):
    reviews = _write(tmp_path / "r.jsonl", [{"user_id": "u", "parent_asin": f"i{i}", "rating": 4.0, "timestamp": i, "text": "x"} for i in range(9)])
    assert tables.load_reviews(spark, reviews).columns == ["user_id", "item_id", "rating", "timestamp"]
    share = tables.hash_share(spark.range(10_000), 0.3, "id")
    assert 2800 < share.count() < 3200 and sorted(share.collect()) == sorted(share.collect())
    items = _write(tmp_path / "m.jsonl", [{"parent_asin": "i1", "title": "T", "description": ["a"], "price": "9.5"}])
    row = tables.load_metadata(spark, items).first()
    assert (row["item_id"], row["description"], row["price"]) == ("i1", ["a"], "9.5")


def test_splits_without_metadata(spark, ratings, tmp_path):
    df = ratings([("u", "i", 1.0, 1)])
    tables.write_splits(df, df, None, str(tmp_path))
    train, test, metadata = tables.read_splits(spark, str(tmp_path))
    assert train.count() == test.count() == 1 and metadata is None


def test_comparison_is_one_csv(spark, tmp_path):
    df = spark.createDataFrame([("ndcg", 0.1, 0.2, 0.1), ("rmse", 1.0, None, None)], "metric string, model_a double, model_b double, diff_b_minus_a double")
    reports.write_metric_comparison(df, str(tmp_path / "c"))
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert sorted(tuple(r) for r in reports.read_metric_comparison(spark, str(tmp_path / "c")).collect()) == sorted(tuple(r) for r in df.collect())
