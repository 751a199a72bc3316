"""Every live form against the same function run over the whole batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ranklight.sources import logs
from ranklight.streaming import live

START = datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files in time order, as a growing log would be."""
    path = str(tmp_path_factory.mktemp("log"))
    rng = random.Random(21)
    for part in range(3):
        rows = sorted(
            (START + timedelta(seconds=part * 7200 + rng.randrange(7200)), f"u{rng.randrange(6)}", "AB"[rng.randrange(2)], rng.random() * 900, rng.random() < 0.1)
            for _ in range(200)
        )
        df = spark.createDataFrame(rows, "timestamp timestamp, user_id string, variant string, latency_ms double, failed boolean")
        df.coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(spark, stream, tmp_path):
    query = (
        stream.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [tuple(r) for r in spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()]


def _upserted(spark, stream, tmp_path, keys):
    out = str(tmp_path / "out")
    writer = live.start_upserts(stream, out, str(tmp_path / "state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return live.latest_rows(spark.read.parquet(out), keys).select(*stream.columns)


@pytest.mark.parametrize(
    "job, keys",
    [
        (lambda df: live.stream_requests_per_minute(df), ["minute"]),
        (lambda df: live.stream_latency_histogram(df), ["start", "variant", "le"]),
        (lambda df: live.stream_alerts(df, F.col("failed"), "10 minutes", error_limit=0.1), ["start"]),
        (lambda df: live.stream_feedback_hourly(df.select(F.col("timestamp").alias("logged_at"), F.col("variant").alias("action"))), ["hour", "action"]),
        (lambda df: live.stream_counters(df, ["variant", "failed"]), ["variant", "failed"]),
    ],
)
def test_updates_equal_the_whole_batch(spark, folder, tmp_path, job, keys):
    got = [tuple(r) for r in _upserted(spark, job(_stream(spark, folder)), tmp_path, keys).collect()]
    want = [tuple(r) for r in job(spark.read.parquet(folder)).collect()]
    rounded = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert rounded(got) == rounded(want) and got


def test_routing(spark, folder, tmp_path):
    got = _run(spark, live.stream_route(_stream(spark, folder).select("user_id"), "shadow"), tmp_path)
    assert len(got) == 600 and {r[1:] for r in got} == {("A", "B")}


def test_attribution(spark, folder, tmp_path):
    def sides(df):
        shown = df.filter("variant = 'A'").select("user_id", "timestamp", "variant")
        given = df.filter("variant = 'B'").select("user_id", "timestamp", F.lit("click").alias("action"))
        return shown, given

    stream = live.stream_attribution(*sides(_stream(spark, folder)), within="20 minutes")
    got = sorted(_run(spark, stream, tmp_path))
    batch = live.stream_attribution(*sides(spark.read.parquet(folder)), within="20 minutes")
    assert got == sorted(map(tuple, batch.collect())) and got
    latest = live.latest_attribution(batch, ["user_id", "timestamp"])
    assert latest.count() == batch.select("user_id", "timestamp").distinct().count()


def test_redelivered_rows_are_dropped(spark, folder, tmp_path):
    twice = _stream(spark, folder).select("user_id", "timestamp")
    got = _run(spark, live.stream_dedup(twice.unionByName(_stream(spark, folder).select("user_id", "timestamp"))), tmp_path)
    want = spark.read.parquet(folder).select("user_id", "timestamp").distinct().count()
    assert len(got) == len(set(got)) == want


def test_log_sink_and_stream_reader(spark, folder, tmp_path):
    rows = _stream(spark, folder).select("timestamp", "user_id", "variant", F.array(F.lit("x")).alias("items"), "latency_ms")
    out = str(tmp_path / "log")
    logs.append_stream(logs.prediction_records(rows), out, str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert logs.read_predictions(spark, out).count() == 600
    again = logs.stream_predictions(spark, out).select("user_id", "num_items", "request_hour")
    assert len(_run(spark, again, tmp_path / "second")) == 600
