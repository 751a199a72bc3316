"""Stateful live attribution against the batch form, over out-of-order files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ranklight.operators.experiment import attribute_feedback
from ranklight.streaming import live
from ranklight.streaming.attribution import stream_attribute_feedback

SCHEMA = "number long, user_id string, timestamp timestamp, variant string, action string"
START = dt.datetime(2024, 3, 1, 12, 0)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Twelve files in time order, rows inside and between neighbouring files out of order."""
    draw = random.Random(4)
    path = str(tmp_path_factory.mktemp("events"))
    rows = []
    for k in range(600):
        user = "hot" if k % 3 == 0 else f"u{draw.randrange(40)}"
        at = START + dt.timedelta(minutes=k / 2 + draw.uniform(-4, 4), microseconds=draw.randrange(10**6))
        kind = draw.random() < 0.4
        rows.append((k, user, at, draw.choice("AB") if kind else None, None if kind else "click"))
    rows.append((600, "u1", None, None, "click"))
    rows += [(601, "u2", START, "A", None), (602, "u2", START, "B", None), (603, "u2", START, None, "click")]
    # The last file moves the watermark far beyond all others.
    files = [rows[601:] + rows[:50], *(rows[s : s + 50] for s in range(50, 600, 50))]
    files[3] = files[3] + [rows[600]]
    files.append([(9999, "clock", START + dt.timedelta(days=2), "A", None)])
    for number, part in enumerate(files):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{number:02d}")
    return path


def sides(df):
    shown = df.filter("variant IS NOT NULL").select("user_id", "timestamp", "variant")
    given = df.filter("action IS NOT NULL").select("number", "user_id", "timestamp", "action")
    return shown, given


def stream(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 3).option("recursiveFileLookup", "true")
    return reader.parquet(folder)


def batch(spark, folder):
    read = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)
    return {r["number"]: r for r in attribute_feedback(*sides(read)).collect()}


def compared(found, want):
    columns = ("user_id", "timestamp", "action", "variant", "predicted_at")
    got = {r["number"]: tuple(r[c] for c in columns) for r in found}
    assert 600 not in got  # feedback without a time
    assert got == {k: tuple(r[c] for c in columns) for k, r in want.items() if k != 600}
    assert sum(v[3] is None for v in got.values()) > 3


def test_corrected_rows_equal_the_batch_form(spark, folder, tmp_path):
    found = stream_attribute_feedback(*sides(stream(spark, folder)), lateness="20 minutes")
    writer = live.start_upserts(found, str(tmp_path / "rows"), str(tmp_path / "state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    written = spark.read.parquet(str(tmp_path / "rows"))
    compared(live.latest_rows(written, ["number"]).collect(), batch(spark, folder))


def test_settled_rows_come_once_and_equal_the_batch_form(spark, folder, tmp_path):
    found = stream_attribute_feedback(*sides(stream(spark, folder)), lateness="20 minutes", corrections=False)
    writer = found.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
    writer = writer.option("checkpointLocation", str(tmp_path / "state")).outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(found.schema).parquet(str(tmp_path / "rows")).collect()
    assert len(rows) == len({r["number"] for r in rows})
    compared(rows, batch(spark, folder))
