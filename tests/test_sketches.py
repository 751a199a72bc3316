"""Sketched distinct counts are near the exact ones and merge without rereading."""

from pyspark.sql import functions as F

from ranklight.operators.sketches import distinct_estimates, merged_sketches, sketch_columns


def batch(spark, first, last):
    return spark.range(first, last).select(
        (F.col("id") % 30_000).alias("user"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("i"), F.col("id") % 400)).alias("item"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"),
    )


def estimates(table):
    return {r["column"]: (r["rows"], r["distinct_values"]) for r in distinct_estimates(table).collect()}


def test_merged_batches_count_as_all_rows(spark, tmp_path):
    columns = ["user", "item"]
    for name, (a, b) in {"old": (0, 40_000), "new": (20_000, 90_000)}.items():
        sketch_columns(batch(spark, a, b), columns, F.col("day")).write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new")]
    merged = merged_sketches(*stored)
    assert merged.count() == 10
    found = estimates(merged)
    whole = estimates(sketch_columns(batch(spark, 0, 90_000), columns, F.col("day")))
    for column, exact in (("user", 30_000), ("item", 400)):
        assert found[column][0] == 110_000
        # A union no longer knows the order of arrival, by which a single sketch refines its estimate.
        assert abs(found[column][1] - exact) <= 0.02 * exact
        assert abs(whole[column][1] - exact) <= 0.02 * exact


def test_empty_and_null(spark):
    empty = sketch_columns(batch(spark, 0, 0), ["user"], F.col("day"))
    assert estimates(empty) == {}
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "item string")
    assert estimates(sketch_columns(nulls, ["item"])) == {"item": (3, 1)}


def test_prepared_rows_are_computed_once(spark, monkeypatch):
    from checks import bindings, queries

    met = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    rows = spark.range(600).selectExpr("id % 40 AS user_id", "id % 30 AS item_id", "1.0D AS rating", "id AS timestamp")
    monkeypatch.setattr(bindings, "clean", lambda *_: rows.mapInArrow(counted, rows.schema))
    found = {r["column"]: (r["rows"], r["exact"], r["near"]) for r in queries.QUERIES["distinct_counts_sketched"](spark, "").collect()}
    assert found == {"user_id": (600, 40, True), "item_id": (600, 30, True)}
    assert met.value == 600


def test_exchanges_go_when_their_job_ends(spark):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
