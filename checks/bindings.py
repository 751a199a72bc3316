"""The given parquet tables seen as the data model of the package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.operators.experiment import assign_variant
from ranklight.operators.interactions import split_sides, temporal_split
from ranklight.plans.prepare import clean_interactions
from ranklight.session import settle
from ranklight.sources.logs import derive_columns

LATEST = (
    "timestamp",
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_extendedprice",
    "rating",
)

# The ship dates start in 1992, before the range the checks accept by default.
TIME_RANGE_MS = (694224000000, 1798761599000)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rating = (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        rating.alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
    )


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("p_partkey") % 17 == 0, "N/A").otherwise(
        F.col("p_retailprice").cast("string")
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.array("p_type", "p_brand").alias("description"),
        F.array("p_brand").alias("features"),
        price.alias("price"),
        F.col("p_type").alias("main_category"),
    )


def item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_interactions(interactions(spark, sf), order=LATEST)


def split(spark: SparkSession, sf: str) -> DataFrame:
    return temporal_split(settle(clean(spark, sf), "clean"))


_WRITTEN: dict[tuple[str, str], DataFrame] = {}


def train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The prepared tables, written once per session and data set, as later jobs read them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        _WRITTEN[key] = settle(split(spark, sf), "split")
    return split_sides(_WRITTEN[key])


def train(spark: SparkSession, sf: str) -> DataFrame:
    return train_test(spark, sf)[0]


def _event_item(key: str = "k"):
    return F.get_json_object("props", f"$.{key}").cast("int")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same table read as a file stream."""
    reader = spark.readStream.schema(table(spark, sf, "events").schema)
    stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The view events as a prediction log with its derived columns."""
    return predictions_of(events(spark, sf))


def predictions_of(source: DataFrame) -> DataFrame:
    views = source.filter(F.col("event_type") == "view")
    first, count = _event_item(), (F.col("event_id") % 10 + 1).cast("int")
    numbers = F.transform(F.sequence(first, first + count - 1), lambda i: (i % 100).cast("string"))
    user = F.col("user_id").cast("string")
    return derive_columns(
        views.select(
            F.col("ts").alias("timestamp"),
            user.alias("user_id"),
            assign_variant(user, 0.5).alias("variant"),
            numbers.alias("items"),
            F.col("value").alias("latency_ms"),
            "event_id",
        )
    )


def feedback(spark: SparkSession, sf: str) -> DataFrame:
    return feedback_of(events(spark, sf))


def feedback_of(source: DataFrame) -> DataFrame:
    given = source.filter(F.col("event_type").isin("click", "purchase", "signup"))
    action = F.when(F.col("event_type") == "signup", "ignore").otherwise(F.col("event_type"))
    return given.select(
        F.col("ts").alias("timestamp"),
        F.col("ts").alias("logged_at"),
        F.col("user_id").cast("string").alias("user_id"),
        _event_item().cast("string").alias("item_id"),
        action.alias("action"),
        "event_id",
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """All events as requests; the error events are the failed ones."""
    return requests_of(events(spark, sf))


def requests_of(source: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    failed = F.col("event_type") == "error"
    return source.select(
        F.col("ts").alias("timestamp"),
        user.alias("user_id"),
        assign_variant(user, 0.5).alias("variant"),
        F.when(failed, "error").otherwise("ok").alias("status"),
        F.col("value").alias("latency_ms"),
        "event_type",
        failed.alias("failed"),
        "event_id",
    )


def canary_feedback(spark: SparkSession, sf: str) -> DataFrame:
    side = F.when(F.col("event_id") % 2 == 0, "canary").otherwise("control")
    return events(spark, sf).select(
        (F.col("user_id") % 5).alias("experiment"),
        side.alias("variant"),
        F.col("event_type").alias("action"),
    )


def drift_log(spark: SparkSession, sf: str) -> DataFrame:
    """All events as the monitored log."""
    return events(spark, sf).select(
        F.col("ts").alias("timestamp"),
        "event_id",
        F.col("value").alias("latency_ms"),
        _event_item().alias("num_items"),
        F.col("event_type").alias("variant"),
        F.hour("ts").alias("request_hour"),
        F.weekday("ts").alias("request_dayofweek"),
    )


def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per priority (experiment) and status (run) three metrics in long form."""
    orders = table(spark, sf, "orders")
    wide = orders.groupBy(
        F.col("o_orderpriority").alias("experiment"), F.col("o_orderstatus").alias("run_id")
    ).agg(
        F.avg("o_totalprice").alias("mean_price"),
        F.count(F.lit(1)).cast("double").alias("orders"),
        F.stddev_samp("o_totalprice").alias("spread"),
    )
    return wide.unpivot(
        ["experiment", "run_id"], ["mean_price", "orders", "spread"], "metric", "value"
    )


def candidate_and_production(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    metrics = metric_table(spark, sf)
    sides = [metrics.filter(F.col("run_id") == run).drop("run_id") for run in ("O", "F")]
    return sides[0], sides[1]


def state_history(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderstatus").alias("stage"),
        F.col("o_orderkey").alias("version"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("updated_at"),
    )


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Test pairs scored with the user's mean training rating; label is a rating of four."""
    learned, tested = train_test(spark, sf)
    means = learned.groupBy("user_id").agg(F.round(F.avg("rating"), 6).alias("score"))
    joined = tested.join(means, "user_id")
    return joined.select(
        "user_id",
        "item_id",
        "rating",
        "score",
        (F.col("score") / 5.0).alias("probability"),
        (F.col("rating") >= 4).cast("int").alias("label"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))


