"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from ranklight.functions import text
from ranklight.functions.vectors import dot, norm
from ranklight.operators import alerts, drift, evaluate, experiment, monitoring, promotion, quality
from ranklight.operators import features as feat
from ranklight.operators import interactions as prep
from ranklight.operators import lists
from ranklight.operators import similarity as sim
from ranklight.operators.bounded import best_products_bounded
from ranklight.operators.collaborative import (
    als_fit,
    als_score_pairs,
    als_top_n,
    cold_start_fallback,
    popular_for,
)
from ranklight.operators.ranker import (
    candidate_features,
    candidate_union,
    ctr_predict,
    feature_importance,
    rerank,
)
from ranklight.operators.sketches import distinct_estimates, merged_sketches, sketch_columns
from ranklight.plans import serving, training
from ranklight.plans.drift_report import analyze_prediction_drift
from ranklight.plans.prepare import prepare_interactions as run_preparation
from ranklight.session import own_scratch, scratch_path, settle, tune
from ranklight.sources import logs, models, reports, tables
from ranklight.streaming import live
from ranklight.streaming.attribution import stream_attribute_feedback

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(function: Query) -> Query:
    """Register under the function's name; doubles are rounded to six places.

    A trailing underscore only keeps the name apart from the operator's.
    """

    def run(spark: SparkSession, sf: str) -> DataFrame:
        own_scratch(tune(spark))
        df = function(spark, sf)
        columns = [
            (F.round(c.name, 6) + F.lit(0.0)).alias(c.name)
            if isinstance(c.dataType, T.DoubleType)
            else F.date_format(c.name, _TIME).alias(c.name)
            if isinstance(c.dataType, T.TimestampType)
            else F.col(c.name)
            for c in df.schema.fields
        ]
        return df.select(*columns)

    QUERIES[function.__name__.rstrip("_")] = run
    return function


def _count(df: DataFrame, **extra) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), *[v.alias(k) for k, v in extra.items()])


_CACHE: dict[tuple, object] = {}


def _once(name: str, spark: SparkSession, sf: str, make: Callable[[], object]):
    """Models and their inputs are built once per session and data set."""
    key = (name, spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


# ---- sources and sinks ------------------------------------------------------------


def _as_raw(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("item_id", "parent_asin")


@query
def scan_reviews(spark, sf):
    raw = _as_raw(b.interactions(spark, sf)).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("parent_asin").cast("string").alias("parent_asin"),
        "rating",
        "timestamp",
    )
    path = scratch_path(spark, "reviews")
    raw.write.json(path)
    reviews = tables.load_reviews(spark, path)
    return reviews.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("rating").alias("ratings"),
        F.max("timestamp").alias("latest"),
    )


@query
def scan_metadata(spark, sf):
    path = scratch_path(spark, "metadata")
    _as_raw(b.metadata(spark, sf)).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("parent_asin", F.col("parent_asin").cast("string"))
    path = scratch_path(spark, "metadata")
    stored.write.json(path)
    found = tables.load_metadata(spark, path)
    return found.select("item_id", "title", "price", "main_category", F.size("features").alias("n"))


def _stored_splits(spark, sf):
    folder = scratch_path(spark, "splits")
    train, test = b.train_test(spark, sf)
    tables.write_splits(train, test, b.metadata(spark, sf), folder)
    return tables.read_splits(spark, folder)


@query
def write_splits(spark, sf):
    train, test, metadata = _stored_splits(spark, sf)
    parts = [
        _count(df).select(F.lit(name).alias("name"), "rows")
        for name, df in (("train", train), ("test", test), ("metadata", metadata))
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def scan_splits(spark, sf):
    train, test, _ = _stored_splits(spark, sf)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def _prediction_file(spark, sf):
    path = scratch_path(spark, "predictions")
    logs.append_log(logs.prediction_records(b.predictions(spark, sf)), path)
    return path


def _feedback_file(spark, sf):
    path = scratch_path(spark, "feedback")
    logs.append_log(logs.feedback_records(b.feedback(spark, sf)), path)
    return path


@query
def scan_prediction_log(spark, sf):
    found = logs.read_predictions(spark, _prediction_file(spark, sf))
    return found.withColumn("items", F.array_join("items", ","))


@query
def scan_feedback_log(spark, sf):
    return logs.read_feedback(spark, _feedback_file(spark, sf))


@query
def append_logs(spark, sf):
    path = _prediction_file(spark, sf)
    logs.append_log(logs.prediction_records(b.predictions(spark, sf)), path)
    found = logs.read_predictions(spark, path)
    return found.groupBy("variant").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("latency_ms").alias("latency_ms")
    )


def _popular_lists(spark, sf, n=20):
    train, test = b.train_test(spark, sf)
    return popular_for(test.select("user_id").distinct(), train, n), train, test


def _two_metric_sets(spark, sf):
    """Metrics of the ten and of the twenty most popular items; each has one the other lacks."""
    lists, _, test = _popular_lists(spark, sf)
    wide = settle(evaluate.evaluate_topn(lists, test, [5, 10, 20]), "metrics")
    short = settle(evaluate.evaluate_topn(lists.filter("rank <= 5"), test, [1, 5, 10]), "metrics")
    return evaluate.to_long(wide), evaluate.to_long(short)


@query
def write_metric_comparison(spark, sf):
    path = scratch_path(spark, "comparison")
    reports.write_metric_comparison(evaluate.compare_metric_sets(*_two_metric_sets(spark, sf)), path)
    return reports.read_metric_comparison(spark, path)


def _split_log(spark, sf):
    return drift.reference_current_split(b.drift_log(spark, sf), "timestamp", "event_id")


@query
def write_drift_summary(spark, sf):
    path = scratch_path(spark, "drift")
    analyze_prediction_drift(b.drift_log(spark, sf), path, tie="event_id")
    found = reports.read_drift_summary(spark, path)
    return found.select(
        "status", "drift_detected", "drift_share", "reference_rows", "current_rows",
        F.inline("column_results").alias("column", "drift_score", "column_drift", "method"),
    )


# ---- projections and scalar functions ---------------------------------------------


@query
def project_core(spark, sf):
    return prep.project_core(b.interactions(spark, sf))


@query
def liked_items(spark, sf):
    return feat.liked_items(b.train(spark, sf)).select("user_id", "item_id", "rating")


@query
def drop_null_ratings(spark, sf):
    rated = b.interactions(spark, sf).withColumn(
        "rating", F.when(F.col("item_id") % 7 != 0, F.col("rating"))
    )
    return feat.drop_null_ratings(rated).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("rating").alias("ratings")
    )


@query
def select_feature_columns(spark, sf):
    users = feat.user_features(b.train(spark, sf))
    return feat.select_features(users, ["avg_rating", "num_ratings", "price"], absent="zero")


@query
def fill_missing(spark, sf):
    clean = b.interactions(spark, sf).select(
        "user_id", "item_id", F.when(F.col("rating") > 2, F.col("rating")).alias("score")
    )
    return feat.fill_missing(clean).groupBy("user_id").agg(
        F.sum("score").alias("score"), F.count("score").alias("rows")
    )


@query
def log_derived_columns(spark, sf):
    return b.predictions(spark, sf).select(
        "event_id", "variant", "num_items", "top_item", "request_hour", "request_dayofweek", "latency_ms"
    )


@query
def drift_dataset(spark, sf):
    return drift.drift_dataset(b.predictions(spark, sf), carry=["event_id"])


@query
def price_coerce(spark, sf):
    meta = b.metadata(spark, sf)
    return meta.select("item_id", F.coalesce(text.price_number(meta), F.lit(-1.0)).alias("price"))


@query
def description_length(spark, sf):
    meta = b.metadata(spark, sf)
    return meta.select("item_id", text.description_length(meta).alias("description_length"))


@query
def product_text(spark, sf):
    meta = feat.one_per_item(b.metadata(spark, sf))
    return meta.select("item_id", text.product_text(meta).alias("text"))


@query
def recent_items_text(spark, sf):
    return b.predictions(spark, sf).select(
        "event_id", text.first_items_text(F.col("items")).alias("items")
    )


# ---- interaction preparation ------------------------------------------------------


@query
def align_catalog(spark, sf):
    reviews, items = prep.align_catalog(b.interactions(spark, sf), b.item_vectors(spark, sf))
    parts = [
        _count(df).select(F.lit(name).alias("name"), "rows")
        for name, df in (("reviews", reviews), ("items", items))
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dedupe_last(spark, sf):
    return prep.dedupe_last(b.interactions(spark, sf), b.LATEST).select(*prep.INTERACTION_COLUMNS)


def _raw_pairs(spark, sf):
    return prep.dedupe_last(b.interactions(spark, sf), b.LATEST).select(*prep.INTERACTION_COLUMNS)


@query
def filter_min_users(spark, sf):
    return prep.filter_min_users(_raw_pairs(spark, sf), 40)


@query
def filter_min_items(spark, sf):
    return prep.filter_min_items(_raw_pairs(spark, sf), 30)


@query
def preprocess(spark, sf):
    return prep.preprocess(b.interactions(spark, sf), 30, b.LATEST)


@query
def temporal_split(spark, sf):
    return b.split(spark, sf)


def _parity_split(spark, sf):
    side = F.when((F.col("user_id") + F.col("item_id")) % 5 == 0, "test").otherwise("train")
    return prep.split_sides(settle(b.clean(spark, sf).withColumn("split", side), "mixed"))


def _on_both_splits(check, spark, sf):
    splits = {"temporal": b.train_test(spark, sf), "mixed": _parity_split(spark, sf)}
    rows = [check(*s).select(F.lit(name).alias("data"), "*") for name, s in splits.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def split_integrity(spark, sf):
    return _on_both_splits(prep.split_integrity, spark, sf)


@query
def distinct_counts_sketched(spark, sf):
    """Users and items of the prepared rows, from the stored sketches of two batches; exact beside."""
    rows = settle(b.clean(spark, sf).select("user_id", "item_id", "timestamp"), "clean")
    late = F.col("timestamp") % 2 == 0
    day = F.to_date(F.timestamp_millis("timestamp"))
    stored = [settle(sketch_columns(rows.filter(x), ["user_id", "item_id"], day), "sketches") for x in (late, ~late)]
    exact = reduce(
        DataFrame.unionByName,
        [
            rows.agg(F.lit(c).alias("column"), F.count_distinct(c).alias("exact"))
            for c in ("user_id", "item_id")
        ],
    )
    both = distinct_estimates(merged_sketches(*stored)).join(exact, "column")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.02 * F.col("exact")
    return both.select("column", "rows", "exact", near.alias("near"))


@query
def dataset_summary(spark, sf):
    return prep.dataset_summary(b.clean(spark, sf), *b.train_test(spark, sf))


@query
def prepare_interactions(spark, sf):
    folder = scratch_path(spark, "prepared")
    reviews, items = b.interactions(spark, sf), b.metadata(spark, sf)
    run_preparation(reviews, items, folder, order=b.LATEST, range_ms=b.TIME_RANGE_MS)
    train, test, _ = tables.read_splits(spark, folder)
    sides = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return sides.groupBy("user_id", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("latest")
    )


# ---- data-quality checks ----------------------------------------------------------


def _on_raw_and_clean(check, spark, sf):
    data = {"raw": b.interactions(spark, sf), "clean": b.clean(spark, sf)}
    rows = [check(df).select(F.lit(name).alias("data"), "*") for name, df in data.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def check_required_columns(spark, sf):
    return _on_raw_and_clean(quality.required_columns, spark, sf)


@query
def check_nulls(spark, sf):
    holed = b.interactions(spark, sf).withColumn(
        "rating", F.when(F.col("item_id") % 7 != 0, F.col("rating"))
    )
    return quality.nulls(holed)


@query
def check_rating_range(spark, sf):
    moved = b.interactions(spark, sf).withColumn("rating", F.col("rating") + 1)
    return quality.rating_range(moved)


@query
def check_duplicate_pairs(spark, sf):
    return _on_raw_and_clean(quality.duplicate_pairs, spark, sf)


@query
def check_timestamp_range(spark, sf):
    raw = b.interactions(spark, sf)
    data = {
        "seconds": raw,
        "milliseconds": raw.withColumn("timestamp", F.col("timestamp") * 1000),
        "future": raw.withColumn("timestamp", F.col("timestamp") + 900_000_000),
        "synthetic": raw.withColumn("timestamp", F.col("item_id")),
    }
    rows = [
        quality.timestamp_range(df).select(F.lit(name).alias("data"), "*")
        for name, df in data.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def check_pair_overlap(spark, sf):
    # Against the whole clean table every test pair is an overlap.
    train, test = b.train_test(spark, sf)
    rows = [
        quality.pair_overlap(side, test).select(F.lit(name).alias("data"), "*")
        for name, side in (("train", train), ("clean", b.clean(spark, sf)))
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def check_time_leakage(spark, sf):
    return _on_both_splits(quality.time_leakage, spark, sf)


def _holed_metadata(spark, sf):
    return b.metadata(spark, sf).withColumns(
        {
            "item_id": F.when(F.col("item_id") % 11 != 0, F.col("item_id")),
            "title": F.when(F.col("item_id") % 5 == 0, "  ").otherwise(F.col("title")),
            "main_category": F.when(F.col("item_id") % 13 != 0, F.col("main_category")),
        }
    )


def _on_both_metadata(check, spark, sf):
    data = {"given": b.metadata(spark, sf), "holed": _holed_metadata(spark, sf)}
    rows = [check(df).select(F.lit(name).alias("data"), "*") for name, df in data.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def check_item_key(spark, sf):
    return _on_both_metadata(quality.item_key, spark, sf)


@query
def check_empty_titles(spark, sf):
    return _on_both_metadata(quality.empty_titles, spark, sf)


@query
def check_category(spark, sf):
    return _on_both_metadata(quality.category, spark, sf)


@query
def category_cardinality(spark, sf):
    return quality.category_cardinality(b.metadata(spark, sf))


# ---- features ---------------------------------------------------------------------


@query
def user_features(spark, sf):
    return feat.user_features(b.train(spark, sf))


@query
def item_features(spark, sf):
    return feat.item_features(b.train(spark, sf), b.metadata(spark, sf))


@query
def global_mean(spark, sf):
    return feat.global_mean(b.train(spark, sf))


@query
def popular_items(spark, sf):
    return feat.popular_items(b.train(spark, sf), 100)


@query
def id_maps(spark, sf):
    users, items = feat.id_maps(b.train(spark, sf))
    return users.select(
        F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("user_index").alias("index")
    ).unionByName(
        items.select(
            F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("item_index").alias("index")
        )
    )


@query
def confidence_matrix(spark, sf):
    return feat.confidence_matrix(b.interactions(spark, sf))


@query
def score_feature_als(spark, sf):
    _, test = b.train_test(spark, sf)
    scored = als_score_pairs(_model(spark, sf), test, "model_a_score")
    return _checked_scores(_model(spark, sf), scored, "model_a_score")


def _neighbours(spark, sf):
    def make():
        train, _ = b.train_test(spark, sf)
        return settle(sim.neighbour_table(train, b.item_vectors(spark, sf)), "neighbours")

    return _once("neighbours", spark, sf, make)


def _fresh_neighbours(spark, sf):
    train, test = b.train_test(spark, sf)
    return sim.neighbour_table(train, b.item_vectors(spark, sf)), train, test


@query
def score_feature_semantic(spark, sf):
    near, train, test = _fresh_neighbours(spark, sf)
    scores = feat.semantic_scores(train, near)
    return feat.add_semantic_score(test.select("user_id", "item_id"), scores)


@query
def negative_samples(spark, sf):
    return feat.negative_samples(b.train(spark, sf))


@query
def sample_users(spark, sf):
    return feat.sample_users(b.train(spark, sf), 100)


@query
def ctr_dataset(spark, sf):
    # The first model's score has no SQL; it must be there and finite.
    score = F.abs("model_a_score") < float("inf")
    found = _ctr_dataset(spark, sf).withColumn("scored", F.coalesce(score, F.lit(False)))
    return found.drop("model_a_score")


@query
def class_balance(spark, sf):
    return feat.class_balance(feat.ctr_pairs(b.train(spark, sf)))


@query
def stratified_split(spark, sf):
    labelled = b.scored_pairs(spark, sf).select("user_id", "item_id", "label")
    return feat.stratified_split(labelled, "label", ["user_id", "item_id"])


# ---- retrieval and ranking models -------------------------------------------------


def _model(spark, sf):
    def make():
        return als_fit(b.train(spark, sf))

    return _once("als", spark, sf, make)


def _feature_tables(spark, sf):
    def make():
        train = b.train(spark, sf)
        users = settle(feat.user_features(train), "user-features")
        items = settle(feat.item_features(train, b.metadata(spark, sf)), "item-features")
        return users, items

    return _once("features", spark, sf, make)


def _ctr_dataset(spark, sf):
    users, items = _feature_tables(spark, sf)
    return training.build_ctr_dataset(
        b.train(spark, sf), users, items, _model(spark, sf), _neighbours(spark, sf)
    )


def _clicks(spark, sf):
    return _once("clicks", spark, sf, lambda: training.train_click_model(_ctr_dataset(spark, sf)))


def _all_finite(vector: str) -> Column:
    return F.forall(vector, lambda x: F.abs(x) < float("inf"))


def _sound_factors(model) -> DataFrame:
    """Per user and item: the length of its factors, and whether all are finite and some not zero."""
    sides = (("user", model.user_factors, "user_id"), ("item", model.item_factors, "item_id"))
    sound = _all_finite("vector") & F.exists("vector", lambda x: x != 0)
    rows = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("id"),
            F.size("vector").alias("rank"),
            sound.alias("sound"),
        )
        for kind, df, key in sides
    ]
    return reduce(DataFrame.unionByName, rows)


def _products(model, pairs: DataFrame) -> DataFrame:
    """The factor product of known pairs, taken apart from the operators, else null."""
    both = pairs.select("user_id", "item_id").distinct()
    both = both.join(model.user_factors.select("user_id", F.col("vector").alias("u")), "user_id")
    both = both.join(model.item_factors.select("item_id", F.col("vector").alias("i")), "item_id")
    cells = F.zip_with("u", "i", lambda u, i: u.cast("double") * i)
    return both.select("user_id", "item_id", F.aggregate(cells, F.lit(0.0), lambda s, v: s + v).alias("product"))


def _checked_scores(model, scored: DataFrame, name: str) -> DataFrame:
    """Known pairs score their factor product; of the others the score is shown."""
    joined = scored.join(_products(model, scored), ["user_id", "item_id"], "left")
    known = F.col("product").isNotNull()
    return joined.select(
        "user_id",
        "item_id",
        known.alias("known"),
        F.when(~known, F.col(name)).alias("mean"),
        F.coalesce(F.abs(F.col("product") - F.col(name)) < 1e-4, F.lit(True)).alias("fits"),
    )


def _checked_lists(lists: DataFrame, train: DataFrame, *labels: str) -> DataFrame:
    """Per user: list length, ranks 1 to n, scores that never rise, no item met in training."""
    met = train.select("user_id", "item_id").distinct().withColumn("_met", F.lit(1))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "score")))
    rows = lists.join(met, ["user_id", "item_id"], "left").groupBy("user_id", *labels)
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"), ordered.alias("_list"), F.count("_met").alias("_seen")
    )
    scores = F.transform("_list", lambda x: x["score"])
    ranks = F.transform("_list", lambda x: x["rank"].cast("int"))
    return found.select(
        "user_id",
        *labels,
        "rows",
        (ranks == F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("ranked"),
        (scores == F.sort_array(scores, asc=False)).alias("sorted"),
        (F.col("_seen") == 0).alias("unseen"),
    )


@query
def als_fit_(spark, sf):
    return _sound_factors(als_fit(b.train(spark, sf)))


@query
def als_score_pairs_(spark, sf):
    # Half of the pairs ask for an item nobody rated, and get the mean.
    _, test = b.train_test(spark, sf)
    unknown = F.when(F.col("item_id") % 2 == 0, -F.col("item_id") - 1).otherwise(F.col("item_id"))
    pairs = test.select("user_id", unknown.alias("item_id"))
    model = _model(spark, sf)
    return _checked_scores(model, als_score_pairs(model, pairs), "score")


@query
def als_top_n_(spark, sf):
    model = _model(spark, sf)
    lists = settle(als_top_n(model, 10), "lists")
    fits = _checked_scores(model, lists, "score").groupBy("user_id")
    right = fits.agg(F.bool_and(F.col("fits") & F.col("known")).alias("fits"))
    return _checked_lists(lists, b.train(spark, sf)).join(right, "user_id")


@query
def cold_start_fallback_(spark, sf):
    known = b.train(spark, sf).filter(F.col("user_id") % 3 != 0)
    return cold_start_fallback(b.users(spark, sf), known, 10)


@query
def text_vectors(spark, sf):
    texts = b.table(spark, sf, "documents").select("doc_id", "text")
    vectors = sim.text_vectors(texts, "doc_id")
    length = norm(F.col("embedding"))
    return vectors.select(
        "doc_id",
        F.size("embedding").alias("dimensions"),
        _all_finite("embedding").alias("finite"),
        (F.abs(length - 1) < 1e-3).alias("unit"),
    )


@query
def text_neighbours(spark, sf):
    """Item texts to vectors to the neighbours of all liked items, in one job."""
    vectors = settle(training.item_text_vectors(b.metadata(spark, sf)), "text-vectors")
    near = sim.neighbour_table(b.train(spark, sf), vectors, 10)
    score, place = F.col("_list.similarity"), F.col("_list.rank")
    listed = near.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "similarity", "neighbour_id"))).alias("_list")
    )
    return listed.select(
        "item_id",
        F.size("_list").alias("neighbours"),
        (place.cast("array<int>") == F.sequence(F.lit(1), F.size("_list"))).alias("ranked"),
        (score == F.sort_array(score, asc=False)).alias("sorted"),
        F.forall(score, lambda v: F.abs(v) <= 1 + 1e-6).alias("cosines"),
        (~F.array_contains("_list.neighbour_id", F.col("item_id"))).alias("others"),
    )


@query
def l2_normalise(spark, sf):
    scaled = b.item_vectors(spark, sf).withColumn(
        "embedding", F.transform("embedding", lambda x: x * (F.col("item_id") % 5 + 1).cast("float"))
    )
    unit = sim.normalised(scaled).withColumnRenamed("embedding", "unit")
    both = unit.join(b.item_vectors(spark, sf), "item_id")
    cosine = dot(F.col("unit"), F.col("embedding")) / norm(F.col("embedding"))
    return both.select(
        "item_id", F.round(norm(F.col("unit")), 4).alias("norm"), F.round(cosine, 4).alias("cosine")
    )


@query
def item_neighbours(spark, sf):
    return sim.item_neighbours(b.item_vectors(spark, sf), 10)


@query
def item_products_bounded(spark, sf):
    """Largest products with vectors as long as their item is popular: norms rule most items out."""
    met = b.train(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    vectors = b.item_vectors(spark, sf)
    weight = F.log1p(F.coalesce(F.col("n"), F.lit(0)).cast("double"))
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("weight"))
    items = vectors.join(met, "item_id", "left").withColumn("weight", weight).withColumn("vector", scaled)
    asked = vectors.select(F.col("item_id").alias("id"), F.col("embedding").alias("vector"))
    found = best_products_bounded(asked, items.select(F.col("item_id").alias("id"), "vector"), 10)
    return found.best.select(F.col("query_id").alias("asked_id"), "item_id", "score", "rank")


def _list_search(spark, sf) -> DataFrame:
    """One row: recall of the list search, compared share of the item pairs, products with centres."""
    vectors = b.item_vectors(spark, sf)
    asked = lists.build_lists(vectors)
    items = asked.count()
    found = sim.recall_against(lists.neighbours_in_lists(asked, 10), sim.item_neighbours(vectors, 10))
    return found.withColumns(
        {
            "share": lists.compared_pairs(asked, items).scalar(),
            "centre_share": F.lit(lists.list_counts(items)[0] / max(1, items - 1)),
        }
    )


@query
def item_neighbours_lsh(spark, sf):
    """Every item's list is nearly the exact one, for a quarter of the pairs."""
    return _list_search(spark, sf).select(
        (F.col("share") <= 0.25).alias("few_pairs"), (F.col("recall") >= 0.9).alias("found")
    )


@query
def item_neighbours_lists_figures(spark, sf):
    return _list_search(spark, sf)


@query
def neighbour_table(spark, sf):
    return _fresh_neighbours(spark, sf)[0]


@query
def persist_neighbours(spark, sf):
    path = scratch_path(spark, "neighbours")
    table = f"neighbours_{path.rsplit('-', 1)[1]}"
    models.save_neighbours(sim.item_neighbours(b.item_vectors(spark, sf), 10), path, table, 8)
    return models.load_neighbours(spark, path, table)


@query
def semantic_top_n(spark, sf):
    near, train, _ = _fresh_neighbours(spark, sf)
    return sim.semantic_top_n(train, near, 10)


@query
def restrict_to_train_items(spark, sf):
    learned = b.train(spark, sf).filter(F.col("rating") >= 5)
    rare = learned.groupBy("item_id").count().filter("count >= 5")
    return sim.restrict_to_train_items(b.metadata(spark, sf), rare).select("item_id", "title")


def _candidates(spark, sf):
    near, train, _ = _fresh_neighbours(spark, sf)
    lists = popular_for(train.select("user_id").distinct(), train, 100)
    return candidate_union(lists, sim.semantic_top_n(train, near, 100)), train


@query
def candidate_union_(spark, sf):
    return _candidates(spark, sf)[0]


@query
def candidate_features_(spark, sf):
    found, train = _candidates(spark, sf)
    items = feat.item_features(train, b.metadata(spark, sf))
    return candidate_features(found, feat.user_features(train), items)


@query
def ctr_fit(spark, sf):
    model, scored, metrics = _clicks(spark, sf)
    chance = (F.col("score") >= 0) & (F.col("score") <= 1)
    counted = scored.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(chance).alias("chances"))
    # Learned on four rows of five, the model must order the rest better than a coin.
    better = metrics.select((F.col("auc_roc") > 0.5).alias("better")).scalar()
    return counted.withColumns({"trees": F.lit(model.trees.getNumTrees), "better": better})


@query
def ctr_predict_(spark, sf):
    scored = ctr_predict(_clicks(spark, sf)[0], _ctr_dataset(spark, sf))
    chance = (F.col("ctr_score") >= 0) & (F.col("ctr_score") <= 1)
    return scored.select("user_id", "item_id", "label", chance.alias("chance"))


@query
def rerank_(spark, sf):
    found = als_top_n(_model(spark, sf), 100)
    scored = found.select("user_id", "item_id", F.col("score").alias("model_a_score"))
    return _checked_lists(rerank(_clicks(spark, sf)[0], scored, 10), b.train(spark, sf))


@query
def two_stage_top_n(spark, sf):
    train = b.train(spark, sf)
    users, items = _feature_tables(spark, sf)
    lists = serving.two_stage_top_n(
        _model(spark, sf), _clicks(spark, sf)[0], train, _neighbours(spark, sf), users, items, 10
    )
    return _checked_lists(lists, train)


@query
def variant_recommendations(spark, sf):
    lists = serving.variant_recommendations(
        _model(spark, sf), _clicks(spark, sf)[0], b.users(spark, sf)
    )
    return _checked_lists(lists, b.train(spark, sf), "variant")


@query
def feature_importance_(spark, sf):
    found = feature_importance(_clicks(spark, sf)[0], spark)
    total = found.agg(F.sum("importance")).scalar()
    sound = (F.col("importance") >= 0) & (F.abs(total - 1) < 1e-6)
    return found.select("feature", sound.alias("sound"))


def _in_range(metrics: DataFrame) -> DataFrame:
    """Metric names with whether the value can be: shares in [0, 1], the rest not negative."""
    share = F.col("metric").rlike("precision|recall|ndcg|auc_roc")
    signed = F.col("run_id") == "model_b_minus_a"
    value = F.col("value")
    sound = F.when(signed, F.abs(value) < 1e9).when(share, value.between(0, 1)).otherwise(value >= 0)
    return metrics.select("run_id", "metric", F.coalesce(sound, F.lit(False)).alias("sound"))


@query
def als_grid_search(spark, sf):
    """All 36 settings."""
    _, rows, best = training.als_grid_search(*b.train_test(spark, sf))
    top = rows.filter("metric = 'ndcg_at_10'").agg(F.max("value")).scalar()
    won = rows.filter((F.col("metric") == "ndcg_at_10") & (F.col("run_id") == best))
    is_best = won.select((F.col("value") == top)).scalar()
    return _in_range(rows).withColumn("best_wins", is_best)


@query
def training_job(spark, sf):
    train, test = b.train_test(spark, sf)
    rows = training.training_job(
        train, test, b.metadata(spark, sf), b.item_vectors(spark, sf),
        train_semantic=True, train_clicks=True,
    )
    return _in_range(rows)


@query
def save_models(spark, sf):
    path = scratch_path(spark, "models")
    models.save_collaborative(_model(spark, sf), f"{path}/collaborative")
    model = models.load_collaborative(spark, f"{path}/collaborative")
    models.save_click_model(_clicks(spark, sf)[0], spark, f"{path}/clicks")
    clicks = models.load_click_model(spark, f"{path}/clicks")
    users = model.user_factors.select(F.lit("user_factors").alias("part"), F.size("vector").alias("n"))
    items = model.item_factors.select(F.lit("item_factors").alias("part"), F.size("vector").alias("n"))
    saved = users.unionByName(items).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    return saved.withColumn("trees", F.lit(clicks.trees.getNumTrees))


# ---- ranking evaluation -----------------------------------------------------------


@query
def precision_at_k(spark, sf):
    lists, _, test = _popular_lists(spark, sf)
    return evaluate.precision_at_k(lists, test, 10)


@query
def recall_at_k(spark, sf):
    lists, _, test = _popular_lists(spark, sf)
    return evaluate.recall_at_k(lists, test, 10)


@query
def ndcg_at_k(spark, sf):
    lists, _, test = _popular_lists(spark, sf)
    return evaluate.ndcg_at_k(lists, test, 10)


@query
def mrr(spark, sf):
    lists, _, test = _popular_lists(spark, sf)
    return evaluate.mean_reciprocal_rank(lists, test)


@query
def evaluate_topn(spark, sf):
    lists, _, test = _popular_lists(spark, sf)
    return evaluate.evaluate_topn(lists, test)


@query
def evaluate_semantic(spark, sf):
    near, train, test = _fresh_neighbours(spark, sf)
    return training.evaluate_semantic(train, test, near)


@query
def evaluate_two_stage(spark, sf):
    train, test = b.train_test(spark, sf)
    users, items = _feature_tables(spark, sf)
    metrics = training.evaluate_two_stage(
        _model(spark, sf), _clicks(spark, sf)[0], train, test, _neighbours(spark, sf), users, items
    )
    return _in_range(evaluate.to_long(metrics).withColumn("run_id", F.lit("pipeline")))


@query
def rmse(spark, sf):
    return evaluate.rmse(b.scored_pairs(spark, sf))


@query
def auc_roc(spark, sf):
    return evaluate.auc_roc(b.scored_pairs(spark, sf))


@query
def log_loss(spark, sf):
    return evaluate.log_loss(b.scored_pairs(spark, sf), "probability")


@query
def compare_metric_sets(spark, sf):
    return evaluate.compare_metric_sets(*_two_metric_sets(spark, sf))


def _partly_cold(spark, sf):
    """Every seventh item is taken out of train, which makes it cold."""
    near, train, test = _fresh_neighbours(spark, sf)
    return near, train.filter(F.col("item_id") % 7 != 0), test


@query
def cold_start_segments(spark, sf):
    _, train, test = _partly_cold(spark, sf)
    return evaluate.cold_start_segments(train, test)


@query
def cold_start_metrics(spark, sf):
    _, train, test = _partly_cold(spark, sf)
    near = sim.neighbour_table(train, b.item_vectors(spark, sf))
    return training.cold_start_metrics(train, test, near, ks=[10])


# ---- experimentation --------------------------------------------------------------


@query
def assign_variant(spark, sf):
    return b.users(spark, sf).select(
        "user_id", experiment.assign_variant(F.col("user_id"), 0.29).alias("variant")
    )


@query
def route_traffic(spark, sf):
    rows = [
        experiment.logged_variants(experiment.route_traffic(b.users(spark, sf), mode)).select(
            F.lit(mode).alias("mode"), "user_id", "serving_variant", "variant"
        )
        for mode in experiment.MODES
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def variant_share(spark, sf):
    return experiment.variant_share(b.predictions(spark, sf))


@query
def ab_conversion(spark, sf):
    return experiment.ab_conversion(b.predictions(spark, sf), b.feedback(spark, sf))


@query
def ab_conversion_attributed(spark, sf):
    table = experiment.ab_conversion_attributed(b.predictions(spark, sf), b.feedback(spark, sf))
    return table.withColumns(
        {
            "variant": F.coalesce("variant", F.lit("none")),
            "conversion_rate": F.coalesce("conversion_rate", F.lit(-1.0)),
        }
    )


@query
def attributed_feedback(spark, sf):
    rows = experiment.attribute_feedback(b.predictions(spark, sf), b.feedback(spark, sf))
    return rows.select(
        "event_id",
        "action",
        F.coalesce("variant", F.lit("none")).alias("variant"),
        F.coalesce(F.unix_micros("predicted_at"), F.lit(0)).alias("predicted_at"),
    )


def _segments(spark, sf):
    """Click counts of both variants per value of the event's ``k`` modulo ten."""
    rows = b.events(spark, sf).select(
        (F.get_json_object("props", "$.k").cast("int") % 10).alias("segment"),
        experiment.assign_variant(F.col("user_id"), 0.5).alias("variant"),
        (F.col("event_type") == "click").alias("click"),
    )
    return rows.groupBy("segment", "variant").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("click").alias("clicks")
    )


@query
def two_proportion_z(spark, sf):
    sides = experiment.experiment_readout(_segments(spark, sf), ["segment"])
    return experiment.two_proportion_test(
        sides.select("segment", "clicks_a", "n_a", "clicks_b", "n_b")
    )


@query
def experiment_readout(spark, sf):
    table = experiment.ab_conversion_attributed(b.predictions(spark, sf), b.feedback(spark, sf))
    other = experiment.ab_conversion(b.predictions(spark, sf), b.feedback(spark, sf))
    return experiment.experiment_readout(table).unionByName(experiment.experiment_readout(other))


@query
def sample_size(spark, sf):
    rates = _segments(spark, sf).groupBy("segment").agg(
        (F.sum("clicks") / F.sum("n")).alias("base_rate")
    )
    return experiment.needed_samples(rates.withColumn("effect", F.lit(0.01)))


# ---- monitoring -------------------------------------------------------------------


@query
def kpis(spark, sf):
    return monitoring.kpis(b.predictions(spark, sf), b.feedback(spark, sf))


@query
def requests_per_minute(spark, sf):
    return monitoring.requests_per_minute(b.predictions(spark, sf))


@query
def variant_counts(spark, sf):
    return monitoring.variant_counts(b.predictions(spark, sf))


@query
def action_counts(spark, sf):
    return monitoring.action_counts(b.feedback(spark, sf))


@query
def feedback_hourly(spark, sf):
    return monitoring.feedback_hourly(b.feedback(spark, sf))


@query
def feedback_hourly_wide(spark, sf):
    return monitoring.feedback_hourly_wide(b.feedback(spark, sf), ["click", "purchase", "ignore", "rate"])


@query
def recent_predictions(spark, sf):
    return monitoring.recent_predictions(b.predictions(spark, sf), ties=["event_id"])


@query
def recent_feedback(spark, sf):
    return monitoring.recent_feedback(b.feedback(spark, sf), ties=["event_id"])


def _errors(spark, sf):
    return b.requests(spark, sf).filter("failed").withColumn("endpoint", F.lit("/recommend"))


@query
def event_counters(spark, sf):
    counted = monitoring.event_counters(
        b.requests(spark, sf), b.feedback(spark, sf), _errors(spark, sf)
    )
    return counted.na.fill("", ["variant", "status", "action", "endpoint"])


@query
def shared_event_counters(spark, sf):
    """All events are requests, some are feedback, failed ones are errors: one log."""
    kind = F.col("event_type")
    log = b.requests(spark, sf).select(
        "variant",
        "status",
        F.when(kind == "signup", "ignore").when(kind.isin("click", "purchase"), kind).alias("action"),
        F.when(F.col("failed"), "/recommend").alias("endpoint"),
    )
    counted = monitoring.shared_event_counters(log)
    return counted.na.fill("", ["variant", "status", "action", "endpoint"])


@query
def latency_histogram(spark, sf):
    return monitoring.latency_histogram(b.predictions(spark, sf))


@query
def score_histogram(spark, sf):
    scored = b.predictions(spark, sf).select("variant", F.explode("items").alias("item"))
    return monitoring.score_histogram(scored.withColumn("score", F.col("item").cast("double") / 20.0))


# ---- drift, alerts, promotion -----------------------------------------------------


@query
def reference_current_split(spark, sf):
    return _split_log(spark, sf).select("event_id", "part")


@query
def drift_numeric(spark, sf):
    return drift.drift_numeric(_split_log(spark, sf))


@query
def drift_categorical(spark, sf):
    return drift.drift_categorical(_split_log(spark, sf), ["variant", "request_dayofweek"])


@query
def drift_report(spark, sf):
    return drift.drift_report(_split_log(spark, sf))


@query
def drift_ks(spark, sf):
    return drift.drift_ks(_split_log(spark, sf))


@query
def drift_chi2(spark, sf):
    return drift.drift_chi2(_split_log(spark, sf), ["variant", "request_dayofweek"])


@query
def drift_wasserstein(spark, sf):
    return drift.drift_wasserstein(_split_log(spark, sf))


@query
def drift_result_rows(spark, sf):
    """Reports per variant, written as nested JSON from the log, and read back as rows."""
    cells = F.struct(
        F.max("value").alias("drift_score"),
        (F.max("value") > 200).alias("drift_detected"),
        F.lit("peak").alias("stattest_name"),
    )
    hours = b.events(spark, sf).groupBy("event_type", F.hour("ts").alias("hour")).agg(cells.alias("c"))
    entry = F.struct(F.concat(F.lit("hour_"), "hour").alias("key"), F.col("c").alias("value"))
    result = F.struct(
        (F.count_if("c.drift_detected") > 12).alias("dataset_drift"),
        F.count(F.lit(1)).alias("number_of_columns"),
        F.count_if("c.drift_detected").alias("number_of_drifted_columns"),
        F.map_from_entries(F.collect_list(entry)).alias("drift_by_columns"),
    )
    report = F.to_json(F.struct(F.array(F.struct(result.alias("result"))).alias("metrics")))
    return drift.drift_result_rows(hours.groupBy("event_type").agg(report.alias("report")))


def _summary(spark, sf):
    flagged = _split_log(spark, sf)
    return drift.drift_summary(flagged, drift.drift_columns(flagged))


@query
def alert_drift(spark, sf):
    return alerts.alert_drift(_summary(spark, sf))


@query
def alert_latency(spark, sf):
    rows = [
        alerts.alert_latency(b.predictions(spark, sf), limit) for limit in (5.0, 500.0)
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def alert_error_rate(spark, sf):
    return alerts.alert_error_rate(b.requests(spark, sf), F.col("failed"))


@query
def alerts_all(spark, sf):
    log = b.requests(spark, sf)
    return alerts.alerts_all(_summary(spark, sf), log, log, F.col("failed"), include_fallback=True)


@query
def run_metrics(spark, sf):
    return promotion.run_metrics(b.metric_table(spark, sf), ["mean_price", "spread"])


@query
def metric_improvements(spark, sf):
    return promotion.metric_improvements(*b.candidate_and_production(spark, sf))


@query
def promotion_decision(spark, sf):
    candidate, production = b.candidate_and_production(spark, sf)
    return promotion.promotion_decision(
        candidate, production.filter(~F.col("experiment").startswith("5"))
    )


@query
def canary_health(spark, sf):
    log = b.canary_feedback(spark, sf)
    asked = log.select("experiment").distinct()
    rows = [
        promotion.canary_health(log, asked, least, limit).select(
            F.lit(name).alias("rule"), "experiment", "status", "samples",
            F.coalesce("error_rate", F.lit(-1.0)).alias("error_rate"), "proceed",
        )
        for name, least, limit in (("default", 100, 0.05), ("lenient", 100, 0.5), ("large", 10**9, 0.05))
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def latest_deployment_state(spark, sf):
    return promotion.latest_deployment_state(b.state_history(spark, sf))


@query
def latest_version_per_stage(spark, sf):
    history = b.state_history(spark, sf).withColumnRenamed("experiment", "model")
    return promotion.latest_version_per_stage(history)


# ---- streaming --------------------------------------------------------------------


def _run_stream(stream: DataFrame, name: str) -> DataFrame:
    """Process all there is, append to files, and read the files."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _run_upserts(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Process all there is in update mode and read the latest row of each key."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    writer = live.start_upserts(stream, f"{path}/rows", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return live.latest_rows(spark.read.parquet(f"{path}/rows"), keys)


@query
def stream_requests_per_minute(spark, sf):
    rows = b.predictions_of(b.event_stream(spark, sf))
    return _run_upserts(live.stream_requests_per_minute(rows), "minutes", ["minute"])


@query
def stream_feedback_hourly(spark, sf):
    rows = b.feedback_of(b.event_stream(spark, sf))
    return _run_upserts(live.stream_feedback_hourly(rows), "hours", ["hour", "action"])


@query
def stream_counters(spark, sf):
    rows = b.requests_of(b.event_stream(spark, sf))
    labels = ["variant", "status"]
    return _run_upserts(live.stream_counters(rows, labels), "counters", labels)


@query
def stream_latency_histogram(spark, sf):
    rows = b.predictions_of(b.event_stream(spark, sf))
    return _run_upserts(
        live.stream_latency_histogram(rows, "1 day"), "histogram", ["start", "variant", "le"]
    )


@query
def stream_route(spark, sf):
    rows = b.requests_of(b.event_stream(spark, sf)).select("event_id", "user_id")
    routed = live.stream_route(rows, "canary")
    return _run_stream(routed, "routes").select("event_id", "serving_variant")


@query
def stream_attribution(spark, sf):
    """Every click, with the latest prediction before it where there is one."""
    shown = b.predictions_of(b.event_stream(spark, sf))
    given = b.feedback_of(b.event_stream(spark, sf)).filter(F.col("action") == "click")
    said = stream_attribute_feedback(shown.select("user_id", "timestamp", "variant"), given)
    rows = _run_upserts(said, "attribution", ["event_id"])
    return rows.select(
        "event_id",
        F.coalesce("variant", F.lit("none")).alias("variant"),
        F.coalesce(F.unix_micros("predicted_at"), F.lit(0).cast("long")).alias("predicted_at"),
    )


@query
def stream_alerts(spark, sf):
    rows = b.requests_of(b.event_stream(spark, sf))
    measured = live.stream_alerts(rows, F.col("failed"), latency_limit=60.0, error_limit=0.25)
    latest = _run_upserts(measured, "alerts", ["start"])
    return latest.filter(F.col("latency_alert") | F.col("error_alert"))


@query
def stream_dedup(spark, sf):
    rows = [b.requests_of(b.event_stream(spark, sf)).select("user_id", "timestamp") for _ in (0, 1)]
    once = _run_stream(live.stream_dedup(rows[0].unionByName(rows[1])), "dedup")
    return once.groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("latest"))
