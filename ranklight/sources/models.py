"""Persisted models and the neighbour table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.operators.collaborative import CollaborativeModel, als_fit
from ranklight.operators.ranker import ClickModel

# Settings of the model that is trained when none was saved.
RETRAIN = {"n_factors": 50, "n_epochs": 10}


def save_collaborative(model: CollaborativeModel, path: str) -> None:
    model.user_factors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.item_factors.write.mode("overwrite").parquet(f"{path}/item_factors")
    model.train.select("user_id", "item_id", "rating").write.mode("overwrite").parquet(
        f"{path}/train"
    )


def load_collaborative(spark: SparkSession, path: str) -> CollaborativeModel | None:
    try:
        parts = [spark.read.parquet(f"{path}/{p}") for p in ("user_factors", "item_factors", "train")]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return CollaborativeModel(*parts)


def load_or_train(spark: SparkSession, path: str, train: DataFrame) -> tuple[CollaborativeModel, str]:
    """The saved model, or a new one that is saved at once, and where it came from."""
    model = load_collaborative(spark, path)
    if model is not None:
        return model, "loaded"
    model = als_fit(train, **RETRAIN)
    save_collaborative(model, path)
    return model, "trained"


def save_click_model(model: ClickModel, spark: SparkSession, path: str) -> None:
    model.trees.write().overwrite().save(f"{path}/trees")
    columns = spark.createDataFrame(list(enumerate(model.columns)), "position int, name string")
    columns.write.mode("overwrite").parquet(f"{path}/columns")


def load_click_model(spark: SparkSession, path: str) -> ClickModel | None:
    """None when none was saved; serving then keeps the retrieval order."""
    try:
        columns = spark.read.parquet(f"{path}/columns")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    names = tuple(r["name"] for r in columns.orderBy("position").collect())
    return ClickModel(names, GBTClassificationModel.load(f"{path}/trees"))


def save_neighbours(
    neighbours: DataFrame, path: str, table: str | None = None, buckets: int = 64
) -> None:
    """As a table bucketed by item, so that joins on the item need no exchange; or as plain files."""
    if table is None:
        neighbours.write.mode("overwrite").parquet(path)
        return
    writer = neighbours.repartition(buckets, "item_id").write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "item_id").sortBy("item_id").option("path", path).saveAsTable(table)


def load_neighbours(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    return spark.table(table) if table else spark.read.parquet(path)


def similar_items(neighbours: DataFrame, item_id, n: int = 10) -> DataFrame:
    """Neighbours of one item; an unknown item has none."""
    return neighbours.filter((F.col("item_id") == item_id) & (F.col("rank") <= n)).orderBy("rank")
