"""Reviews, item metadata and split tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight import schemas


def _scan(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    df = spark.read.schema(schema).format(fmt).load(path)
    return df.withColumnRenamed("parent_asin", "item_id")


def hash_share(df: DataFrame, share: float, *keys: str, seed: int = 42) -> DataFrame:
    """A reproducible share of the rows, chosen by a hash of ``keys`` in every task alike."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000))
    return df.filter(drawn < int(share * 1_000_000))


def load_reviews(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _scan(spark, path, schemas.REVIEWS, fmt)


def load_metadata(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _scan(spark, path, schemas.METADATA, fmt)


def write_splits(
    train: DataFrame, test: DataFrame, metadata: DataFrame | None, folder: str
) -> None:
    tables = {"train": train, "test": test, "metadata": metadata}
    for name, df in tables.items():
        if df is not None:
            df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def read_splits(
    spark: SparkSession, folder: str
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Train, test, and metadata if it was written."""
    train = spark.read.parquet(f"{folder}/train.parquet")
    test = spark.read.parquet(f"{folder}/test.parquet")
    try:
        metadata = spark.read.parquet(f"{folder}/metadata.parquet")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        metadata = None
    return train, test, metadata
