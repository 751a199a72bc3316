"""Item vectors, nearest items, and recommendations from liked items."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.functions.vectors import l2_normalise
from ranklight.operators.blocks import ROWS_PER_BLOCK, best_products
from ranklight.operators.features import liked_items
from ranklight.operators.lists import item_neighbours_lists
from ranklight.operators.ordering import top_n

NEIGHBOURS = 20


def text_vector_model(texts: DataFrame, dimensions: int = 384) -> Pipeline:
    """Fitted weighting of hashed words to unit vectors over ``text``."""
    stages = [
        Tokenizer(inputCol="text", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0),
    ]
    return Pipeline(stages=stages).fit(texts)


def text_vectors(texts: DataFrame, key: str, model=None, dimensions: int = 384) -> DataFrame:
    """``key, embedding``: unit vectors of whole texts."""
    model = model or text_vector_model(texts, dimensions)
    vectors = model.transform(texts)
    return vectors.select(key, vector_to_array("_unit", "float32").alias("embedding"))


def normalised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    return vectors.withColumn(column, l2_normalise(F.col(column)))


def restrict_to_train_items(metadata: DataFrame, train: DataFrame) -> DataFrame:
    return metadata.join(train.select("item_id").distinct(), "item_id", "left_semi")


def item_neighbours(
    vectors: DataFrame, n: int = 10, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Exact: rows ``item_id, neighbour_id, similarity, rank``, itself left out."""
    sides = vectors.select(F.col("item_id").alias("id"), F.col("embedding").alias("vector"))
    best = best_products(sides, sides, n, exclude_self=True, rows_per_block=rows_per_block)
    return _as_neighbours(best)


def _as_neighbours(best: DataFrame) -> DataFrame:
    return best.select(
        F.col("query_id").alias("item_id"),
        F.col("item_id").alias("neighbour_id"),
        F.col("score").alias("similarity"),
        "rank",
    )


def hyperplane_buckets(
    vectors: DataFrame,
    tables: int = 12,
    bits: int | None = None,
    target_bucket: int = 256,
    least_bits: int = 6,
    seed: int = 42,
) -> DataFrame:
    """``id, vector, _bucket``: each item once for each table, by the sides of ``bits`` random planes.

    Without ``bits`` their number grows with the logarithm of items over ``target_bucket``, so
    a bucket's expected size does not grow with the catalogue. Null vectors are left out.
    """
    named = vectors.select(F.col("item_id").alias("id"), F.col("embedding").alias("vector"))
    named = named.filter(F.col("vector").isNotNull())
    if bits is None:
        count = max(1, named.count())
        bits = max(least_bits, ceil(log2(count / target_bucket)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(batch.num_rows, -1).astype(float)
            planes = np.random.default_rng(seed).normal(size=(matrix.shape[1], tables * bits))
            sides = (matrix @ planes > 0).reshape(batch.num_rows, tables, bits)
            keys = sides @ (1 << np.arange(bits, dtype=np.int64))
            own = pa.array(list(keys), pa.list_(pa.int64()))
            yield batch.append_column("keys", own)

    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    schema = f"id {kinds['id']}, vector {kinds['vector']}, keys array<long>"
    slots = named.mapInArrow(hashed, schema).select(
        "id", "vector", F.posexplode("keys").alias("_table", "_key")
    )
    return slots.select("id", "vector", F.xxhash64("_table", "_key").alias("_bucket"))


def compared_share(buckets: DataFrame, items: int) -> DataFrame:
    """One row ``share``: pairs inside buckets, repeats over the tables counted, over all pairs."""
    sizes = buckets.groupBy("_bucket").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = F.sum(F.col("n") * (F.col("n") - 1))
    return sizes.agg((pairs / F.lit(float(max(1, items * (items - 1))))).alias("share"))


def item_neighbours_lsh(
    vectors: DataFrame, n: int = 10, rows_per_block: int = ROWS_PER_BLOCK, **hashing
) -> DataFrame:
    """Approximate: only items on the same sides of all planes of some table are compared.

    A bucket of any size is compared block by block, so one that holds a large share
    of the items is split over tasks and never emits its pairs. ``hashing`` goes to
    ``hyperplane_buckets``.
    """
    sides = hyperplane_buckets(vectors, **hashing)
    best = best_products(
        sides, sides, n, exclude_self=True, group="_bucket", rows_per_block=rows_per_block
    )
    return _as_neighbours(best)


def recall_against(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate table also lists."""
    keys = ["item_id", "neighbour_id"]
    hit = exact.join(approximate.select(*keys, F.lit(1).alias("_hit")), keys, "left")
    return hit.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def neighbour_table(
    train: DataFrame, vectors: DataFrame, n: int = NEIGHBOURS, approximate: bool = False
) -> DataFrame:
    """Top neighbours of every liked item, for user scores and recommendations.

    The exact form compares each liked item with all items; ``approximate`` compares only
    those in the inverted lists that it asks, for catalogues too large for that.
    """
    liked = liked_items(train).select("item_id").distinct()
    if approximate:
        return item_neighbours_lists(vectors, n).join(liked, "item_id", "left_semi")
    asked = vectors.join(liked, "item_id", "left_semi")
    named = [F.col("item_id").alias("id"), F.col("embedding").alias("vector")]
    return _as_neighbours(
        best_products(asked.select(*named), vectors.select(*named), n, exclude_self=True)
    )


def semantic_top_n(train: DataFrame, neighbours: DataFrame, n: int = 10) -> DataFrame:
    """Per user the n unseen items with the highest mean similarity to the liked items
    that list them."""
    listed = neighbours.groupBy("item_id").agg(
        F.collect_list(F.struct("neighbour_id", "similarity")).alias("_listed")
    )
    found = (
        liked_items(train)
        .select("user_id", "item_id")
        .join(listed, "item_id")
        .select("user_id", F.inline("_listed"))
        .groupBy("user_id", F.col("neighbour_id").alias("item_id"))
        .agg(F.round(F.avg("similarity"), 9).alias("score"))
    )
    unseen = found.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return top_n(unseen, ["user_id"], [F.desc("score"), "item_id"], n)
