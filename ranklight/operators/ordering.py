"""Ranks, running sums and order statistics that never put one group into one task.

Every helper works in two levels. Rows carry an order-preserving bucket; per-bucket
totals (one small row per bucket) are accumulated first, and the window over full
rows only spans one bucket of one key. A key that holds a third of all rows is
thereby spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_LOWEST = -(2**62)
RANGES = 1024


def range_bounds(
    values: DataFrame, value: str, key: str | None = None, ranges: int = RANGES
) -> Column:
    """Bounds that cut the rows into ranges of nearly equal size, from a quantile sketch.

    A scalar array, or with ``key`` a scalar map of one for each key (for few keys). The sketch's
    rank error is a twentieth of a range.
    """
    shares = [k / ranges for k in range(1, ranges)]
    sketch = F.percentile_approx(F.col(value).cast("double"), shares, 20 * ranges)
    if key is None:
        return values.agg(sketch.alias("bounds")).scalar()
    each = values.groupBy(key).agg(sketch.alias("bounds"))
    return each.agg(F.map_from_entries(F.collect_list(F.struct(key, "bounds")))).scalar()


def add_range(
    values: DataFrame, value: str, key: str | None = None, ranges: int = RANGES, name: str = "_range"
) -> DataFrame:
    """Add the order-preserving number of each value's range; equal values share it, NaN is last.

    Meant for distinct values: then no range holds many more rows than another, however narrow or
    wide the values lie. Rows with null get null.
    """
    held = range_bounds(values, value, key, ranges)
    bounds = held if key is None else F.element_at(held, F.col(key))
    number = F.col(value).cast("double")
    steps = [1 << k for k in range((ranges - 1).bit_length() - 1, -1, -1)] or [1]
    found = F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda at, step: F.when(F.get(F.col("_bounds"), at + step - 1) <= number, at + step).otherwise(at),
    )
    with_bounds = values.withColumn("_bounds", bounds)
    return with_bounds.withColumn(name, F.when(number.isNotNull(), found)).drop("_bounds")


def bucket_offsets(
    df: DataFrame, keys: Sequence[str], bucket: str, sums: Mapping[str, Column]
) -> DataFrame:
    """Per (keys, bucket): each sum here, over the earlier buckets, and over the whole key."""
    partial = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(f"_s_{n}") for n, v in sums.items()])
    return _accumulated(partial, keys, bucket, sums)


def _accumulated(
    partial: DataFrame, keys: Sequence[str], bucket: str, names: Iterable[str]
) -> DataFrame:
    earlier = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    columns = []
    for name in names:
        total = F.sum(f"_s_{name}")
        columns.append(F.col(f"_s_{name}").alias(f"{name}_here"))
        columns.append(F.coalesce(total.over(earlier), F.lit(0)).alias(f"{name}_before"))
        columns.append(total.over(whole).alias(f"{name}_total"))
    return partial.select(*keys, bucket, *columns)


def _tagged(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    tagged = df.withColumn("_bucket", bucket)
    lowest = "" if tagged.schema["_bucket"].dataType.typeName() == "string" else _LOWEST
    tagged = tagged.withColumn("_bucket", F.coalesce("_bucket", F.lit(lowest)))
    return tagged.dropna(subset=list(keys)).repartition(*keys, "_bucket")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    totals: bool = False,
) -> DataFrame:
    """Add ``name`` (inclusive running sum in total order) and, on request, ``name_total``.

    ``order`` must be total within a key and ``bucket`` must not decrease along it; a
    null bucket comes first. Rows without a key belong to no sum and are left out.
    """
    tagged = _tagged(df, keys, bucket)
    # The checksum makes the bucket totals read every column. Both branches then need
    # the same exchange, Spark runs it once, and the input is not computed twice.
    checksum = F.bit_xor(F.xxhash64(*df.columns)).alias("_checksum")
    partial = (
        tagged.groupBy(*keys, "_bucket")
        .agg(checksum, *[F.sum(v).alias(f"_s_{n}") for n, v in sums.items()])
        .filter(F.col("_checksum").isNotNull())
    )
    offsets = _accumulated(partial, keys, "_bucket", sums)
    local = (
        W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    windowed = tagged.withColumns({f"_r_{n}": F.sum(v).over(local) for n, v in sums.items()})
    joined = windowed.join(offsets, [*keys, "_bucket"])
    added = {n: F.col(f"_r_{n}") + F.col(f"{n}_before") for n in sums}
    if totals:
        added |= {f"{n}_total": F.col(f"{n}_total") for n in sums}
    return joined.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    name: str = "position",
    totals: bool = False,
) -> DataFrame:
    """``row_number`` per key by the two-level scan."""
    return running_sums(df, keys, bucket, order, {name: F.lit(1)}, totals)


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, name: str = "rank"
) -> DataFrame:
    """First n rows per key with their 1-based rank.

    Spark applies the limit inside each map task before the exchange, so a hot key
    sends at most n rows per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def exact_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row ``quantile``: the exact linearly interpolated quantile, null when empty.

    Works on counts per distinct value; the values are never gathered in one task.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    ranged = add_range(counts, "_value")
    ranked = running_sums(ranged, [], F.col("_range"), ["_value"], {"_seen": F.col("_count")}, totals=True)
    target = (F.col("_seen_total") - 1) * F.lit(float(q))
    below, above = F.floor(target), F.ceil(target)
    first, last = F.col("_seen") - F.col("_count"), F.col("_seen") - 1

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col("_value")))

    return ranked.agg(
        at(below).alias("_low"), at(above).alias("_high"), F.max(target - below).alias("_share")
    ).select((F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("quantile"))


def dense_ids(values: DataFrame, column: str, name: str) -> DataFrame:
    """Dense 0-based ids of the distinct values, in md5 order of the value."""
    keyed = values.select(column).distinct().withColumn("_key", F.md5(F.col(column).cast("string")))
    ranked = row_numbers(keyed, [], F.substring("_key", 1, 4), ["_key", column], "_row")
    return ranked.select(column, (F.col("_row") - 1).cast("int").alias(name))
