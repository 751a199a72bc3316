"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the rows by a seeded hash into buckets of bounded memory. Pass two
shuffles each bucket with Fisher and Yates' algorithm; the buckets, one after the other, are the new
order of all rows, which is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklight.llm.common import parts_for


def fisher_yates(n: Column, seed: int, bucket: Column) -> Column:
    """A permutation of 0 to n-1 by n-1 swaps with hashed draws, the same on every run."""
    last_to_second = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    start = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def swap(order: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        # Both swapped items as one-item slices; everything around them keeps its place.
        swapped = F.concat(
            F.slice(order, F.lit(1), j),
            F.slice(order, i + 1, F.lit(1)),
            F.slice(order, j + 2, i - j - 1),
            F.slice(order, j + 1, F.lit(1)),
            F.slice(order, i + 2, n),
        )
        return F.when(j == i, order).otherwise(swapped)

    return F.aggregate(last_to_second, start, swap)


def external_shuffle(
    rows: DataFrame,
    size: Column,
    seed: int = 17,
    bucket_bytes: int = 16 << 20,
    bucket_rows: int = 1024,
) -> DataFrame:
    """All rows as ``record`` with ``position``, their 0-based place in the shuffled order, and ``total``.

    ``size`` is the memory a row takes. Buckets hold about ``bucket_bytes`` and
    ``bucket_rows``. The hash covers every column, and equal rows, which are
    counted before they are scattered, get different numbers, so neither a hot key nor a
    repeated row fills a bucket. The order depends on rows and seed alone.
    """
    names = rows.columns
    sized = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("record"), size.alias("size"))
    found = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(parts_for(found[0], bucket_rows), parts_for(found[1], bucket_bytes))
    copies = (
        sized.groupBy("record")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("record", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    # A null takes the hash's seed along unchanged, so nulls need no value of their own.
    draw = F.xxhash64(F.lit(seed), F.col("record"), F.col("copy"))
    scattered = copies.select(
        F.pmod(draw, F.lit(buckets)).alias("bucket"), draw.alias("draw"), "copy", "record"
    )
    gathered = scattered.groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("draw", "record", "copy"))).alias("rows")
    )
    before = W.partitionBy("group").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = (
        scattered.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("rows_here"))
        .withColumn("group", F.floor(F.col("bucket") / 4096))
        .withColumn("in_group", F.coalesce(F.sum("rows_here").over(before), F.lit(0)))
    )
    earlier = W.orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = (
        counts.groupBy("group")
        .agg(F.sum("rows_here").alias("group_rows"))
        .withColumn("groups_before", F.coalesce(F.sum("group_rows").over(earlier), F.lit(0)))
    )
    offsets = counts.join(groups, "group").select(
        "bucket", (F.col("in_group") + F.col("groups_before")).alias("offset")
    )
    permuted = gathered.join(offsets, "bucket").select(
        "offset",
        F.posexplode(
            F.transform(
                fisher_yates(F.size("rows"), seed, F.col("bucket")),
                lambda p: F.get(F.col("rows"), p)["record"],
            )
        ).alias("place", "record"),
    )
    return permuted.select(
        "record",
        (F.col("offset") + F.col("place")).alias("position"),
        F.lit(int(found[0])).cast("long").alias("total"),
    )


def shard_rows(rows: DataFrame, size: Column, shards: int = 8, **shuffle) -> DataFrame:
    """Each row as ``record`` with its ``shard`` and its 0-based ``slot`` there.

    The shuffled order is cut at the multiples of total / shards. Row counts differ by one
    at most; with fewer rows than shards some shards stay empty; an empty table gives none.
    """
    placed = external_shuffle(rows, size, **shuffle).withColumn(
        "shard", F.expr(f"CAST((position * {int(shards)}) DIV total AS INT)")
    )
    first = F.expr(f"(shard * total + {int(shards) - 1}) DIV {int(shards)}")
    return placed.select("record", "shard", (F.col("position") - first).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text", **shuffle) -> DataFrame:
    """The documents with ``shard`` and ``slot``, ready for ``write_shards``.

    A null text takes one byte. Input columns called shard or slot are replaced. All
    columns must be comparable (no maps).
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = shard_rows(docs.select(*[f"`{c}`" for c in kept]), size, shards, **shuffle)
    return placed.select("record.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str, records_per_file: int = 1_000_000) -> None:
    """Write one folder per shard, each file in slot order and of bounded length."""
    chunk = F.floor(F.col("slot") / records_per_file)
    (
        sharded.withColumn("chunk", chunk)
        .repartition("shard", "chunk")
        .sortWithinPartitions("shard", "slot")
        .drop("chunk")
        .write.partitionBy("shard")
        .parquet(path)
    )


def shard_digest(docs: DataFrame, shards: int = 8, **shuffle) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Read off the records that ``shard_documents`` places, so the texts go through the buckets. Law
    ``rows``: counts differ by one at most. A null text has size 1 and checksum 0; null and
    repeated ids are rows like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return shard_documents(docs, shards, **shuffle).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
