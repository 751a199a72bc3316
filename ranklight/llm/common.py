"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.session import scratch_path

#: The white space of the contracts, and the letters that are lower-cased.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def id_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that name a row by its id and text; equal rows share it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in (doc_id, text)]
    return F.struct(
        F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b")
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def parts_for(size: int, each: int) -> int:
    """How many parts of about ``each`` hold ``size``; at least one."""
    return max(1, -(-int(size) // int(each)))


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of all texts (one row reaches the driver)."""
    found = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return int(found[0]), int(found[1])


def bucketed(rows: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write rows as a table bucketed by ``key`` in the shared folder, and read it.

    What is later joined to the rows by that key is moved to them; the rows, which hold texts, are
    not moved again. The table is external: only its files need to be removed later.
    """
    path = scratch_path(rows.sparkSession, name)
    table_name = path.rsplit("/", 1)[-1].replace("-", "_")
    writer = rows.write.format("parquet").bucketBy(buckets, key).option("compression", "zstd")
    writer.option("path", path).saveAsTable(table_name)
    return rows.sparkSession.table(table_name)


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece stay below ``limit`` bytes, or are one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
