"""Vectors as integers: what a row needs to take part, and sums over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integer_vectors(
    vectors: DataFrame, columns: list[str], scale: int, shift: int = 0, vector: str = "embedding"
) -> DataFrame:
    """``columns`` and ``x``, floor(scale * component) + shift of every component.

    Rows whose vector is null or holds null or non-finite components are left out. A component
    too large for a 64-bit integer is an error.
    """

    def unfit(value):
        number = value.cast("double")
        return value.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))

    def whole(value):
        return F.floor(value.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift)

    fit = F.col(vector).isNotNull() & ~F.exists(vector, unfit)
    return vectors.filter(fit).select(*columns, F.transform(vector, whole).alias("x"))


def row_count_and_width(rows: DataFrame) -> tuple[int, int]:
    """Rows, and the length that all ``x`` share (0 for an empty table)."""
    n, least, most = rows.agg(
        F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))
    ).first()
    if least != most:
        raise ValueError(f"vectors differ in length: {least} to {most}")
    return int(n), int(most or 0)


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, equally long, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def summed(rows: DataFrame, each: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all batches of ``each(x)``, a matrix of one shape, of type ``kind``.

    Every task adds up what it has read and sends that one matrix; Spark sums the cells. The driver
    gets one matrix, whose size does not depend on the rows.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = each(matrix(batch.column("x")))
                total = found if total is None else total + found
        if total is not None:
            lines = [pa.array(range(len(total))), pa.array(list(total))]
            yield pa.RecordBatch.from_arrays(lines, ["line", "cells"])

    cells = rows.select("x").mapInArrow(own, f"line long, cells array<{kind}>")
    cells = cells.select("line", F.posexplode("cells").alias("place", "cell"))
    table = cells.groupBy("line", "place").agg(F.sum("cell").alias("cell")).toPandas()
    if not len(table):
        return np.zeros((0, 0))
    shape = table["line"].max() + 1, table["place"].max() + 1
    out = np.zeros(shape, np.int64 if kind == "long" else float)
    out[table["line"], table["place"]] = table["cell"]
    return out
