"""Whitening of vectors: distributed centred covariance, leading eigenvectors, projection.

Two passes over the rows give the sums and then the products of centred rows; every task sends one
matrix as large as the covariance. That matrix, whose size does not depend on the rows, is
decomposed on the driver (``eigen``) and the projection is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.eigen import leading_eigenpairs
from ranklight.llm.vectors import integer_vectors, matrix, row_count_and_width, summed
from ranklight.session import settle

SCALE, SHIFT = 64, 1_000_000
#: Shares of the trace below this are rounding, not variance.
LEAST_SHARE = 1e-12
_MOST = 2**63 - 1


def _scaled_gaps(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit integers, or Python's where those might not hold it."""
    if n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) > _MOST:
        x, sums = x.astype(object), sums.astype(object)
    return n * x - sums


def _deviations(gaps: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; None where a 64-bit integer does not hold it."""
    most = int(np.abs(gaps).max(initial=0))
    if most * most * max(1, gaps.shape[1]) <= _MOST:
        return (gaps * gaps).sum(axis=1).tolist()
    rows = [sum(int(v) ** 2 for v in row) for row in gaps]
    return [r if r <= _MOST else None for r in rows]


@dataclass(frozen=True)
class Whitening:
    """Rows, sums, variances (falling), unit directions as columns, and the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = (_scaled_gaps(x, self.n, self.sums) / self.n).astype(float)
        return centred @ (self.directions / np.sqrt(self.values))


def fit_whitening(rows: DataFrame, components: int = 32) -> Whitening:
    """The leading components of integer vectors ``x``; those without variance are left out."""
    n, width = row_count_and_width(rows)
    if not n or not width:
        return Whitening(n, np.zeros(width, np.int64), np.zeros(0), np.zeros((width, 0)), 0.0)
    sums = summed(rows, lambda x: x.sum(axis=0, keepdims=True), "long")[0]

    def products(x: np.ndarray) -> np.ndarray:
        centred = (_scaled_gaps(x, n, sums) / n).astype(float)
        return centred.T @ centred

    covariance = summed(rows, products, "double") / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, directions = leading_eigenpairs(covariance, components)
    some = values > LEAST_SHARE * trace
    return Whitening(n, sums, values[some], directions[:, some], trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, in two more passes."""
    if not len(model.values):
        return 0.0
    spread = rows.sparkSession.sparkContext.broadcast(model)
    mean = summed(rows, lambda x: spread.value.whitened(x).sum(axis=0, keepdims=True), "double")[0] / model.n

    def products(x: np.ndarray) -> np.ndarray:
        centred = spread.value.whitened(x) - mean
        return centred.T @ centred

    covariance = summed(rows, products, "double") / model.n
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(rows: DataFrame, model: Whitening, keep: list[str]) -> DataFrame:
    """``keep``, ``deviation`` and ``whitened``, one number for each component.

    ``deviation`` is the exact sum of (n * x - S)^2, null where it exceeds 64 bits.
    """
    spread = rows.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "deviation long, whitened array<double>"])

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spread.value
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                deviation = pa.array(_deviations(_scaled_gaps(x, own.n, own.sums)), pa.int64())
                out = pa.array(list(own.whitened(x)), pa.list_(pa.float64()))
                columns = [*(batch.column(c) for c in keep), deviation, out]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "deviation", "whitened"])

    return rows.select(*keep, "x").mapInArrow(projected, schema)


def whitening_digest(vectors: DataFrame, components: int = 32) -> DataFrame:
    """One row for each kept vector and component.

    Rows whose vector is null or holds null or non-finite entries are left out; null and repeated
    ids stay. Components without variance (all of them for a single row) are left out,
    so an empty table and equal vectors give no rows. Vectors must be equally long. Further columns
    are not looked at.
    """
    rows = settle(integer_vectors(vectors, ["vec_id"], SCALE, SHIFT), "whitening-vectors")
    model = fit_whitening(rows, components)
    explained = [float(v / model.trace) for v in model.values]
    shares = F.lit(explained) if explained else F.lit(None).cast("array<double>")
    found = whiten(rows, model, ["vec_id"])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(identity_error(rows, model)).alias("identity_error"),
    )
