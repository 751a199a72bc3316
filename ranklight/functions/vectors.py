"""Vector expressions; sums are taken in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def l2_normalise(vector: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    length = norm(vector)
    scale = F.when(length > 0, length).otherwise(F.lit(1.0))
    return F.transform(vector, lambda x: (x.cast("double") / scale).cast("float"))
