"""Hash expressions shared by routing, sampling and dense ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(value: Column) -> Column:
    """The first eight hex digits of the md5 of the value's text, as a number."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_percent(value: Column) -> Column:
    """A stable bucket 0..99 per value."""
    return hash_number(value) % F.lit(100)


def draw_key(seed: int, *values: Column) -> Column:
    """A stable pseudo-random text key; ordering by it shuffles rows reproducibly."""
    parts = [v.cast("string") for v in values]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def draw_bucket(key: Column) -> Column:
    """An order-preserving, evenly filled bucket of a draw key (65,536 of them)."""
    return F.substring(key, 1, 4)
