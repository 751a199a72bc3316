"""Product codes of vectors; the nearest codebook entry is found in a metric tree of ranges.

Vectors of integers are cut into equal parts, and each part is coded by the nearest entry of its
place's codebook. Codebooks are refined in rounds: every task finds the nearest entries of its rows
and sends sums per entry, so a round moves a few numbers for each task whatever the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.vectors import integer_vectors, matrix, row_count_and_width, summed
from ranklight.session import settle

SCALE = 4096
#: Squared distances of parts stay exact in 64 bits below this.
LARGEST = 1 << 26


def square_roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The square roots of integers, rounded down and rounded up."""
    low = np.sqrt(squares.astype(float)).astype(np.int64)
    low -= low * low > squares
    low += (low + 1) * (low + 1) <= squares
    return low, low + (low * low < squares)


@dataclass
class _Node:
    """Split points, and how far the points below split j are from split i, at least and at most.

    ``low[i, j]`` to ``high[i, j]`` holds split j itself where i and j differ.
    """

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    below: list[_Node | None] = field(default_factory=list)


class RangeTree:
    """Geometric near-neighbour access tree over integer points; ties go to the lower index."""

    def __init__(self, points: np.ndarray, arity: int = 4):
        self.points = np.asarray(points, np.int64)
        # Of equal points only the first can be the answer.
        first = np.unique(self.points, axis=0, return_index=True)[1]
        self.arity = arity
        self.root = self._built(np.sort(first)) if len(first) else None

    def _squares(self, queries: np.ndarray, point: int) -> np.ndarray:
        gap = queries - self.points[point]
        return (gap * gap).sum(axis=1)

    def _built(self, ids: np.ndarray) -> _Node:
        own = self.points[ids]
        # Split points far from each other: each next one is the farthest from those before.
        chosen = [0]
        nearest = self._squares(own, ids[0])
        squares = [nearest]
        while len(chosen) < min(self.arity, len(ids)):
            chosen.append(int(nearest.argmax()))
            squares.append(self._squares(own, ids[chosen[-1]]))
            nearest = np.minimum(nearest, squares[-1])
        squares = np.array(squares)
        side = squares.argmin(axis=0)
        low, high = square_roots(squares)
        m = len(chosen)
        ranges = np.zeros((2, m, m), np.int64)
        below: list[_Node | None] = []
        is_split = np.isin(np.arange(len(ids)), chosen)
        for j in range(m):
            group = np.flatnonzero(side == j)
            rest = group[~is_split[group]]
            for i in range(m):
                members = rest if i == j else group
                some = len(members) > 0
                # An empty range, nearest beyond farthest, is always eliminated.
                ranges[0, i, j] = low[i, members].min() if some else np.iinfo(np.int64).max // 4
                ranges[1, i, j] = high[i, members].max() if some else -(np.iinfo(np.int64).max // 4)
            below.append(self._built(ids[rest]) if len(rest) else None)
        return _Node(ids[chosen], ranges[0], ranges[1], below)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query's nearest point and the squared distance, exact.

        A subtree goes only if its whole range lies strictly beyond the best distance, with all
        roots rounded to the side that keeps it; what is left is decided by integer squares.
        """
        best = np.full(len(queries), np.iinfo(np.int64).max)
        where = np.zeros(len(queries), np.int64)
        self.computed = 0
        stack = [(self.root, np.arange(len(queries)))] if self.root else []
        while stack:
            node, rows = stack.pop()
            alive = np.ones((len(rows), len(node.splits)), bool)
            for i, point in enumerate(node.splits):
                at = np.flatnonzero(alive[:, i])
                own = rows[at]
                square = self._squares(queries[own], point)
                self.computed += len(own)
                better = (square < best[own]) | ((square == best[own]) & (point < where[own]))
                best[own[better]], where[own[better]] = square[better], point
                low, high = square_roots(square)
                reach = square_roots(best[own])[1]
                beyond = (low[:, None] - node.high[i] > reach[:, None]) | (
                    node.low[i] - high[:, None] > reach[:, None]
                )
                alive[at] &= ~beyond
            for child, keep in zip(node.below, alive.T):
                if child is not None and keep.any():
                    stack.append((child, rows[keep]))
        return where, best


def nearest_entries(x: np.ndarray, trees: list[RangeTree]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each row and part, and the squared distances."""
    if np.abs(x).max(initial=0) >= LARGEST:
        raise ValueError(f"components beyond {LARGEST} have no exact squared distances")
    cut = np.split(x, len(trees), axis=1)
    found = [tree.nearest(part) for tree, part in zip(trees, cut)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _first_books(rows: DataFrame, key: str, parts: int, entries: int, width: int) -> np.ndarray:
    """The parts of the rows with the smallest keys (at most ``entries`` rows reach the driver)."""
    first = rows.orderBy(F.asc_nulls_last(key), "x").limit(entries).select("x").collect()
    values = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width // parts)
    return values.transpose(1, 0, 2)


def fit_codebooks(
    rows: DataFrame, key: str = "vec_id", parts: int = 8, entries: int = 16, rounds: int = 6
) -> np.ndarray:
    """Codebooks by part, entry and position of integer vectors ``x``.

    They start as the parts of the rows with the smallest keys (ties by vector, null keys last; with
    fewer rows there are fewer entries). A round moves each entry to the componentwise
    floor of the mean of its parts; entries without parts stay.
    """
    n, width = row_count_and_width(rows)
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    books = _first_books(rows, key, parts, entries, width)
    for _ in range(rounds if n else 0):
        trees = [RangeTree(book) for book in books]
        shape = books.shape

        def totals(x: np.ndarray) -> np.ndarray:
            # One line for each part and entry: the sums by position, and the count.
            chosen = nearest_entries(x, trees)[0] + np.arange(shape[0]) * shape[1]
            out = np.zeros((shape[0] * shape[1], shape[2] + 1), np.int64)
            np.add.at(out[:, :-1], chosen.ravel(), x.reshape(chosen.size, shape[2]))
            out[:, -1] = np.bincount(chosen.ravel(), minlength=len(out))
            return out

        sums = summed(rows, totals, "long").reshape(*shape[:2], -1)
        count = sums[:, :, -1:]
        books = np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), books)
    return books


def code_vectors(rows: DataFrame, books: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep``, ``code`` (the entry of each part) and ``error`` (squared distances, summed)."""
    trees = rows.sparkSession.sparkContext.broadcast([RangeTree(book) for book in books])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "code array<int>", "error long"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                entry, square = nearest_entries(matrix(batch.column("x")), trees.value)
                code = pa.array(list(entry.astype(np.int32)), pa.list_(pa.int32()))
                own = [*(batch.column(c) for c in keep), code, pa.array(square.sum(axis=1))]
                yield pa.RecordBatch.from_arrays(own, [*keep, "code", "error"])

    return rows.select(*keep, "x").mapInArrow(coded, schema)


def decode_vectors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """Add ``x``, the entries that the code names, one part after another."""
    table = F.lit([[list(map(int, entry)) for entry in book] for book in books])
    chosen = F.transform("code", lambda entry, part: F.get(F.get(table, part), entry))
    return codes.withColumn("x", F.flatten(chosen))


def code_digest(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6
) -> DataFrame:
    """Per kept row its code in hex, its error, its label's error, and the codebooks' digest.

    Rows whose vector is null or holds null or non-finite components are left out; null and
    repeated ids and labels are values like others (null labels form one group). An empty table
    gives no rows. Vectors must be equally long and cut into equal parts. Further columns are not
    looked at.
    """
    kept = settle(integer_vectors(vectors, ["vec_id", "label"], SCALE), "code-vectors")
    books = fit_codebooks(kept, "vec_id", parts, entries, rounds)
    codes = settle(code_vectors(kept, books, ["vec_id", "label"]), "codes")
    # Totals by label are written first, so that the join knows how small they are.
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = settle(totals.withColumnRenamed("label", "of_label"), "label-errors")
    named = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    pairs = F.transform("code", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id",
        F.array_join(pairs, "").alias("code"),
        "error",
        "label_error",
        F.lit(named).alias("codebooks_sha256"),
    )


def _sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same in SQL: every entry is compared, once for each round."""
    steps = [
        f"""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r, len(v) // {parts} AS w FROM kept),
cut AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * w + 1, p * w + w) AS x FROM numbered, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, r AS e, x AS c FROM cut WHERE r < {entries})"""
    ]
    square = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, p, x, m % {entries} AS e, m // {entries} AS d FROM (
    SELECT r, cut.p, any_value(x) AS x, min(CAST({square} AS BIGINT) * {entries} + e) AS m
    FROM cut JOIN b{k} ON cut.p = b{k}.p GROUP BY r, cut.p))"""
        )
        if k < rounds:
            steps.append(
                f"""b{k + 1} AS MATERIALIZED (
  SELECT o.p, o.e, coalesce(f.c, o.c) AS c FROM b{k} o LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT p, e, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY p, e, i)
    GROUP BY p, e) f ON o.p = f.p AND o.e = f.e)"""
            )
    return (
        ",\n".join(steps)
        + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256
FROM numbered JOIN coded USING (r), books"""
    )


SQL = _sql()
