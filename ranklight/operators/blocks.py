"""Best inner products between two vector tables, block by block.

Rows are packed into blocks of bounded size by a hash of their id. A task holds one block of
queries and the blocks of all items pass through it one after another: each side is shuffled
once, and only the best n rows per query leave the task, so neither vectors nor pairs are
replicated on disk. Where only rows of equal groups meet, cells are spread over a (stripe, chunk)
grid instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ranklight.operators.ordering import top_n

ROWS_PER_BLOCK = 2048
_CELLS = 2_000_000  # numbers in one packed block
_SEEN = 200_000  # pairs left out that go with one block of queries


def block_of(identifier: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(identifier.cast("string")), blocks).cast("int")


def _packed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per block: its ids in ascending order and their vectors alongside.

    Ids are unique and hashed, so a block holds about ``ROWS_PER_BLOCK`` rows.
    """
    rows = F.array_sort(F.collect_list(F.struct("id", "vector")))
    packed = df.groupBy(*keys).agg(rows.alias("rows"))
    return packed.select(
        *keys,
        F.col("rows.id").alias(f"{prefix}_ids"),
        F.col("rows.vector").alias(f"{prefix}_vectors"),
    )


def best_products(
    queries: DataFrame,
    items: DataFrame,
    n: int,
    *,
    exclude_self: bool = False,
    seen: DataFrame | None = None,
    group: str | None = None,
    digits: int | None = 9,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Rows ``query_id, item_id, score, rank``: the n largest inner products per query.

    ``queries`` and ``items`` have ``id, vector``; with ``group`` both also carry that
    column and only rows of equal groups meet. ``seen(query_id, item_id)`` rows, which carry the
    group too, are left out. Scores are rounded to ``digits`` before ranking; ties go to the smaller id.
    """
    if n <= 0:
        raise ValueError(f"n must be positive, got {n}")
    queries, items = (x.filter(F.col("vector").isNotNull()) for x in (queries, items))
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["id"].dataType),
            T.StructField("item_id", items.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    if group:
        cells = _grouped_cells(queries, items, seen, group, rows_per_block)
        found = cells.mapInArrow(_cell_worker(n, exclude_self, digits), schema)
        found = found.groupBy("query_id", "item_id").agg(F.max("score").alias("score"))
    else:
        cells = _streamed_cells(queries, items, seen, rows_per_block)
        found = cells.mapInArrow(_stream_worker(n, exclude_self, digits, rows_per_block), schema)
    return top_n(found, ["query_id"], [F.desc("score"), "item_id"], n)


def _streamed_cells(
    queries: DataFrame, items: DataFrame, seen: DataFrame | None, rows_per_block: int
) -> DataFrame:
    """Every packed block of items beside every packed block of queries, one block of queries a partition.

    The partition holds its block of queries and reads the items' exchange anew, so nothing is
    written for a cell.
    """
    rows, width = (x or 0 for x in queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first())
    count = items.count()
    most = max(rows_per_block, _CELLS // max(1, width))
    tasks = 4 * queries.sparkSession.sparkContext.defaultParallelism
    per_block = min(max(rows_per_block, -(-rows // tasks)), most)
    if seen is not None:
        per_block = max(1, min(per_block, _SEEN * rows // max(1, seen.count())))
    blocks = max(1, -(-rows // per_block))
    chunks = max(1, -(-count // min(most, 8 * rows_per_block)))

    left = queries.select("id", "vector", block_of(F.col("id"), F.lit(blocks)).alias("_block"))
    right = items.select("id", "vector", block_of(F.col("id"), F.lit(chunks)).alias("_chunk"))
    packed = _packed(left, ["_block"], "q")
    if seen is not None:
        pairs = seen.select(
            block_of(F.col("query_id"), F.lit(blocks)).alias("_block"),
            F.struct(F.col("query_id").alias("q"), F.col("item_id").alias("i")).alias("_pair"),
        )
        masks = pairs.groupBy("_block").agg(F.collect_set("_pair").alias("_pairs"))
        packed = packed.join(masks, "_block", "left").select(
            *packed.columns, F.col("_pairs.q").alias("seen_q"), F.col("_pairs.i").alias("seen_i")
        )
    placed = packed.repartitionById(blocks, F.col("_block"))
    passing = _packed(right, ["_chunk"], "i").drop("_chunk").repartition(1)
    return passing.crossJoin(placed.hint("shuffle_replicate_nl"))


def _grouped_cells(
    queries: DataFrame, items: DataFrame, seen: DataFrame | None, group: str, rows_per_block: int
) -> DataFrame:
    """Each block of queries beside each block of items of its group."""
    spark = queries.sparkSession
    parallelism = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group]
    sizes = items.groupBy(group).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_block)).cast("int").alias("_chunks")
    )
    sizes = queries.groupBy(group).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_block)).cast("int").alias("_blocks")
    ).join(sizes, group)
    left = queries.join(sizes, group)
    right = items.join(sizes, group)

    stripes = F.least(
        F.col("_blocks"), F.greatest(F.lit(1), F.floor(F.lit(parallelism) / F.col("_chunks")))
    ).cast("int")
    left = left.withColumns({"_block": block_of(F.col("id"), F.col("_blocks")), "_stripes": stripes})
    right = right.withColumns({"_chunk": block_of(F.col("id"), F.col("_chunks")), "_stripes": stripes})

    packed_left = _packed(left, [*keys, "_block", "_chunks", "_stripes"], "q").withColumns(
        {
            "_stripe": F.col("_block") % F.col("_stripes"),
            "_chunk": F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)),
        }
    )
    packed_right = _packed(right, [*keys, "_chunk", "_stripes"], "i").withColumn(
        "_stripe", F.explode(F.sequence(F.lit(0), F.col("_stripes") - 1))
    )
    masked = []
    if seen is not None:
        placed = seen.join(sizes, group).select(
            *keys,
            block_of(F.col("query_id"), F.col("_blocks")).alias("_block"),
            block_of(F.col("item_id"), F.col("_chunks")).alias("_chunk"),
            F.struct(F.col("query_id").alias("q"), F.col("item_id").alias("i")).alias("_pair"),
        )
        # Distinct pairs of one cell: at most block size times block size, hashed evenly.
        masks = placed.groupBy(*keys, "_block", "_chunk").agg(F.collect_set("_pair").alias("_pairs"))
        packed_left = packed_left.join(masks, [*keys, "_block", "_chunk"], "left").withColumns(
            {"seen_q": F.col("_pairs.q"), "seen_i": F.col("_pairs.i")}
        )
        masked = ["seen_q", "seen_i"]
    # A cell is few bytes but much arithmetic, so the number of partitions is fixed here
    # instead of being merged by size.
    cell = [*keys, "_stripe", "_chunk"]
    return (
        packed_left.select(*cell, "q_ids", "q_vectors", *masked)
        .repartition(parallelism, *cell)
        .join(packed_right.select(*cell, "i_ids", "i_vectors").repartition(parallelism, *cell), cell)
        .select("q_ids", "q_vectors", "i_ids", "i_vectors", *masked)
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    lengths = set(pc.list_value_length(vectors).to_pylist())
    if len(lengths) > 1:
        raise ValueError(f"vectors of one block differ in length: {sorted(lengths)}")
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(vectors), -1)


def _best_of_cell(
    queries: np.ndarray,
    items: np.ndarray,
    banned: tuple[np.ndarray, np.ndarray] | None,
    n: int,
    digits: int | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and loss of the n smallest losses per row; ties go to the first column."""
    # Losses are negated products: the smallest n per row are wanted. Rounded
    # products are compared exactly, so they are computed in double precision.
    kind = np.float32 if digits is None else np.float64
    losses = np.negative(queries, dtype=kind) @ items.astype(kind).T
    if digits is not None:
        losses = np.round(losses, digits)
    if banned is not None:
        losses[banned] = np.inf
    keep = min(n, losses.shape[1])
    limit = np.partition(losses, keep - 1, axis=1)[:, keep - 1]
    row, col = np.nonzero((losses <= limit[:, None]) & (losses < np.inf))
    return _first_of_rows(row, col, losses[row, col].astype(np.float64), keep)


def _first_of_rows(
    row: np.ndarray, tie: np.ndarray, loss: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((tie, loss, row))
    row, tie, loss = row[order], tie[order], loss[order]
    first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < n
    return row[first], tie[first], loss[first]


def _positions(ids: pa.Array, wanted: pa.Array) -> np.ndarray:
    return pc.index_in(wanted, value_set=ids).to_numpy(zero_copy_only=False)


def _banned(
    q_ids: pa.Array, i_ids: pa.Array, exclude_self: bool, seen: tuple[pa.Array, pa.Array] | None
) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows and columns of the pairs of a cell that do not count."""
    if exclude_self:
        same = pc.index_in(q_ids, value_set=i_ids)
        rows = np.nonzero(np.asarray(same.is_valid()))[0]
        return rows, same.drop_null().to_numpy()
    if seen is not None:
        met = [_positions(q_ids, seen[0]), _positions(i_ids, seen[1])]
        # A seen item without a vector is in no block and bans nothing.
        there = ~(np.isnan(met[0].astype(float)) | np.isnan(met[1].astype(float)))
        return tuple(x[there].astype(int) for x in met)
    return None


def _seen_of(cells: dict[str, pa.Array], at: int) -> tuple[pa.Array, pa.Array] | None:
    if "seen_q" not in cells or not cells["seen_q"][at].is_valid:
        return None
    return cells["seen_q"][at].values, cells["seen_i"][at].values


class _Best:
    """The n best items so far of each query of one block.

    Once a query has n items, a single-precision product says which further pairs can come before the
    last of them; only these are computed as the result wants them.
    """

    def __init__(
        self,
        ids: pa.Array,
        vectors: np.ndarray,
        seen: tuple[pa.Array, pa.Array] | None,
        n: int,
        exclude_self: bool,
        digits: int | None,
        tile: int,
    ):
        self.ids, self.vectors, self.seen = ids, vectors, seen
        self.n, self.exclude_self, self.digits, self.tile = n, exclude_self, digits, tile
        self.single = vectors.astype(np.float32)
        self.norms = np.linalg.norm(vectors.astype(np.float64), axis=1)
        self.limit = np.full(len(ids), np.inf)  # loss of the n-th item, infinite before there is one
        self.row, self.loss, self.items = np.zeros(0, int), np.zeros(0), None
        self.waiting: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def meet(self, ids: pa.Array, vectors: np.ndarray) -> None:
        banned = _banned(self.ids, ids, self.exclude_self, self.seen)
        norms = np.linalg.norm(vectors.astype(np.float64), axis=1)
        for left in range(0, len(self.ids), self.tile):
            rows = np.arange(left, min(left + self.tile, len(self.ids)))
            own = None
            if banned is not None:
                inside = (banned[0] >= left) & (banned[0] <= rows[-1])
                own = tuple(x[inside] for x in banned)
            for first in range(0, len(ids), self.tile):
                cols = slice(first, min(first + self.tile, len(ids)))
                out = None
                if own is not None:
                    inside = (own[1] >= first) & (own[1] < cols.stop)
                    out = own[0][inside] - left, own[1][inside] - first
                self._tile(rows, ids[cols], vectors[cols], float(norms[cols].max(initial=0)), out)

    def _tile(self, rows, ids, items, longest, banned) -> None:
        # Beyond these lengths single precision says nothing; the comparison is false for NaN.
        usable = self.norms[rows] * longest < 1e30
        closed = np.isfinite(self.limit[rows]) & usable
        for some, search in ((~closed, self._all_pairs), (closed, self._few_pairs)):
            if not some.any():
                continue
            own, out = rows, banned
            if not some.all():
                own = rows[some]
                if banned is not None:
                    inside = some[banned[0]]
                    out = np.cumsum(some)[banned[0][inside]] - 1, banned[1][inside]
            row, col, loss = search(own, items, longest, out)
            if len(row):
                self.waiting.append((own[row], loss, ids.take(pa.array(col))))
        if not closed.all() or sum(len(w[0]) for w in self.waiting) > max(50_000, len(self.ids) * self.n // 2):
            self._settle()

    def _all_pairs(self, rows, items, longest, banned):
        return _best_of_cell(self.vectors[rows], items, banned, self.n, self.digits)

    def _few_pairs(self, rows, items, longest, banned):
        products = self.single[rows] @ items.astype(np.float32).T
        if banned is not None:
            products[banned] = -np.inf
        limit = self.limit[rows]
        least = -limit
        if self.digits is not None:
            # What rounding adds to a product in single precision at most, twice, and the last digit.
            width = products.dtype.type(2.0**-23) * (items.shape[1] + 8)
            least = least - self.norms[rows] * longest * width - 2 * 10.0**-self.digits
        row, col = np.nonzero(products >= least.astype(np.float32)[:, None])
        if self.digits is None:
            loss = np.negative(products[row, col]).astype(np.float64)
        else:
            loss = np.empty(len(row))
            for part in np.array_split(np.arange(len(row)), -(-len(row) * items.shape[1] // _CELLS) or 1):
                left, right = (x.astype(np.float64) for x in (self.vectors[rows[row[part]]], items[col[part]]))
                loss[part] = np.round(-np.einsum("ij,ij->i", left, right), self.digits)
        near = loss <= limit[row]
        return _first_of_rows(row[near], col[near], loss[near], self.n)

    def _settle(self) -> None:
        """Take what waits into the best n per query."""
        if not self.waiting:
            return
        kept = [] if self.items is None else [(self.row, self.loss, self.items)]
        row, loss, items = zip(*kept, *self.waiting)
        row, loss, items = np.concatenate(row), np.concatenate(loss), pa.concat_arrays(items)
        # The place in the order of ids, in which ties go to the first.
        place = pc.rank(items, null_placement="at_start", tiebreaker="first").to_numpy()
        at = np.empty(len(items), int)
        at[place.astype(int) - 1] = np.arange(len(items))
        self.row, place, self.loss = _first_of_rows(row, place, loss, self.n)
        self.items = items.take(pa.array(at[place.astype(int) - 1]))
        self.waiting = []
        counts = np.bincount(self.row, minlength=len(self.ids))
        full = counts >= self.n
        self.limit[full] = self.loss[np.cumsum(counts)[full] - 1]

    def rows(self) -> pa.RecordBatch | None:
        self._settle()
        if self.items is None:
            return None
        found = [self.ids.take(pa.array(self.row)), self.items, pa.array(0.0 - self.loss)]
        return pa.RecordBatch.from_arrays(found, names=["query_id", "item_id", "score"])


def _stream_worker(n: int, exclude_self: bool, digits: int | None, tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Best] = {}
        for batch in batches:
            cells = {name: batch.column(name) for name in batch.schema.names}
            for at in range(batch.num_rows):
                block = cells["_block"][at].as_py()
                if block not in held:
                    ids, vectors = cells["q_ids"][at].values, _matrix(cells["q_vectors"][at].values)
                    seen = _seen_of(cells, at)
                    # Copies, so that the batch itself can go.
                    ids = ids.take(pa.array(np.arange(len(ids))))
                    if seen is not None:
                        seen = tuple(x.take(pa.array(np.arange(len(x)))) for x in seen)
                    held[block] = _Best(ids, vectors.copy(), seen, n, exclude_self, digits, tile)
                held[block].meet(cells["i_ids"][at].values, _matrix(cells["i_vectors"][at].values))
        for best in held.values():
            rows = best.rows()
            if rows is not None:
                yield rows

    return run


def _cell_worker(n: int, exclude_self: bool, digits: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = {name: batch.column(name) for name in batch.schema.names}
            for at in range(batch.num_rows):
                q_ids, i_ids = cells["q_ids"][at].values, cells["i_ids"][at].values
                row, col, loss = _best_of_cell(
                    _matrix(cells["q_vectors"][at].values),
                    _matrix(cells["i_vectors"][at].values),
                    _banned(q_ids, i_ids, exclude_self, _seen_of(cells, at)),
                    n,
                    digits,
                )
                yield pa.RecordBatch.from_arrays(
                    [q_ids.take(pa.array(row)), i_ids.take(pa.array(col)), pa.array(0.0 - loss)],
                    names=["query_id", "item_id", "score"],
                )

    return run
