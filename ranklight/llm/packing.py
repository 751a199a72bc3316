"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most one sequence. Pieces are dealt into blocks of bounded
size; several islands evolve packings of the same block in separate tasks and send their best
packing to the next island between epochs. The emptiest sequences of all blocks are
packed once more together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ranklight.llm.common import parts_for, pieces
from ranklight.llm.tokens import text_ids, word_ids
from ranklight.session import settle

END_ID = 1


def piece_rows(ids: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids, four bytes each."""
    step = 4 * length
    return [
        (k, k * length, len(part) // 4, zlib.crc32(part))
        for k, part in enumerate(ids[a : a + step] for a in range(0, len(ids), step))
    ]


def document_pieces(docs: DataFrame, vocabulary: str, length: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; null text is empty.

    The vocabulary file is read here and sent to the tasks; its size does not grow with the data.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(content.value)
        for batch in pieces(batches, "text", 4 << 20):
            rows, source = [], []
            for i, ids in enumerate(text_ids(known, batch.column("text"))):
                own = piece_rows(ids.astype("<u4").tobytes() + end, length)
                rows += own
                source += [i] * len(own)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(source)), *columns], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


_PIECE_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.int64())


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Put ``items``, largest first, each into the fullest bin with room, else a new one.

    ``bins`` holds the bin of each size, -1 for the items; numbers are made dense.
    """
    out = bins.copy()
    placed = np.flatnonzero(out >= 0)
    labels, dense = np.unique(out[placed], return_inverse=True)
    out[placed] = dense
    free = capacity - np.bincount(dense, sizes[placed], len(labels)).astype(int)
    room = sorted((int(f), b) for b, f in enumerate(free) if f > 0)
    count = len(labels)
    for item in items[np.argsort(-sizes[items], kind="stable")]:
        size = int(sizes[item])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, count
            count += 1
        out[item] = b
        if left > size:
            insort(room, (left - size, b))
    return out


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones; larger is better."""
    fill = np.bincount(bins, sizes) / capacity
    return -len(fill), float((fill**2).sum())


def crossover(
    sizes: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int, draw: np.random.Generator
) -> np.ndarray:
    """Inject well-filled bins of ``father`` into ``mother`` and best-fit what they displace."""
    fill = np.bincount(father, sizes) / capacity
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = good[draw.random(len(good)) < draw.uniform(0.1, 0.6)]
    injected = np.isin(father, chosen)
    hit = np.isin(mother, np.unique(mother[injected]))
    child = np.where(injected, mother.max() + 1 + father, np.where(hit, -1, mother))
    return best_fit(sizes, np.flatnonzero(child < 0), child, capacity)


def mutate(
    sizes: np.ndarray, bins: np.ndarray, capacity: int, draw: np.random.Generator
) -> np.ndarray:
    """Empty the least filled bins and a few others; best-fit their items in another order."""
    fill = np.bincount(bins, sizes)
    worst = np.argsort(fill, kind="stable")[: max(1, len(fill) // 50)]
    gone = np.union1d(worst, draw.integers(0, len(fill), max(1, len(fill) // 50)))
    child = np.where(np.isin(bins, gone), -1, bins)
    return best_fit(sizes, draw.permutation(np.flatnonzero(child < 0)), child, capacity)


def evolve(
    sizes: np.ndarray,
    arrived: list[np.ndarray],
    capacity: int,
    seed: list[int],
    population: int = 6,
    children: int = 24,
) -> np.ndarray:
    """The best packing after some generations; ``arrived`` are packings to start from.

    Ends early at the lower bound, total size over capacity.
    """
    draw = np.random.default_rng(seed)
    n = len(sizes)
    least = -(-int(sizes.sum()) // capacity)
    none = np.full(n, -1)
    people = list(arrived) or [best_fit(sizes, np.arange(n), none, capacity)]
    while len(people) < population and -fitness(sizes, people[0], capacity)[0] > least:
        # Best fit in the order of sizes blurred by a random amount.
        order = np.argsort(-sizes * draw.uniform(0.8, 1.25, n), kind="stable")
        start = none.copy()
        start[order[: n // 2]] = best_fit(
            sizes[order[: n // 2]], np.arange(n // 2), np.full(n // 2, -1), capacity
        )
        people.append(best_fit(sizes, order[n // 2 :], start, capacity))
    rated = sorted(((fitness(sizes, p, capacity), k) for k, p in enumerate(people)), reverse=True)
    for _ in range(children):
        if -rated[0][0][0] <= least or len(people) < 2:
            break
        a, b = draw.choice(len(rated), 2, replace=False)
        a, b = min(a, b), max(a, b)
        child = crossover(sizes, people[rated[b][1]], people[rated[a][1]], capacity, draw)
        if draw.random() < 0.5:
            child = mutate(sizes, child, capacity, draw)
        value = fitness(sizes, child, capacity)
        if value > rated[-1][0]:
            people[rated[-1][1]] = child
            rated[-1] = (value, rated[-1][1])
            rated.sort(reverse=True)
    return people[rated[0][1]]


_ORDER = ["length", "ids_crc32", "doc_id", "piece"]


def _ordered(items: pd.DataFrame) -> pd.DataFrame:
    """The same order of a block's pieces in every task that gets them."""
    return items.sort_values(_ORDER, ascending=[False, True, True, True], ignore_index=True)


def _block_packed(items: DataFrame, blocks: int, level: int, capacity: int, islands: int, epochs: int):
    """Items with ``bin`` (unique over blocks) and its ``fill``."""
    names = items.columns
    key = F.xxhash64(F.lit(level), "doc_id", "piece", "ids_crc32", "copy")
    dealt = items.withColumn("block", F.pmod(key, F.lit(blocks)).cast("long"))
    islanded = dealt.withColumn("island", F.explode(F.lit(list(range(islands)))))

    def evolution(epoch: int):
        def evolved(key, own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
            if not len(own):
                return pd.DataFrame({"block": [], "island": [], "bins": []})
            sizes = _ordered(own)["length"].to_numpy()
            arrived = [np.asarray(b, int) for b in sent["bins"]]
            arrived.sort(key=lambda b: fitness(sizes, b, capacity), reverse=True)
            best = evolve(sizes, arrived, capacity, [level, epoch, *map(int, key)])
            return pd.DataFrame({"block": [key[0]], "island": [key[1]], "bins": [best.astype(np.int32)]})

        return evolved

    schema = "block long, island int, bins array<int>"
    empty = items.sparkSession.createDataFrame([], schema)
    best = empty
    for epoch in range(epochs):
        # Each island keeps its best packing and gets that of the island before it.
        both = best.unionByName(best.withColumn("island", (F.col("island") + 1) % islands))
        best = (
            islanded.groupBy("block", "island")
            .cogroup(both.groupBy("block", "island"))
            .applyInPandas(evolution(epoch), schema)
        )

    def finished(key, own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return own.assign(bin=0, fill=0)[[*names, "bin", "fill"]]
        own = _ordered(own)
        sizes = own["length"].to_numpy()
        packings = [np.asarray(b, int) for b in found.sort_values("island")["bins"]]
        bins = max(packings, key=lambda b: fitness(sizes, b, capacity))
        fill = np.bincount(bins, sizes).astype(int)
        own["bin"] = ((2 * int(key[0]) + level) << 24) + bins
        own["fill"] = fill[bins]
        return own[[*names, "bin", "fill"]]

    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return (
        dealt.groupBy("block")
        .cogroup(best.groupBy("block"))
        .applyInPandas(finished, f"{out}, bin long, fill long")
    )


def pack_pieces(
    found: DataFrame, capacity: int = 4096, block_rows: int = 4000, islands: int = 2, epochs: int = 2
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    Needs doc_id, piece, length and ids_crc32. Equal pieces are counted and numbered, so
    even one piece repeated in a third of all rows is dealt over all blocks.
    """
    names = found.columns
    numbered = (
        found.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("copies"))
        .select(*names, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    rows = found.count()
    first = settle(
        _block_packed(numbered, parts_for(rows, block_rows), 0, capacity, islands, epochs), "packed"
    )
    # The emptiest sequence of each block may hold what fits into another block's.
    is_open = F.col("fill") < int(0.98 * capacity)
    open_rows = first.filter(is_open).select(*names, "copy")
    open_count = open_rows.count()
    second = _block_packed(open_rows, parts_for(open_count, 4 * block_rows), 1, capacity, islands, epochs)
    both = first.filter(~is_open).unionByName(second)

    before = W.partitionBy("bin").orderBy("doc_id", "piece", "copy").rowsBetween(W.unboundedPreceding, -1)
    return both.select(
        *names,
        F.col("bin").alias("sequence_id"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, length: int = 4096, **settings) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A null or empty text is the end id alone. Null and repeated ids are documents like others; an
    empty table gives no rows. Further columns are not looked at.
    """
    found = settle(document_pieces(docs, vocabulary, length), "pieces")
    return pack_pieces(found, length, **settings)
