"""Packing by the histogram of lengths: combinations of few lengths that fill a window exactly.

How often each combination is used solves a non-negative least-squares problem against the
histogram, which is as long as a window whatever the documents. Documents then look their place up
by length and rank; those that no combination takes are packed greedily in blocks and cut where
a sequence has room left, so that no sequence is padded.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import parts_for
from ranklight.llm.tokens import text_ids, word_ids
from ranklight.operators.ordering import row_numbers
from ranklight.session import scratch_path, settle

END_ID = 1
_RANKS = 44  # bits of a rank within one length


# ---- the plan: lengths, combinations, counts -------------------------------------


def combinations(histogram: np.ndarray) -> np.ndarray:
    """Rows of three rising lengths (0: none) that occur and fill a power of two up to the window.

    ``histogram[l]`` counts length l and is as long as the window and one.
    """
    window = len(histogram) - 1
    there = histogram > 0
    there[0] = False
    found = [np.zeros((0, 3), np.int64)]
    while window >= 1:
        own = np.flatnonzero(there[: window + 1])
        if there[window]:
            found.append(np.array([[0, 0, window]]))
        first = own[own <= window // 2]
        first = first[there[window - first]]
        found.append(np.stack([np.zeros_like(first), first, window - first], axis=1))
        for least in own[3 * own <= window]:
            middle = own[(own >= least) & (own <= (window - least) // 2)]
            last = window - least - middle
            middle, last = middle[there[last]], last[there[last]]
            found.append(np.stack([np.full_like(middle, least), middle, last], axis=1))
        window //= 2
    return np.concatenate(found)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """How often to use each combination: least squares against the histogram, nothing below zero.

    Multiplicative updates keep every count at zero or more and never raise the residual.
    """
    wanted = histogram.astype(float)
    wanted[0] = 0
    counts = np.full(len(combos), wanted.sum() / max(1, 3 * len(combos)))

    def lengths_used(x: np.ndarray) -> np.ndarray:
        used = sum(np.bincount(side, x, len(wanted)) for side in combos.T)
        used[0] = 0
        return used

    def by_combo(row: np.ndarray) -> np.ndarray:
        return sum(row[side] for side in combos.T)

    target = by_combo(wanted)
    for _ in range(rounds if len(combos) else 0):
        counts *= target / np.maximum(by_combo(lengths_used(counts)), 1e-300)
    return counts


def rounded(combos: np.ndarray, counts: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole counts, the largest first, each rounded up as far as documents are left."""
    left = histogram.tolist()
    left[0] = 1 << 62
    out = np.zeros(len(combos), np.int64)
    rows, whole = combos.tolist(), np.ceil(np.round(counts, 9)).astype(np.int64).tolist()
    for s in np.argsort(-counts, kind="stable").tolist():
        a, b, c = rows[s]
        most = left[a] // 3 if a == c else min(left[a] // (1 + (a == b)), left[b] // (1 + (b == c)), left[c])
        times = min(whole[s], most)
        if times:
            for length in (a, b, c):
                left[length] -= times
            out[s] = times
    return out


@dataclass(frozen=True)
class Plan:
    """Where the documents of each length go, by rank.

    From ``keys`` (length and first rank) on, a rank's place in one long row of windows is ``first``
    and ``step`` for each rank more; -1 leaves it to the greedy step. Windows stand in falling size,
    so none crosses a multiple of ``window``; the last ``total % window`` tokens are
    sequences that are powers of two.
    """

    window: int
    keys: np.ndarray
    first: np.ndarray
    step: np.ndarray
    total: int

    def placed(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence (-1: none) and offset of items by length and 0-based rank."""
        key = (length << _RANKS) + rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        place = self.first[at] + (key - self.keys[at]) * self.step[at]
        sequence, offset = place // self.window, place % self.window
        rest = self.total % self.window
        if rest:
            ends = np.cumsum(powers(rest))
            own = sequence == self.total // self.window
            part = np.searchsorted(ends, offset, side="right")
            offset = np.where(own, offset - np.concatenate(([0], ends))[part], offset)
            sequence = np.where(own, sequence + part, sequence)
        taken = self.first[at] >= 0
        return np.where(taken, sequence, -1), np.where(taken, offset, 0)


def powers(size: int) -> list[int]:
    """The falling powers of two that add up to ``size``."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


def plan_for(histogram: np.ndarray, rounds: int = 200) -> Plan:
    window = len(histogram) - 1
    combos = combinations(histogram)
    counts = rounded(combos, repeat_counts(combos, histogram, rounds), histogram)
    combos, counts = combos[counts > 0], counts[counts > 0]
    sizes = combos.sum(axis=1)
    order = np.argsort(-sizes, kind="stable")
    combos, counts, sizes = combos[order], counts[order], sizes[order]
    bases = np.cumsum(counts * sizes) - counts * sizes
    inner = np.cumsum(combos, axis=1) - combos
    taken = np.zeros(window + 1, np.int64)
    entries = []
    for row, count, size, base, inside in zip(combos, counts, sizes, bases, inner):
        for length, offset in zip(row, inside):
            if length:
                entries.append(((int(length) << _RANKS) + int(taken[length]), base + offset, size))
                taken[length] += count
    entries += [((length << _RANKS) + int(taken[length]), -1, 0) for length in range(window + 1)]
    keys, first, step = (np.array(c, np.int64) for c in zip(*sorted(entries)))
    return Plan(window, keys, first, step, int((counts * sizes).sum()))


# ---- the greedy step --------------------------------------------------------------


def greedy(lengths: list[int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of all items, cut so that no sequence is padded.

    Best fit in falling size first; then the emptiest sequences are poured into the room of
    the fullest ones, and the last one is cut into powers of two.
    """
    bins: list[list[list[int]]] = []
    room: list[tuple[int, int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[item], -1))
        left, b = room.pop(at) if at < len(room) else (window, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append([item, 0, lengths[item]])
        if left > lengths[item]:
            insort(room, (left - lengths[item], b))
    fill = [sum(p[2] for p in own) for own in bins]
    order = sorted(range(len(bins)), key=lambda b: -fill[b])
    bins, fill = [bins[b] for b in order], [fill[b] for b in order]
    into, out = 0, len(bins) - 1
    while into < out:
        gap = window - fill[into]
        if not gap:
            into += 1
        elif not fill[out]:
            out -= 1
        else:
            item, start, length = bins[out].pop()
            moved = min(gap, length)
            bins[into].append([item, start, moved])
            if moved < length:
                bins[out].append([item, start + moved, length - moved])
            fill[into] += moved
            fill[out] -= moved
    rows, sequence = [], 0
    for own, size in zip(bins, fill):
        if not size:
            continue
        ends = [window] if size == window else powers(size)
        offset = 0
        for item, start, length in own:
            while length:
                part = min(length, ends[0] - offset)
                rows.append((item, start, part, sequence, offset))
                start, length, offset = start + part, length - part, offset + part
                if offset == ends[0]:
                    ends, offset, sequence = ends[1:], 0, sequence + 1
    return rows


# ---- over documents ---------------------------------------------------------------


def token_rows(docs: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """``keep``, a number for each row, ``tokens`` and ``ids`` (little-endian, 2 or 4 bytes each).

    Every text, null being empty, ends with the end id. The table is written, so that a row's number
    stays. The vocabulary file is read here and sent to the tasks; its size does not grow
    with the data.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    named = docs.select(*keep, "text", F.monotonically_increasing_id().alias("_row"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(content.value)
        for batch in batches:
            ids = list(text_ids(words, batch.column("text")))
            end = np.array([END_ID], words.kind).tobytes()
            found = [
                *(batch.column(c) for c in [*keep, "_row"]),
                pa.array([len(i) + 1 for i in ids], pa.int64()),
                pa.array([i.tobytes() + end for i in ids], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(found, [*keep, "_row", "tokens", "ids"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "_row long, tokens long, ids binary"])
    path = scratch_path(docs.sparkSession, "token-rows")
    rows = named.mapInArrow(encoded, schema)
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def place_tokens(rows: DataFrame, window: int = 2048, block_rows: int = 4000, rounds: int = 200) -> DataFrame:
    """``_row``, ``start``, ``length``, ``sequence_id``, ``offset`` for rows with ``_row, tokens``.

    Whole windows are cut off the front of longer rows; the rest is never cut unless the greedy
    step takes it. Ranks within a length are counted in two levels, so that a length which a third
    of all rows has is spread over tasks.
    """
    if window < 1 or window & (window - 1):
        raise ValueError(f"the window must be a power of two, got {window}")
    starts = F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(window).cast("long"))
    items = rows.select("_row", "tokens", F.explode(starts).alias("start")).select(
        "_row", "start", F.least(F.lit(window), F.col("tokens") - F.col("start")).alias("length")
    )
    counted = items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a length
    histogram = np.zeros(window + 1, np.int64)
    for r in counted:
        histogram[r["length"]] = r["n"]
    plan = items.sparkSession.sparkContext.broadcast(plan_for(histogram, rounds))

    # As many buckets as a bucket has rows: neither the buckets of a length nor the rows of one are many.
    buckets = max(1, math.isqrt(int(histogram.sum())))
    bucket = F.pmod(F.xxhash64("_row", "start"), F.lit(buckets))
    ranked = row_numbers(items, ["length"], bucket, ["_row", "start"], "rank")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = plan.value.placed(length, rank - 1)
            found = [batch.column(c) for c in ("_row", "start", "length")] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(found, ["_row", "start", "length", "sequence_id", "offset"])

    schema = "_row long, start long, length long, sequence_id long, offset long"
    placed = settle(ranked.select("_row", "start", "length", "rank").mapInArrow(look_up, schema), "placed")
    rest = placed.filter("sequence_id < 0")
    blocks = parts_for(rest.count(), block_rows)

    def packed(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["_row", "start"], ignore_index=True)
        found = np.array(greedy(own["length"].tolist(), window), np.int64)
        item = found[:, 0]
        return pd.DataFrame(
            {
                "_row": own["_row"].to_numpy()[item],
                "start": own["start"].to_numpy()[item] + found[:, 1],
                "length": found[:, 2],
                # Odd numbers, so that they differ from those of the plan.
                "sequence_id": 2 * ((int(key[0]) << 32) + found[:, 3]) + 1,
                "offset": found[:, 4],
            }
        )

    block = F.pmod(F.xxhash64(F.lit(7), "_row", "start"), F.lit(blocks)).alias("block")
    cut = rest.groupBy(block).applyInPandas(packed, schema)
    whole = placed.filter("sequence_id >= 0").withColumn("sequence_id", F.col("sequence_id") * 2)
    return whole.unionByName(cut)


def pack_by_histogram(
    docs: DataFrame,
    vocabulary: str,
    window: int = 2048,
    doc_id: str = "doc_id",
    with_ids: bool = True,
    **settings,
) -> DataFrame:
    """Every piece of every document: where it is cut from, its place, and its ids.

    Columns ``doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32`` and, on request,
    ``ids`` (little-endian 32-bit). A null or empty text is the end id alone. Null and
    repeated ids are documents like others; an empty table gives no rows; a text of any length is
    encoded slice by slice. Further columns are not looked at.
    """
    rows = token_rows(docs, vocabulary, [doc_id])
    places = place_tokens(rows.select("_row", "tokens"), window, **settings)
    kind = docs.schema[doc_id].dataType.simpleString()
    joined = rows.join(places, "_row")
    keep = [doc_id, "start", "length", "tokens", "sequence_id", "offset"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("tokens", "start", "length"))
            ids = []
            for text, tokens, start, length in zip(batch.column("ids"), *sides):
                held = memoryview(text.as_buffer())
                own = held.cast("H" if len(held) == 2 * tokens else "I")[start : start + length]
                ids.append(np.asarray(own).astype("<u4").tobytes())
            found = [*(batch.column(c) for c in keep), pa.array([zlib.crc32(i) for i in ids], pa.int64())]
            found += [pa.array(ids, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(found, names)

    names = [*keep, "ids_crc32"] + ["ids"] * with_ids
    schema = f"`{doc_id}` {kind}, start long, length long, tokens long, sequence_id long, offset long, ids_crc32 long"
    schema += ", ids binary" * with_ids
    return joined.select(*keep, "ids").mapInArrow(cut, schema).withColumnRenamed("tokens", "doc_tokens")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``tokens``, ``ids`` (little-endian 32-bit) and its ``documents`` in order.

    Needs pieces with ids; a sequence is at most one window, so no group is large.
    """
    doc_id = pieces.columns[0]
    own = F.array_sort(F.collect_list(F.struct("offset", "length", "ids", F.col(doc_id).alias("document"))))
    whole = pieces.groupBy("sequence_id").agg(own.alias("own"))
    joined = F.unhex(F.array_join(F.transform("own", lambda p: F.hex(p["ids"])), ""))
    return whole.select(
        "sequence_id",
        F.aggregate("own", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("tokens"),
        joined.alias("ids"),
        F.col("own.document").alias("documents"),
    )


def padding(pieces: DataFrame, window: int = 2048) -> DataFrame:
    """One row: sequences, tokens, and the padding up to the window (none at powers of two)."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    power = F.bit_count("tokens") == 1
    short = F.when(power, 0).otherwise(F.lit(window) - F.col("tokens"))
    return filled.agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("tokens").alias("tokens"), F.sum(short).alias("padding")
    )


def packing_digest(docs: DataFrame, vocabulary: str, window: int = 2048) -> DataFrame:
    """Where every piece lies, with a checksum of its ids; rows as in ``pack_by_histogram``."""
    found = pack_by_histogram(docs, vocabulary, window, with_ids=False)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
