"""Remove every byte that a long string seen earlier covers.

Texts are cut at content-defined anchors: of each window of ``WINDOW`` bytes, the inner piece with the
least hash. Equal windows have the same anchor at the same place, so windows need comparing only where anchors
recur. Copies with one context around an anchor are settled by counting. Different contexts of one anchor
are lined up at it and built into a Burrows-Wheeler order column by column, from the last
to the first: each round puts one symbol in front of every context, moves the order and
the common prefixes on, and reads off which windows are the same. An anchor with very many contexts is
never gathered: its windows are dealt out by their own hashes, and the earliest of equal ones is found
among them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import bucketed, parts_for, pieces, text_bytes, texts_of
from ranklight.llm.interpolation import from_planes, planes
from ranklight.llm.text_stats import mix
from ranklight.session import settle

WINDOW = 100
PIECE = 50
_SPAN = WINDOW - PIECE  # an anchor starts at most so many bytes after its window
_SEGMENT = 1 << 20
_HASH_BITS, _CONTEXT_BITS = 54, 48
_FACTOR = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)
_PAD = 256


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_FACTOR, -1, 1 << 64)
    up = np.full(n, _FACTOR, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors of all windows inside the documents: place ``at``, first and last window
    ``low`` and ``high``, hash of the piece, and hash of all bytes the windows cover."""
    up, down = _powers(_SEGMENT + WINDOW)
    open_at = np.zeros(len(data) + 1, np.int32)
    np.add.at(open_at, starts, 1)
    np.add.at(open_at, np.maximum(starts, ends - WINDOW + 1), -1)
    inside = np.cumsum(open_at)[:-1] > 0
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    for base in range(0, len(data), _SEGMENT):
        block = data[base : base + _SEGMENT + WINDOW - 1]
        n = len(block) - WINDOW + 1
        if n <= 0:
            break
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=total[1:])
        hashes = mix((total[PIECE:] - total[:-PIECE]) * down[: len(block) - PIECE + 1])
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= _SPAN + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = _SPAN + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        valid = np.flatnonzero(inside[base : base + n])
        if not len(valid):
            continue
        at = (least[valid] & _PLACE).astype(np.int64)
        new = np.r_[True, (at[1:] != at[:-1]) | (np.diff(valid) > 1)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(at)] - 1
        at, low, high = at[first], valid[first], valid[last]
        around = (total[high + WINDOW] - total[low]) * down[low]
        shape = ((at - low) * 256 + (high - low)).astype(np.uint64)
        found = (at + base, low + base, high + base, hashes[at], mix(around ^ mix(shape)))
        for part, values in zip(parts, found):
            part.append(values)
    empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    joined = [np.concatenate(p) if p else e for p, e in zip(parts, empty)]
    joined[3] = joined[3] >> np.uint64(64 - _HASH_BITS)
    joined[4] = joined[4] >> np.uint64(64 - _CONTEXT_BITS)
    return dict(zip(("at", "low", "high", "hash", "context"), joined))


def chunk_table(docs: DataFrame, chunk_bytes: int, chunks: int) -> DataFrame:
    """Texts in chunks of about ``chunk_bytes``, by ascending id inside each; texts are never cut.

    Written as a bucketed table to the shared folder, so that the later passes, which
    join something to each chunk, need not move the texts again.
    """
    names = ["chunk", "ids", "lengths", "data"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = 0, [], 0

        def chunk() -> pa.RecordBatch:
            nonlocal number, waiting, size
            rows = sorted(waiting, key=lambda r: _id(r[0]))
            number, waiting, size = number + 1, [], 0
            values = [
                [(TaskContext.get().partitionId() << 24) + number],
                [[r[0] for r in rows]],
                [[len(r[1]) for r in rows]],
                [b"".join(r[1] for r in rows)],
            ]
            types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

        for batch in pieces(batches, "text", chunk_bytes):
            for row in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                if waiting and size + len(row[1]) > chunk_bytes:
                    yield chunk()
                waiting.append(row)
                size += len(row[1])
        if waiting:
            yield chunk()

    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"doc_id must be an integer, not {kind}")
    # Ids travel as text: lists of numbers with nulls would become floating point on the way.
    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(
        gathered, "chunk long, ids array<string>, lengths array<long>, data binary"
    )
    return bucketed(rows, "repeat-chunks", "chunk", chunks)


class Chunk:
    """A chunk's bytes, its anchors, and the distinct (piece, context) pairs in sorted order."""

    def __init__(self, ids: list[str | None], lengths: list[int], data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        self.lengths = np.asarray(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.ids = np.array([_id(i) for i in ids], np.int64)
        self.found = anchors(self.data, self.starts, self.ends)
        piece, context = self.found["hash"], self.found["context"]
        order = np.lexsort((context, piece))  # stable: the earliest of equal pairs comes first
        piece, context = piece[order], context[order]
        new = np.ones(len(order), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (context[1:] != context[:-1])
        self.first = order[new]
        self.piece, self.context = piece[new], context[new]
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        document = np.searchsorted(self.ends, self.found["at"][self.first], side="right")
        self.first_id = self.ids[document] if len(document) else np.zeros(0, np.int64)

    def cuts(self, edges: list[tuple[int, int]]) -> np.ndarray:
        """Where the buckets between ``edges``, pairs themselves, start and end."""
        wanted = np.array([p for p, _ in edges], np.uint64)
        found = np.searchsorted(self.piece, wanted)
        for k, (_, context) in enumerate(edges):
            if context:
                last = np.searchsorted(self.piece, wanted[k], side="right")
                found[k] += np.searchsorted(self.context[found[k] : last], np.uint64(context))
        return np.r_[0, found, len(self.piece)]


def _crowded(chunks: DataFrame, most: int) -> list[tuple[int, int]]:
    """Pieces with very many contexts, and about how many; all others have at most twice ``most``.

    A chunk that has few of them keeps silent; ``most`` also bounds how many pieces come back.
    """
    least = max(2, most // max(1, chunks.count()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Chunk(row["ids"], row["lengths"], row["data"])
                found, count = np.unique(own.piece, return_counts=True)
                many = count >= least
                columns = [pa.array(x[many].astype(np.int64)) for x in (found, count)]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "n"])

    summed = chunks.mapInArrow(counted, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return sorted((r["piece"], r["n"]) for r in summed.filter(F.col("n") > most).collect())


def _edges(buckets: int, crowded: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """The pairs at which the buckets start; a crowded piece has buckets of its own, by context."""
    edges = {((b << _HASH_BITS) // buckets, 0) for b in range(1, buckets)}
    for piece, count in crowded:
        parts = parts_for(count, most)
        edges |= {(piece, (k << _CONTEXT_BITS) // parts) for k in range(parts)} | {(piece + 1, 0)}
    return sorted(edges)


def _id(value: str | None) -> int:
    return -(2**63) if value is None else int(value)  # before all others


def _numbers(values: np.ndarray) -> bytes:
    """Signed numbers as their least, eight bytes, and byte planes of what is above it."""
    least = int(values.min()) if len(values) else 0
    return least.to_bytes(8, "little", signed=True) + planes((values - least).view(np.uint64))


def _from_numbers(blob: bytes) -> np.ndarray:
    return from_planes(blob[8:]).view(np.int64) + int.from_bytes(blob[:8], "little", signed=True)


def _questions(chunks: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    names = ["bucket", "chunk", "piece", "context", "first_id"]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Chunk(row["ids"], row["lengths"], row["data"])
                cuts = own.cuts(edges)
                parts = [b for b in range(len(edges) + 1) if cuts[b] < cuts[b + 1]]
                blobs = [
                    (
                        planes(np.diff(own.piece[a:b], prepend=np.uint64(0))),
                        planes(own.context[a:b]),
                        _numbers(own.first_id[a:b]),
                    )
                    for a, b in ((cuts[p], cuts[p + 1]) for p in parts)
                ]
                columns = [pa.array(parts, pa.int32()), pa.array([row["chunk"]] * len(parts), pa.int64())]
                columns += [pa.array([x[k] for x in blobs], pa.binary()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return chunks.mapInArrow(
        asked, "bucket int, chunk long, piece binary, context binary, first_id binary"
    )


def _answering(crowded: np.ndarray):
    def answered(key, own: pd.DataFrame) -> pd.DataFrame:
        """To every chunk, per pair it asked for: 1 if it has the first of all, plus 2 if the
        piece has other contexts too."""
        own = own.sort_values("chunk")
        pieces_ = [np.cumsum(from_planes(b), dtype=np.uint64) for b in own["piece"]]
        lengths = [len(p) for p in pieces_]
        piece = np.concatenate(pieces_)
        context = np.concatenate([from_planes(b) for b in own["context"]])
        first_id = np.concatenate([_from_numbers(b) for b in own["first_id"]])
        # The sort is stable, so of equal ids the chunk with the smaller number is first.
        order = np.lexsort((first_id, context, piece))
        piece, context = piece[order], context[order]
        new_piece = np.r_[True, piece[1:] != piece[:-1]]
        new = new_piece | np.r_[True, context[1:] != context[:-1]]
        starts = np.flatnonzero(new_piece)
        distinct = np.add.reduceat(new.astype(np.int64), starts)
        several = np.repeat(distinct > 1, np.diff(np.r_[starts, len(piece)]))
        several |= np.isin(piece, crowded)  # whose other contexts may be in other buckets
        flags = np.empty(len(order), np.uint8)
        flags[order] = new + 2 * several
        ends = np.cumsum(lengths)
        blobs = [zlib.compress(flags[e - n : e].tobytes(), 1) for e, n in zip(ends, lengths)]
        return pd.DataFrame({"bucket": key[0], "chunk": own["chunk"].to_numpy(), "flags": blobs})

    return answered


def _flags(rows: pd.DataFrame) -> np.ndarray:
    blobs = [zlib.decompress(b) for b in rows.sort_values("bucket")["flags"]]
    return np.frombuffer(b"".join(blobs), np.uint8)


def _context_sender(edges: list[tuple[int, int]], crowded: np.ndarray):
    def sent(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The contexts that must be compared, each from the chunk that has it first."""
        row = left.iloc[0]
        own = Chunk(row["ids"], row["lengths"], row["data"])
        flags = _flags(right) if len(right) else np.zeros(0, np.uint8)
        open_pairs = np.flatnonzero((flags == 3) & ~np.isin(own.piece, crowded)[: len(flags)])
        cuts, out = own.cuts(edges), []
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pairs = open_pairs[(open_pairs >= a) & (open_pairs < b)]
            if not len(pairs):
                continue
            where = own.first[pairs]
            at, low, high = (own.found[c][where] for c in ("at", "low", "high"))
            data = b"".join(
                own.data[x : y + WINDOW].tobytes() for x, y in zip(low.tolist(), high.tolist())
            )
            out.append(
                (
                    bucket,
                    key[0],
                    (at - low).astype(np.uint8).tobytes(),
                    (high - low).astype(np.uint8).tobytes(),
                    _numbers(own.first_id[pairs]),
                    _numbers(at),
                    data,
                )
            )
        return pd.DataFrame(out, columns=_CONTEXT_COLUMNS)

    return sent


_CONTEXT_COLUMNS = ["bucket", "chunk", "before", "windows", "first_id", "at", "data"]
_CONTEXTS = "bucket int, chunk long, " + ", ".join(f"{c} binary" for c in _CONTEXT_COLUMNS[2:])


def _range_minima(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least of values[left] to values[right], both included, for many ranges."""
    out = np.empty(len(left), values.dtype)
    level = np.log2(right - left + 1).astype(np.int64)
    # A float logarithm may be one off at powers of two.
    level -= (1 << level) > right - left + 1
    level += (2 << level) <= right - left + 1
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[left[own]], table[right[own] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def earlier_windows(before: np.ndarray, windows: np.ndarray, data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Per context a bit for each place of its windows before the anchor (bit k: k bytes before)
    that is set if a context of smaller ``rank`` has the same window.

    The contexts stand one after the other in ``data``. Column by column from the right, the
    order of the contexts by what follows, and the length of the prefix each shares with the one
    above, are carried on; a symbol past a context's end equals no other.
    """
    n = len(before)
    sizes = windows.astype(np.int64) + WINDOW
    starts = np.cumsum(sizes) - sizes
    order = np.arange(n)
    shared = np.zeros(n, np.int64)
    masks = np.zeros(n, np.uint64)
    left_most, right_most = -int(before.max(initial=0)), int((sizes - before).max(initial=0))
    for column in range(right_most - 1, left_most - 1, -1):
        place = column + before[order].astype(np.int64)
        known = (place >= 0) & (place < sizes[order])
        symbol = np.full(n, _PAD, np.uint16)
        symbol[known] = data[starts[order[known]] + place[known]]
        moved = np.argsort(symbol, kind="stable")
        follows = np.zeros(n, bool)
        follows[1:] = (symbol[moved[1:]] == symbol[moved[:-1]]) & (symbol[moved[1:]] != _PAD)
        now = np.zeros(n, np.int64)
        later = np.flatnonzero(follows)
        now[later] = 1 + _range_minima(shared, moved[later - 1] + 1, moved[later])
        order, shared = order[moved], now
        if column <= 0:
            runs = np.flatnonzero(shared < WINDOW)
            ranks = rank[order]
            least = np.repeat(np.minimum.reduceat(ranks, runs), np.diff(np.r_[runs, n]))
            masks[order[ranks > least]] |= np.uint64(1 << -column)
    return masks


def _compared(key, own: pd.DataFrame) -> pd.DataFrame:
    own = own.sort_values("chunk")
    before, windows = (np.frombuffer(b"".join(own[c]), np.uint8) for c in ("before", "windows"))
    counts = np.array([len(b) for b in own["before"]])
    first_id = np.concatenate([_from_numbers(b) for b in own["first_id"]])
    at = np.concatenate([_from_numbers(b) for b in own["at"]])
    # Earlier is: a smaller id, of equal ids the chunk with the smaller number, then the place there.
    rank = np.empty(len(first_id), np.int64)
    order = np.lexsort((at, np.repeat(np.arange(len(counts)), counts), first_id))
    rank[order] = np.arange(len(rank))
    masks = earlier_windows(before, windows, np.frombuffer(b"".join(own["data"]), np.uint8), rank)
    ends = np.cumsum(counts)
    blobs = [planes(masks[e - n : e]) for e, n in zip(ends, counts)]
    return pd.DataFrame({"bucket": key[0], "chunk": own["chunk"].to_numpy(), "flags": blobs})


def _crowded_windows(own: Chunk, flags: np.ndarray, crowded: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the contexts of crowded pieces: the distinct windows' hashes, sorted, where each starts
    first, and where the others of the chunk start."""
    pairs = np.flatnonzero((flags == 3) & np.isin(own.piece, crowded)[: len(flags)])
    at, low, high = (own.found[c][own.first[pairs]] for c in ("at", "low", "high"))
    n = high - low + 1
    start = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    rolled = np.zeros(len(start), np.uint64)
    for k in range(WINDOW):
        rolled = rolled * np.uint64(_FACTOR) + own.data[start + k] + np.uint64(1)
    place = (np.repeat(at, n) - start).astype(np.uint64)
    value = mix(mix(rolled) ^ mix(np.repeat(own.piece[pairs], n) * np.uint64(64) + place))
    order = np.lexsort((start, value))
    value, start = value[order], start[order]
    new = np.r_[True, value[1:] != value[:-1]][: len(value)]
    return value[new], start[new], start[~new]


def _window_sender(buckets: int, crowded: np.ndarray):
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)

    def sent(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The windows of crowded pieces, once for each chunk."""
        row = left.iloc[0]
        own = Chunk(row["ids"], row["lengths"], row["data"])
        flags = _flags(right) if len(right) else np.zeros(0, np.uint8)
        value, start, _ = _crowded_windows(own, flags, crowded)
        first_id = own.ids[np.searchsorted(own.ends, start, side="right")]
        cuts = np.r_[0, np.searchsorted(value, edges), len(value)]
        out = [
            (b, key[0], planes(np.diff(value[x:y], prepend=np.uint64(0))), _numbers(first_id[x:y]))
            for b, (x, y) in enumerate(zip(cuts, cuts[1:]))
            if x < y
        ]
        return pd.DataFrame(out, columns=["bucket", "chunk", "value", "first_id"])

    return sent


def _windows_answered(key, own: pd.DataFrame) -> pd.DataFrame:
    """To every chunk, per window it sent: 1 if an earlier chunk or document has it."""
    own = own.sort_values("chunk")
    values = [np.cumsum(from_planes(b), dtype=np.uint64) for b in own["value"]]
    value, first_id = np.concatenate(values), np.concatenate([_from_numbers(b) for b in own["first_id"]])
    order = np.lexsort((first_id, value))  # stable, as above
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.r_[False, value[order][1:] == value[order][:-1]]
    ends = np.cumsum([len(v) for v in values])
    blobs = [zlib.compress(flags[e - len(v) : e].tobytes(), 1) for e, v in zip(ends, values)]
    return pd.DataFrame({"bucket": key[0], "chunk": own["chunk"].to_numpy(), "flags": blobs})


def _removed(
    own: Chunk, flags: np.ndarray, masks: np.ndarray, crowded: np.ndarray, repeated: np.ndarray
) -> np.ndarray:
    """Which bytes of a chunk go; ``repeated`` tells it of the windows of crowded pieces."""
    covered = np.zeros(len(own.data) + 1, np.int32)
    low, high, at = (own.found[c] for c in ("low", "high", "at"))
    is_first = np.zeros(len(at), bool)
    is_first[own.first[(flags & 1) == 1]] = True
    np.add.at(covered, low[~is_first], 1)
    np.add.at(covered, high[~is_first] + WINDOW, -1)
    open_pairs = np.flatnonzero((flags == 3) & ~np.isin(own.piece, crowded)[: len(flags)])
    if len(crowded):
        _, start, others = _crowded_windows(own, flags, crowded)
        gone = np.r_[start[repeated == 1], others]
        np.add.at(covered, gone, 1)
        np.add.at(covered, gone + WINDOW, -1)
    for k in range(_SPAN + 1):
        hit = own.first[open_pairs[(masks >> np.uint64(k)) & np.uint64(1) == 1]]
        np.add.at(covered, at[hit] - k, 1)
        np.add.at(covered, at[hit] - k + WINDOW, -1)
    return np.cumsum(covered[:-1]) > 0


def _finished(key, left: pd.DataFrame, right: pd.DataFrame, crowded: np.ndarray) -> pd.DataFrame:
    row = left.iloc[0]
    own = Chunk(row["ids"], row["lengths"], row["data"])
    flags = _flags(right[right["kind"] == 0]) if len(right) else np.zeros(0, np.uint8)
    blobs = right[right["kind"] == 1].sort_values("bucket")["flags"]
    masks = np.concatenate([np.zeros(0, np.uint64), *[from_planes(b) for b in blobs]])
    repeated = _flags(right[right["kind"] == 2])
    gone = _removed(own, flags, masks, crowded, repeated)
    rises = gone.copy()
    rises[1:] &= ~gone[:-1]
    inner = own.starts[own.lengths > 0]
    rises[inner] = gone[inner]  # a run ends where its document does
    out = []
    for doc_id, a, b in zip(row["ids"], own.starts.tolist(), own.ends.tolist()):
        dropped = gone[a:b]
        out.append((doc_id, b - a, int(dropped.sum()), int(rises[a:b].sum()), own.data[a:b][~dropped].tobytes()))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _finisher(crowded: np.ndarray, digest: bool):
    def finished(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = _finished(key, left, right, crowded)
        if not digest:
            return found
        found["kept_sha256"] = [hashlib.sha256(b).hexdigest() for b in found["kept"]]
        return found.drop(columns="kept")

    return finished


def remove_repeats(
    docs: DataFrame, chunk_bytes: int = 4 << 20, digest: bool = False, most_contexts: int = 200_000
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes left, ``kept`` (or their SHA-256).

    A byte goes if a string of 100 bytes over it also starts earlier, in a document of smaller
    id or earlier in the same one; null ids come first, rows with one id in a fixed order. Null texts are
    empty; texts below 100 bytes stay whole; removal may cut a character.
    At most about twice ``most_contexts`` contexts of one anchor meet in a task.
    """
    rows, size = text_bytes(docs)
    chunks = chunk_table(docs, chunk_bytes, parts_for(size + rows, chunk_bytes))
    many = _crowded(chunks, most_contexts)
    crowded = np.array([piece for piece, _ in many], np.uint64)
    edges = _edges(parts_for(size // 20, 400_000), many, most_contexts)
    answers = settle(
        _questions(chunks, edges)
        .groupBy("bucket")
        .applyInPandas(_answering(crowded), "bucket int, chunk long, flags binary"),
        "repeat-answers",
    )
    contexts = (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(_context_sender(edges, crowded), _CONTEXTS)
    )
    masks = contexts.groupBy("bucket").applyInPandas(_compared, "bucket int, chunk long, flags binary")
    sent = answers.withColumn("kind", F.lit(0)).unionByName(masks.withColumn("kind", F.lit(1)))
    if many:
        # A context has at most _SPAN + 1 windows.
        parts = parts_for(sum(n for _, n in many) * (_SPAN + 1), 2_000_000)
        windows = (
            chunks.groupBy("chunk")
            .cogroup(answers.groupBy("chunk"))
            .applyInPandas(
                _window_sender(parts, crowded), "bucket int, chunk long, value binary, first_id binary"
            )
        )
        told = windows.groupBy("bucket").applyInPandas(
            _windows_answered, "bucket int, chunk long, flags binary"
        )
        sent = sent.unionByName(told.withColumn("kind", F.lit(2)))
    last = "kept_sha256 string" if digest else "kept binary"
    return (
        chunks.groupBy("chunk")
        .cogroup(sent.groupBy("chunk"))
        .applyInPandas(_finisher(crowded, digest), f"doc_id string, n_bytes long, n_removed long, n_spans long, {last}")
        .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    )
