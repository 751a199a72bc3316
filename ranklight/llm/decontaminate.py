"""Find benchmark items in documents.

A window as long as an item slides over each document. SimHash fingerprints of windows are looked up in
a multi-index of the items' fingerprints: within a radius r and over m blocks, some block differs in
at most r // m bits, so that no item within the radius is missed. What is found is checked by the exact
weighted similarity of the shingles.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import fresh, parts_for, pieces, row_key, text_bytes, texts_of
from ranklight.llm.text_stats import mix

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BREAKS = bytes(
    (b + 32) if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words without punctuation, A to Z lower-cased."""
    return text.translate(_BREAKS).split()


class _WordHashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 42)
        return found


def shingles(words: list[bytes], known: _WordHashes, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words; for the whole sequence if it is shorter."""
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1 if width else 0
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = rolled * _MULTIPLIER + hashes[k : k + n]
    return mix(rolled)


def fingerprint(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Shared shingles over all shingles, repeats counted."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (a.total() + b.total() - shared) if a or b else 0.0


class HammingBlocks:
    """Fingerprints by the values, in each block of bits, that lie within radius // blocks."""

    def __init__(self, fingerprints: list[int], radius: int, blocks: int = 7):
        self.fingerprints, self.radius, self.places = fingerprints, radius, []
        cuts = [64 * k // blocks for k in range(blocks + 1)]
        for low, high in zip(cuts, cuts[1:]):
            held: dict[int, list[int]] = defaultdict(list)
            for number, value in enumerate(fingerprints):
                own = (value >> low) & ((1 << (high - low)) - 1)
                for k in range(radius // blocks + 1):
                    for flipped in combinations(range(high - low), k):
                        held[own ^ sum(1 << b for b in flipped)].append(number)
            self.places.append((low, (1 << (high - low)) - 1, dict(held)))

    def near(self, value: int) -> set[int]:
        """All fingerprints within the radius."""
        found = {i for low, mask, held in self.places for i in held.get((value >> low) & mask, ())}
        return {i for i in found if (value ^ self.fingerprints[i]).bit_count() <= self.radius}


@dataclass
class Item:
    item_id: object
    weights: Counter
    values: np.ndarray
    size: int
    fingerprint: int


class ItemIndex:
    """The items of one block of the benchmark, ready to be sent to the tasks."""

    def __init__(self, rows: list[tuple[object, bytes]], width: int, threshold: float, radius: int):
        known = _WordHashes()
        self.width, self.threshold, self.items = width, threshold, []
        # Items of fewer words than a shingle, by their number of words and their hash.
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            words = words_of(text)
            hashes = shingles(words, known, width)
            if 0 < len(words) < width:
                self.short[len(words)][int(hashes[0])].append(len(self.items))
            if len(hashes):
                weights, own = Counter(hashes.tolist()), fingerprint(hashes)
                self.items.append(Item(item_id, weights, np.unique(hashes), len(hashes), own))
        self.by_size = {
            size: (own, HammingBlocks([self.items[i].fingerprint for i in own], radius))
            for size, own in self._sizes().items()
        }
        self.short = {count: dict(held) for count, held in self.short.items()}
        brief = {i for held in self.short.values() for own in held.values() for i in own}
        self.owners: dict[int, list[int]] = defaultdict(list)
        for number, item in enumerate(self.items):
            for value in item.values.tolist() if number not in brief else ():
                self.owners[value].append(number)
        self.values = np.array(sorted(self.owners), np.uint64)
        self.mark = np.zeros(1 << 20, bool)
        self.mark[(self.values >> np.uint64(44)).astype(np.int64)] = True

    def _sizes(self) -> dict[int, list[int]]:
        sizes: dict[int, list[int]] = defaultdict(list)
        for number, item in enumerate(self.items):
            sizes[item.size].append(number)
        return dict(sizes)

    def needed(self, item: Item, words: int) -> int:
        """Least number of shared shingles at which a window in a document of ``words`` shingles,
        which is shorter than the item if the document is, reaches the threshold."""
        window = min(item.size, words)
        # Shared / (size + window - shared) >= threshold.
        return ceil((item.size + window) * self.threshold / (1 + self.threshold) - 1e-9)

    def short_matches(self, words: list[bytes], known: _WordHashes) -> dict[int, tuple[float, int, int]]:
        """As ``matches``, for the items of fewer words than a shingle: their words stand in a row."""
        found: dict[int, tuple[float, int, int]] = {}
        for count, held in self.short.items():
            if len(words) < count:
                continue
            hashes = shingles(words, known, count)
            for place in np.flatnonzero(np.isin(hashes, np.fromiter(held, np.uint64, len(held)))).tolist():
                for i in held[int(hashes[place])]:
                    _, first, windows = found.get(i, (1.0, place, 0))
                    found[i] = (1.0, first, windows + 1)
        return found

    def matches(self, hashes: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Per item: best similarity, its first shingle, and how many windows reach the threshold.

        A window can only reach the threshold with ``needed`` shingles of the item, so others are
        passed over unread; this drops no window that the check would keep, also where the window is a
        whole document that is shorter than the item.
        """
        hit = np.flatnonzero(self.mark[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(hit) and len(self.values):
            place = np.searchsorted(self.values, hashes[hit])
            hit = hit[self.values[np.minimum(place, len(self.values) - 1)] == hashes[hit]]
        if not len(hit):
            return {}
        seen: Counter = Counter()
        for value, count in Counter(hashes[hit].tolist()).items():
            for number in self.owners[value]:
                seen[number] += count
        least = {i: self.needed(self.items[i], len(hashes)) for i in seen}
        spans = {(self.items[i].size, i) for i, n in seen.items() if n >= least[i]}
        starts: dict[int, set[int]] = defaultdict(set)
        for size, i in spans:
            item = self.items[i]
            last = max(1, len(hashes) - size + 1)
            inside = np.zeros(len(hashes) + 1, np.int64)
            inside[hit[np.isin(hashes[hit], item.values)] + 1] = 1
            total = np.cumsum(inside)
            count = total[np.minimum(np.arange(last) + size, len(hashes))] - total[:last]
            starts[size].update(np.flatnonzero(count >= least[i]).tolist())
        best: dict[int, tuple[float, int, int]] = {}
        for size, places in starts.items():
            own, index = self.by_size[size]
            for start in sorted(places):
                window = hashes[start : start + size]
                weights = None
                for k in index.near(fingerprint(window)):
                    weights = weights or Counter(window.tolist())
                    value = weighted_similarity(weights, self.items[own[k]].weights)
                    if value >= self.threshold:
                        old = best.get(own[k], (0.0, start, 0))
                        top = (value, start) if value > old[0] else old[:2]
                        best[own[k]] = (*top, old[2] + 1)
        return best


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 5,
    threshold: float = 0.8,
    radius: int = 20,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """doc_id, item_id, similarity, first_word and n_windows of every item in every document.

    One row for a document row and an item with a window of at least ``threshold``. Texts are
    taken whole; null and empty texts and items without words match nothing; an item of fewer than
    ``width`` words matches wherever just these words stand in a row; repeated documents and items
    each give their own rows. Only a block of the benchmark of about ``block_bytes`` of text is sent
    to the tasks at a time; a larger benchmark takes several passes.
    """
    return _leaks(docs.select("doc_id", "text"), benchmark, "doc_id", width, threshold, radius, block_bytes)


def _leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str,
    width: int,
    threshold: float,
    radius: int,
    block_bytes: int,
) -> DataFrame:
    blocks = parts_for(text_bytes(benchmark)[1], block_bytes)
    kinds = {f.name: f.dataType.simpleString() for f in [*docs.schema, *benchmark.schema]}
    schema = f"{key} {kinds[key]}, item_id {kinds['item_id']}, similarity double, first_word long, n_windows long"
    names = [key, "item_id", "similarity", "first_word", "n_windows"]
    item_type = pa.from_numpy_dtype(np.int64) if kinds["item_id"] == "bigint" else None
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    for number in range(blocks):
        own = benchmark.filter(block == number).select("item_id", "text").collect()
        rows = sorted(((r["item_id"], (r["text"] or "").encode()) for r in own), key=repr)
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(rows, width, threshold, radius))

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known, items = _WordHashes(), index.value
            for batch in pieces(batches, "text", 8 << 20):
                source, found = [], []
                for i, text in enumerate(texts_of(batch.column("text"))):
                    words = words_of(text)
                    own = items.matches(shingles(words, known, width))
                    for k, value in (own | items.short_matches(words, known)).items():
                        source.append(i)
                        found.append((items.items[k].item_id, *value))
                columns = list(zip(*found)) or [(), (), (), ()]
                kind = [item_type, pa.float64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kind)]
                taken = batch.column(key).take(pa.array(source, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken, *arrays], names)

        parts.append(docs.select(key, "text").mapInArrow(scan, schema))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents, all columns, in which no benchmark item is found."""
    options = {"width": 5, "threshold": 0.8, "radius": 20, "block_bytes": 2 << 20} | settings
    row = fresh(docs, "_row")
    keyed = docs.select(F.to_json(row_key()).alias(row), "text")
    leaking = _leaks(keyed, benchmark, row, **options).select(row).distinct()
    rows = docs.withColumn(row, F.to_json(row_key()))
    return rows.join(leaking, row, "left_anti").select(*[f"`{c}`" for c in docs.columns])
